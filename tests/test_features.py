"""Payloads, data source, tools, indexes, store and streams on small inputs."""

import json
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from folioflow.operators import answering, chunking, indexing, language_profiles, metric, payloads, postings, retrieval, tools, vectors
from folioflow.plans.oracles import ORACLE_SQL
from folioflow.plans.queries import QUERIES
from folioflow.sources import layout
from folioflow.sources import pages as sp
from folioflow.sources.store import Conflict, Store
from folioflow.streaming import escalation, ledgers
from tests.oracle import compare


@pytest.mark.parametrize("name", ["audit_claims", "provider_payload", "semantic_topk"])
def test_query_matches_sql_on_more_rows(spark, name):
    compare(spark, QUERIES[name], ORACLE_SQL[name], "/root/testdata/sf0.01")


# Payloads


def test_payload_spellings(spark):
    told = {
        "page_count": 0, "metadata": {"page_count": "4"}, "text_blocks": [],
        "blocks": [{"text": "  hi \n", "page_number": 2, "id": 7, "bounding_box": {"x0": 1, "t": 2, "x1": 3.5}, "reading_order": 0, "confidence": 0}, "junk", {"orig": "o", "prov": [{"page_no": 3, "bbox": {"l": 1, "t": 2, "r": 3, "b": 4}}]}, {"text": " "}],
        "tables": [
            {"headers": ["A", 1], "rows": [["x", None, 2.5], "no"]}, {"headers": []},
            {"data": {"table_cells": [{"start_row_offset_idx": 0, "start_col_offset_idx": 1, "text": "h"}, {"start_row_offset_idx": 2, "start_col_offset_idx": 0, "text": "v"}, {"start_row_offset_idx": 2, "start_col_offset_idx": 0, "text": "w"}, 5]}},
        ],
        "pictures": [{"caption": "c", "prov": [{"page_no": 9}]}, {}],
    }
    rows = [("a", json.dumps(told)), ("b", json.dumps({"pages": {"1": {}, "2": {}}})), ("c", None), ("d", "[1]"), ("e", "{bad"), ("f", "{}")]
    documents, blocks, tables, figures = payloads.normalized(spark.createDataFrame(rows, "doc_id string, payload string"))
    failed, broken = "layout_provider_error", "layout_provider_conversion_failed"
    assert {r.doc_id: (r.page_count, r.error) for r in documents.collect()} == {"a": (4, None), "b": (2, None), "c": (None, failed), "d": (None, broken), "e": (None, broken), "f": (1, None)}
    one, two = sorted(blocks.collect(), key=lambda r: r.idx)
    assert (one.item_id, one.text, one.page_number, tuple(one.box), one.reading_order, one.confidence) == ("7", "hi", 2, (1.0, 2.0, 3.5, 1.0), 0, 0.9)
    assert (two.item_id, two.text, two.page_number, tuple(two.box), two.block_type) == ("ltb-3-2", "o", 3, (1.0, 2.0, 3.0, 4.0), "paragraph")
    assert [(r.item_id, r.headers, r.rows) for r in sorted(tables.collect(), key=lambda r: r.idx)] == [("tbl-1-0", ["A", "1"], [["x", "", "2.5"]]), ("tbl-1-2", ["", "h"], [[], ["w"]])]
    assert [(r.page_number, r.caption, r.figure_type) for r in sorted(figures.collect(), key=lambda r: r.idx)] == [(9, "c", "image"), (1, None, "image")]


def test_layout_source(spark, tmp_path):
    html = "<title>T &amp; x</title><script>var t='</p>';</script><p>one<br>two</p><table><tr><th>a</th><td>b</td></tr></table>"
    rows = [(k, html.replace("T", f"T{k}")) for k in range(100)] + [(100, None), (101, "<div></div>")]
    table = spark.createDataFrame(rows, "page_id long, html string").coalesce(1).sortWithinPartitions("page_id").toArrow()
    pq.write_table(table, tmp_path / "pages.parquet", row_group_size=10)
    layout.register(spark)
    read = lambda: spark.read.format("layout_pages").load(str(tmp_path / "pages.parquet"))
    blocks = {(r.page_id, r.pos, r.block_type, r.text) for r in read().where("kind = 'block'").collect()}
    assert blocks == {(r.page_id, r.pos, r.block_type, r.text) for r in sp.html_payload(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert {(r.page_id, r.error) for r in read().where("kind = 'error'").collect()} == {(100, "layout_provider_error"), (101, "layout_provider_conversion_failed")}
    assert {r.text for r in read().where("kind = 'table'").collect()} == {"a | b"}
    few = read().where("page_id between 25 and 27")
    assert few.select("page_id").distinct().count() == 3 and few.rdd.getNumPartitions() == 1
    assert "GreaterThanOrEqual(page_id,25)" in few._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


# Tools


def test_tools_from_sql(spark):
    tools.register(spark)
    rows = [(r, "order total", f"f{i}", f"Order {i}", "Total 5", "order total" if i == 3 else f"order {i}", i) for r in (1, 2) for i in range(30)] + [(3, None, "f", "n", "v", "n", 1)]
    spark.createDataFrame(rows, "request_id int, query string, fact_id string, fact_name string, fact_value string, normalized_name string, page_number int").createOrReplaceTempView("pairs")
    found = spark.sql("SELECT * FROM structured_query(TABLE(pairs) PARTITION BY (request_id), 50)").collect()
    assert dict(spark.sql("SELECT * FROM structured_query(TABLE(pairs) PARTITION BY request_id)").dtypes)["request_id"] == "int"
    # The limit is cut to twenty; ties go by page.
    assert len(found) == 40 and [r.fact_id for r in sorted(found, key=lambda r: (r.request_id, r["rank"]))][:3] == ["f3", "f0", "f1"]
    with pytest.raises(Exception, match="lacks request_id, topic"):
        spark.sql("SELECT * FROM pageindex_navigate(TABLE(SELECT 1 AS x) PARTITION BY x)").collect()
    with pytest.raises(Exception, match="whole number"):
        spark.sql("SELECT * FROM structured_query(TABLE(pairs) PARTITION BY (request_id), 'five')").collect()


# Indexes


def test_metric_index_is_exact_and_prunes(spark, monkeypatch):
    monkeypatch.setattr(metric, "BLOCK", 100)
    monkeypatch.setattr(metric, "ASKED", 40)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(12, 8))
    rows = [(i, (centre[i % 12] + 0.15 * rng.normal(size=8)).tolist()) for i in range(3000)]
    # Two copies, and six vectors without a direction or of another length.
    rows += [(5004, rows[5][1]), (4999, rows[5][1]), (5000, [0.0] * 8), (5001, None), (5002, [1.0] * 7), (5003, [float("nan")] * 8), (5005, [None] * 8), (5006, [])]
    known = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = known.where("vec_id % 20 = 0 or vec_id >= 4999").select(F.col("vec_id").alias("request_id"), F.col("embedding").alias("query_vec"))
    hits, work = metric.nearest(queries, known, 7)
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    ids = np.array(sorted(good))
    units = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    found = {}
    for r in hits.collect():
        found.setdefault(r.request_id, []).append((r["rank"], r.vec_id))
    asked = [r.request_id for r in queries.collect() if r.request_id in good]
    assert set(found) == set(asked)
    for i in asked:
        distance = np.round(1 - units @ units[list(ids).index(i)], 12)
        assert [v for _, v in sorted(found[i])] == ids[np.lexsort((ids, distance))[:7]].tolist()
    assert work.agg(F.sum("met")).first()[0] < len(asked) * len(ids) / 3
    assert retrieval.nearest(queries, known.limit(0), 3).count() == 0


def test_chunk_search_skips_vectors_without_a_direction(spark):
    ids = [("a", [1.0, 0.0]), ("b", None), ("c", [0.0, 0.0]), ("d", [None, 1.0]), ("e", [float("nan"), 1.0]), ("f", [0.0, 2.0])]
    known = spark.createDataFrame([(i, "d", v, "s") for i, v in ids], "vec_id string, doc_id string, embedding array<double>, section_id string")
    box = F.struct(F.lit(0.0).alias("x0"))
    chunks = known.select("doc_id", F.col("vec_id").alias("chunk_id"), F.lit("t").alias("content"), F.array(F.lit(1)).alias("pages"), box.alias("box"), F.lit("h").alias("content_hash"))
    asked = spark.createDataFrame([(1, "d", "q")], "request_id int, doc_id string, query string")
    found = vectors.search(asked, known, chunks, embed=lambda _: F.array(F.lit(1.0), F.lit(0.5)))
    assert [r.chunk_id for r in found.orderBy("rank").collect()] == ["a", "f"]


def test_audit_ends_at_words(spark):
    docs = spark.createDataFrame([(1, "a b a b c"), (1, "x a B\n c"), (2, "a bc"), (3, None), (None, "b a c"), (4, "")], "doc_id long, text string")
    claims = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "a b a b c"), (4, "b b"), (5, None), (6, "zz a"), (7, "A  c"), (8, "a"), (9, "b a"), (9, "a bc")], "claim_id long, text string")
    assert {r.claim_id: r.n_docs for r in answering.audit(claims, docs).collect()} == {1: 2, 2: 2, 3: 1, 4: 0, 5: 0, 6: 0, 7: 1, 8: 4, 9: 3}
    places = {(r.claim_id, r.at) for r in postings.phrases(claims.where("claim_id < 4"), docs.limit(1)).collect()}
    assert places == {(1, 0), (1, 2), (2, 3), (3, 0)}


def test_facts_by_trigrams(spark):
    facts = spark.createDataFrame([(f"f{i}", f"Net Amount {i}", f"USD {i}", f"net amount {i}", "d", i) for i in range(40)] + [("q", "Qé", "10%", "qé", "d", 1)], "fact_id string, fact_name string, fact_value string, normalized_name string, doc_id string, page_number int")
    requests = spark.createDataFrame([(1, "d", "amount 17"), (2, "d", "usd 39 moun"), (3, "d", "%"), (4, "d", "qé"), (5, "e", "amount")], "request_id int, doc_id string, query string")
    plain, indexed = (sorted((r.request_id, r["rank"], r.fact_id, r.score) for r in retrieval.fact_lookup(requests, facts, postings=p).collect()) for p in (None, retrieval.fact_postings(facts)))
    assert plain == indexed and {r[0] for r in plain} == {1, 2, 3, 4}


# Chunking, summaries, languages


def test_a_run_of_many_lines(spark):
    def lines(n, role="text"):
        box = F.struct(*[F.lit(0.0).alias(c) for c in ("x0", "y0", "x1", "y1")])
        text = F.concat(F.lpad(F.col("id").cast("string"), 8, "0"), F.lit(" some words of a plain line, which goes on" * 4))
        return spark.range(n).select(F.lit("d").alias("doc_id"), F.lit(1).alias("run"), F.lit(role).alias("role"), F.lit("s").alias("section"), F.lit(1).alias("section_ord"), (F.col("id") + 1).cast("int").alias("ord"), text.alias("text"), (F.col("id") / 40).cast("int").alias("page_number"), box.alias("box"))

    start = time.perf_counter()
    row = chunking.packed(lines(100_000)).agg(F.count("*").alias("n"), F.sum("n_blocks").alias("blocks"), F.max("parts").alias("parts"), F.min("part").alias("first")).first()
    assert (row.n, row.blocks, row.parts, row.first) == (25_000, 100_000, 25_000, 1)
    assert time.perf_counter() - start < 60


def test_packs_match_a_plain_fold(spark):
    rng = np.random.default_rng(3)
    tokens = [int(x) for x in rng.integers(0, 90, 700)] + [500, 1, 500]
    want, held, pack = [], 0, 0
    for t in tokens:
        if not pack or held + t > 100:
            pack, held = pack + 1, 0
        held += t
        want.append(pack)
    df = spark.createDataFrame([(tokens,), ([],)], "t array<int>")
    assert [r.p for r in df.select(chunking.pack_numbers(F.col("t"), 100).alias("p")).collect()] == [want, []]


def test_central_sentences(spark):
    text = "Cats like milk and fish. Dogs bark. Cats and dogs like fish. Rain fell. Fish like milk. Rain fell"
    rows = [("d", "s", "1", 1, "c1", "section_text", text), ("d", "s", "1", 2, "c2", "section_header", "Cats like milk"), ("d", "t", "2", 3, "c3", "section_text", "Only one")]
    found = {r.section_id: r for r in indexing.central_summaries(spark.createDataFrame(rows, "doc_id string, section_id string, sort_path string, n int, chunk_id string, chunk_type string, content string")).collect()}
    assert found["s"].summary == "Cats like milk and fish. Cats and dogs like fish. Fish like milk" and found["s"].sources == ["c1"]
    assert found["t"].summary == "Only one"


def test_language_profiles_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 10 < 2")
    found = language_profiles.identified(docs, docs.where("doc_id % 5 <> 0")).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 5 = 0 and code <> 'und'")
    row = found.agg(F.count("*").alias("n"), F.count_if(F.col("code") == F.col("lang")).alias("right")).first()
    assert row.n > 900 and row.right >= 0.98 * row.n
    none = language_profiles.identified(spark.createDataFrame([(1, None), (2, "12 !"), (3, "abc")], "doc_id int, text string"), docs.limit(0)).collect()
    assert {(r.code, r.confidence) for r in none} == {("und", 0.5)}


# Store


def rows_of(spark, first, end, what):
    return spark.range(first, end).select(F.concat(F.lit("d"), F.col("id")).alias("doc_id"), F.col("id").alias("n"), F.lit(what).alias("what"))


def test_store(spark, tmp_path, monkeypatch):
    first = rows_of(spark, 0, 300, "one")
    store = Store(spark, f"file://{tmp_path}/s", first.schema, most_bytes=2000)
    assert store.read().count() == 0 and store.load(["d1"]).count() == 0
    store.replace(first)
    before = store.read()
    store.replace(rows_of(spark, 300, 320, "two"))  # other documents
    assert store.read().count() == 320
    known = {r.bucket: sorted(r.files) for r in store.snapshot().collect()}
    assert len(known) > 4
    store.replace(rows_of(spark, 7, 8, "three"), rows_of(spark, 7, 8, "").select("doc_id"))
    after = {r.bucket: sorted(r.files) for r in store.snapshot().collect()}
    # One document touches one bucket.
    assert set(known) == set(after) and sum(known[b] != after[b] for b in known) == 1
    assert {(r.n, r.what) for r in store.load(["d7", "d8", "zz"]).collect()} == {(7, "three"), (8, "one")}
    plan = store.load(["d7"])._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = ", plan)
    assert {r.error for r in store.missing(spark.createDataFrame([("d7",), ("zz",)], "doc_id string"), "missing_ldu_cache").collect()} == {"missing_ldu_cache"}

    # A writer that dies before its manifest is there changes nothing; one that began earlier is refused.
    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", dies)
        with pytest.raises(KeyboardInterrupt):
            store.replace(rows_of(spark, 0, 100, "lost"))
    assert store.read().where("what = 'lost'").count() == 0 and store.read().count() == 320
    late = Store(spark, f"file://{tmp_path}/s", first.schema, most_bytes=2000)
    with monkeypatch.context() as m:
        m.setattr(Store, "versions", lambda _: [1])
        with pytest.raises(Conflict):
            late.replace(rows_of(spark, 1, 2, "late"))
    assert before.count() == 300 and {r.what for r in before.select("what").distinct().collect()} == {"one"}
    assert store.read(2).count() == 320

    store.replace(rows_of(spark, 0, 0, ""), rows_of(spark, 0, 310, "").select("doc_id"))
    full = store.snapshot().count()
    wide = Store(spark, store.path, first.schema, most_bytes=20000)
    while wide.compact():
        pass
    assert store.snapshot().count() < full and store.read().count() == 10
    assert store.vacuum() > 0 and len(store.versions()) == 1 and store.read().count() == 10
    store.replace(rows_of(spark, 5, 6, "again"))
    assert store.read().count() == 11


# Streams


def test_ledger_rows_with_null_keys_merge(spark, tmp_path):
    rows = [(1, "2024-01-01 00:10:00", None, 1.0), (2, "2024-01-01 00:20:00", None, 2.0), (3, "2024-01-01 00:30:00", "a", 4.0)]
    for r in rows:
        spark.createDataFrame([r], "event_id int, ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id int, ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = {(r.event_type, r.entries, r.total) for r in ledgers.drained(ledgers.windowed(stream)).collect()}
    assert found == {(None, 2, 3.0), ("a", 1, 4.0)}


def test_escalation_stream(spark, tmp_path):
    at = lambda minutes: 1_700_000_000 + 60 * minutes
    fast, lay, vis = "fast_text", "layout_aware", "vision"
    files = [
        [(1, at(0), fast, lay, 0.9, True, 0.01), (2, at(0), fast, fast, 0.2, True, 0.001), (3, at(1), fast, fast, 0.8, True, 0.001), (4, at(1), vis, vis, 0.1, False, 0.02)],
        [(1, at(5), fast, fast, 0.1, True, 0.001), (1, at(6), fast, fast, 0.99, True, 0.001), (3, at(7), fast, fast, 0.1, True, 9.0), (5, at(7), lay, lay, 0.1, True, 0.2), (5, at(7), lay, vis, 0.9, True, 0.01)],
        # Far later: the watermark closes what still waits. The second event comes too late.
        [(6, at(3000), fast, fast, 0.9, True, 0.001)], [(2, at(2), fast, lay, 0.9, True, 0.01), (6, at(3001), fast, fast, 0.9, True, 0.001)],
    ]
    for rows in files:
        df = spark.createDataFrame(rows, "doc_id long, s long, start string, strategy string, confidence double, has_document boolean, cost double")
        df.select("doc_id", F.timestamp_seconds("s").alias("ts"), "start", "strategy", "confidence", "has_document", "cost").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # files are read in the order of their times
    found = {(r.doc_id, r.attempt): (r.strategy, round(r.budget_spent, 6), r.accepted, r.error) for r in escalation.drained(spark, str(tmp_path / "in")).collect()}
    assert found == {
        (1, 1): (fast, 0.001, False, None), (1, 2): (lay, 0.011, True, None), (2, 1): (fast, 0.001, False, None), (2, 2): (lay, 0.001, False, "provider_timeout"), (3, 1): (fast, 0.001, True, None),
        (4, 1): (vis, 0.02, False, "all_strategies_below_threshold"), (5, 1): (lay, 0.2, False, None), (5, 2): (vis, 0.2, False, "budget_cap_exceeded"), (6, 1): (fast, 0.001, True, None),
    }
