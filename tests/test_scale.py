"""What must hold so that work and memory grow with the input."""

import json
import time

from pyspark.sql import Row
from pyspark.sql import functions as F

from folioflow.config import ChunkRules, ExtractionRules
from folioflow.operators import chunking, facts, indexing, language_profiles, payloads, retrieval, triage
from folioflow.plans.pipeline import Corpus
from folioflow.sources import pages as sp
from folioflow.sources import sinks
from folioflow.streaming import escalation

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sections_do_not_pass_through_the_driver(spark):
    """Files of sections are a fortieth of their rows, so that Spark's size check lets them in."""
    c = Corpus(spark, SMALL)
    for rows in (c.members, c.vectors, c.located_facts):
        assert "BroadcastHashJoin" not in plan(rows), plan(rows)


def test_items_are_sorted_once(spark):
    c = Corpus(spark, SMALL)
    assert plan(chunking.runs(c.items, chunking.READING)).count("Sort [") == 1


def test_a_run_that_fits_is_one_pack_and_others_are_cut(spark):
    rows = [(d, i, 1, "text", "s", 0, "a b c", 1, (0.0, 0.0, 1.0, 1.0)) for d, n in (("fits", 3), ("long", 5)) for i in range(n, 0, -1)]
    schema = "doc_id string, ord int, run long, role string, section string, section_ord int, text string, page_number int, box struct<x0 double, y0 double, x1 double, y1 double>"
    found = chunking.packed(spark.createDataFrame(rows, schema), ChunkRules(chunk_tokens=9)).collect()
    assert sorted((r.doc_id, r.part, r.parts, r.ord, r.n_blocks, r.tokens, r.content.count("\n")) for r in found) == [("fits", 1, 1, 1, 3, 9, 2), ("long", 1, 2, 1, 3, 9, 2), ("long", 2, 2, 4, 2, 6, 1)]


def test_escalation_state_takes_few_messages():
    """A bucket of documents costs one read and one write of its state a batch, and one timer."""
    calls = []

    class State:
        held = None

        def exists(self):
            calls.append("exists")
            return self.held is not None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, row):
            calls.append("update")
            self.held = row

        def clear(self):
            calls.append("clear")
            self.held = None

    class Handle:
        getValueState = lambda self, *_: State()
        listTimers = lambda self: calls.append("list") or iter(())
        deleteTimer = lambda self, _: calls.append("delete")
        registerTimer = lambda self, at: calls.append(("timer", at))

    class Clock:
        now = 0
        getCurrentWatermarkInMs = lambda self: self.now

    ladder, clock = escalation.Ladder(ExtractionRules(), 0.01), Clock()
    ladder.init(Handle())
    event = lambda ms, strategy, has, doc_id=1: Row(doc_id=doc_id, ms=ms, start="fast_text", strategy=strategy, confidence=0.9, has_document=has, cost=0.01)
    assert [r.doc_id for r in ladder.handleInputRows((7,), iter([event(1000, "fast_text", False), event(3000, "fast_text", False, 2)]), clock)] == [1, 2]
    assert list(ladder.handleInputRows((7,), iter([event(5000, "vision", True)]), clock)) == []
    assert calls == ["get", ("timer", 1000 + escalation.WAIT), "update", "get", "update"]
    # The first timer is early for document 1, which was heard of since, and for document 2.
    clock.now = 1000 + escalation.WAIT
    assert list(ladder.handleExpiredTimer((7,), clock, None)) == []
    assert calls[-3:] == ["get", ("timer", 3000 + escalation.WAIT), "update"]
    clock.now = 3000 + escalation.WAIT
    assert [(r.doc_id, r.attempt, r.error) for r in ladder.handleExpiredTimer((7,), clock, None)] == [(2, 2, "provider_timeout")]
    clock.now = 5000 + escalation.WAIT
    assert [(r.doc_id, r.strategy, r.error) for r in ladder.handleExpiredTimer((7,), clock, None)] == [(1, "layout_aware", "provider_timeout")]
    assert calls[-1] == "clear"


def test_sparse_tables_take_time_by_their_cells(spark):
    """The cells of a table are read once, not once a row."""
    n = 1500
    cells = [{"start_row_offset_idx": r, "start_col_offset_idx": c, "text": f"{r}-{c}"} for r in range(n) for c in (2, 0) if (r, c) != (7, 2)]
    docs = spark.createDataFrame([("d", json.dumps({"tables": [{"data": {"table_cells": cells + cells[:1]}}]}))], "doc_id string, payload string")
    began = time.monotonic()
    (found,) = payloads.normalized(docs)[2].collect()
    assert time.monotonic() - began < 20
    assert found.headers == ["0-0", "", "0-2"] and len(found.rows) == n - 1
    assert found.rows[6] == ["7-0"] and found.rows[7] == ["8-0", "", "8-2"]


def test_trigrams_of_documents_are_not_shuffled(spark, monkeypatch):
    """Where the profiles fit, one row a document is; both ways give the same."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").unionByName(spark.createDataFrame([(-1, None, None, None, 0), (-2, "12", "xx", None, 0), (-3, "\u4e00\u4e01 \u4e02", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    handed = language_profiles.identified(docs, docs.where("doc_id % 5 <> 0"))
    assert "gram" not in plan(handed)
    monkeypatch.setattr(language_profiles, "MOST_GAINS", 0)
    joined = language_profiles.identified(docs, docs.where("doc_id % 5 <> 0"))
    told = lambda df: sorted((r.doc_id, r.code, round(r.confidence, 6)) for r in df.collect())
    assert told(handed) == told(joined)


def _facts_and_requests(spark):
    found = spark.createDataFrame([(f"f{i}", f"Net {n} {i}", f"USD {i}", f"net {n} {i}", "d", i) for i in range(20) for n in ("amount" if i % 4 else "date",)] + [("n", None, None, "date", "d", 1)], "fact_id string, fact_name string, fact_value string, normalized_name string, doc_id string, page_number int")
    return found, spark.createDataFrame([(1, "d", "date"), (2, "e", "amount"), (3, "d", "usd 13")], "request_id int, doc_id string, query string")


def test_only_postings_that_are_asked_for_are_stored(spark):
    found, requests = _facts_and_requests(spark)
    some = retrieval.fact_postings(found, requests)
    assert {r.gram for r in some.collect()} <= {"dat", "ate", "usd"} and some.count() < retrieval.fact_postings(found).count() / 4
    told = lambda p: sorted((r.request_id, r["rank"], r.fact_id, r.score) for r in retrieval.fact_lookup(requests, found, postings=p).collect())
    assert told(some) == told(None) != []


def test_facts_without_a_term_are_not_handed_to_the_tool(spark):
    found, requests = _facts_and_requests(spark)
    pairs = requests.join(found, "doc_id")
    left = {(r.request_id, r.fact_id) for r in retrieval.with_terms(pairs).collect()}
    assert left == {(1, f"f{i}") for i in range(0, 20, 4)} | {(1, "n")} | {(3, f"f{i}") for i in range(20)}
    assert facts.facts(Corpus(spark, SMALL).chunks, facts.LOOKED_UP).columns == ["fact_id", *facts.LOOKED_UP]


def test_pages_are_placed_where_documents_are_read(spark):
    """Words are not shuffled; whole pages have the statistics that word boxes by rows give."""
    odd = [(-1, None), (-2, ""), (-3, " \n\t\n  "), (-4, "\n" * 85 + "a\u00e4\U0001f600 b  c\n"), (-5, "x " * 3000 + "\n" + "y" * 700), (None, "no id"), (-6, "z\r\n z")]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    whole = triage.placed_stats(sp.page_boxes(docs, most=5000))
    assert "Exchange" not in plan(whole)
    told = lambda df: sorted(map(str, df.collect()))
    assert told(whole) == told(triage.page_stats(sp.word_boxes(docs))) != []


def test_tokens_are_compared_with_few_words(spark):
    """Texts vote as each kind's words do by themselves; a word can count for two languages."""
    docs = spark.createDataFrame([(1, "que que der Tax the los"), (2, None)], "doc_id long, text string")
    assert [(r.code, round(r.confidence, 6)) for r in triage.language(docs).orderBy("doc_id").collect()] == [("es", round(3 / 7, 6)), ("und", triage.TriageRules().fallback_confidence)]
    filters = plan(triage.domains(docs)).count("tax")
    assert filters == 2, plan(triage.domains(docs))


def test_rows_of_a_task_do_not_grow_with_the_input(spark, monkeypatch):
    """What is sorted, joined and grouped by document is dealt by its rows, and comes out the same."""

    def told():
        c = Corpus(spark, SMALL)
        ordered = sinks.written(chunking.runs(c.items, chunking.READING), "items", many=True)
        chunks = chunking.chunks(c.inputs.blocks, c.tables, c.cells, c.inputs.figures, c.rules.chunking, ordered, c.tasks)
        made = c.items, chunks, c.members, indexing.ranges(c.sections, c.members, c.tasks), indexing.entities(c.members, tasks=c.tasks)
        rows = [sorted(map(str, df.select("doc_id", *names).collect())) for df, names in zip(made, (["block_id", "ord", "section"], ["chunk_id", "content_hash", "label"], ["section_id", "chunk_id", "content"], ["section_id", "page_start", "page_end", "n_chunks", "n_direct"], ["section_id", "rank", "entity", "score"]), strict=True)]
        return c.tasks, [plan(df) for df in made], rows

    tasks, _, rows = told()
    assert tasks == 0
    monkeypatch.setattr(sinks, "TASK_ROWS", 100)
    tasks, plans, dealt = told()
    assert tasks > 4 and tasks % spark.sparkContext.defaultParallelism == 0
    for p in plans:
        exchanges = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
        assert exchanges and all(f"{tasks}), REPARTITION_BY_NUM" in line for line in exchanges), p
    assert dealt == rows


def test_central_sentences_take_time_by_their_terms(spark):
    """No pair of sentences is met, and weights beyond 64 bits count as they are."""
    same = " ".join(f"t{i}" for i in range(1500))
    texts = {"many": ". ".join(["none", *(f"{i} said" for i in range(8000)), "said 1 2 3"]), "heavy": ". ".join(["none", *(f"{same} x{i}" for i in range(1500))]), "empty": " . ?\n"}
    rows = [("d", s, "1", 1, f"c-{s}", "section_text", text) for s, text in texts.items()] + [("d", "null", "1", 1, "c", "section_text", None)]
    members = spark.createDataFrame(rows, "doc_id string, section_id string, sort_path string, n int, chunk_id string, chunk_type string, content string")
    began = time.monotonic()
    found = {r.section_id: (r.summary.split(". "), r.sources) for r in indexing.central_summaries(members).collect()}
    assert time.monotonic() - began < 30
    assert found == {"many": (["1 said", "2 said", "said 1 2 3"], ["c-many"]), "heavy": ([f"{same} x{i}" for i in range(3)], ["c-heavy"])}


def test_facts_stay_where_their_chunks_are(spark):
    """What a chunk tells twice is one fact, by the later kind of extraction; no fact is shuffled for that."""
    rows = [("d", f"c{i}", "section_text", "Revenue: 12\nrevenue: 12\nREVENUE:  12\nTax: 12", [1], "s", "h") for i in (1, 2)] + [("d", "c3", "table", None, [1], "s", "h"), ("d", "c4", "table", "A | B\nx | 1\nX | 1\n\ny", [1], "s", "h")]
    made = spark.createDataFrame(rows, "doc_id string, chunk_id string, chunk_type string, content string, pages array<int>, section string, content_hash string")
    found = sorted((r.source_chunk_id, r.fact_name, r.normalized_name, r.extraction) for r in facts.facts(made).collect())
    assert found == [(c, n, n.lower(), e) for c in ("c1", "c2") for n, e in (("Revenue", "inline"), ("Tax", "key_value"))] + [("c4", "x B", "x b", "table")]
    assert "Exchange" not in plan(Corpus(spark, SMALL).facts)


def test_batches_of_new_documents_rewrite_nothing(spark, tmp_path):
    path, df = str(tmp_path / "store"), spark.range(300).selectExpr("cast(id as int) doc_id", "concat('v', id) v")
    files = lambda: {str(f) for f in tmp_path.rglob("*.parquet")}
    stored = lambda: sorted((r.doc_id, r.v) for r in spark.read.parquet(path).collect())
    sinks.overwrite_documents(df.where("doc_id % 2 = 0"), path)
    before = files()
    sinks.overwrite_documents(df.where("doc_id % 2 = 1"), path)
    assert before < files() and stored() == [(i, f"v{i}") for i in range(300)]
    sinks.overwrite_documents(df.where("doc_id % 5 = 0").withColumn("v", df.v.substr(1, 1)), path, df.where("doc_id = 7").select("doc_id"))
    assert stored() == [(i, "v" if i % 5 == 0 else f"v{i}") for i in range(300) if i != 7]


def test_only_chunks_are_shuffled_to_look_facts_up(spark):
    """Facts are taken where chunks meet requests: as many requests as a document has, its hits as by the facts' own join."""
    c = Corpus(spark, SMALL)
    docs = [r.doc_id for r in c.inputs.accounts.orderBy("doc_id").limit(4).collect()]
    asked = spark.createDataFrame([(i, d, q) for i, (d, q) in enumerate((d, q) for d in [*docs, "none", None] for q in ("account balance", "Which order date is 2001?", "zzz", None))], "request_id int, doc_id string, query string")
    told = lambda df: sorted(map(str, df.select("request_id", "doc_id", "query", "rank", "score", *c.facts.columns[2:]).collect()))
    found = c.lookup(asked)
    assert told(found) == told(retrieval.fact_lookup(asked, c.facts)) != []
    for rows in (found, c.located_facts):
        stages = plan(rows).split("Exchange hashpartitioning")
        assert all("fact_id" not in s.splitlines()[0] for s in stages[1:]) and "fact_id" not in stages[-1], plan(rows)


def test_only_documents_that_are_asked_are_indexed(spark):
    """A question that facts answer has no section indexed for it; the others' sections are as in the whole index."""
    c = Corpus(spark, SMALL)
    some = c.inputs.accounts.where("k % 4 = 2").select("doc_id", "k")
    part = c.about(some.union(some))
    told = lambda df: sorted(map(str, df.select("doc_id", "section_id", "title", "page_start", "page_end", "entities", "summary", "data_types").collect()))
    assert told(part.page_index) == told(c.page_index.join(some, "doc_id", "left_semi")) != []
    assert {r.doc_id for r in part.chunks.select("doc_id").distinct().collect()} == {r.doc_id for r in some.collect()}
    asked = []
    c.about = lambda documents: asked.append(documents.count()) or Corpus.about(c, documents)
    c.answers(some.select(F.col("k").alias("request_id"), "doc_id", F.when(F.col("k") % 8 == 2, "What is the revenue?").otherwise("market segment").alias("query"))).collect()
    assert asked == [some.where("k % 8 <> 2").count()]
