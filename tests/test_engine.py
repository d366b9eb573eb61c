"""Cases of the stages with known results, on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from folioflow.config import ChunkRules
from folioflow.functions import text as ft
from folioflow.operators import answering, chunking, extraction, facts, indexing, retrieval, triage, validation, vectors
from folioflow.sources import pages as sp
from folioflow.sources import sinks
from folioflow.streaming import ledgers

STATS = "doc_id string, pages int, chars long, density double, image double, font boolean, form boolean, x_clusters int, balance double, grid double"
BASE = dict(doc_id="d", pages=2, chars=1000, density=0.003, image=0.1, font=True, form=False, x_clusters=1, balance=0.0, grid=0.1)


def stats(spark, **changes):
    return spark.createDataFrame([tuple((BASE | changes).values())], STATS)


@pytest.mark.parametrize(
    "changes, expected",
    [({}, "native_digital"), ({"chars": 10, "density": 0.0001, "image": 0.8, "font": False}, "scanned_image"), ({"chars": 500, "image": 0.7}, "mixed"), ({"form": True}, "form_fillable")],
)
def test_origin(spark, changes, expected):
    assert triage.profile(stats(spark, **changes)).first().origin == expected


@pytest.mark.parametrize("changes, expected", [({}, "single_column"), ({"x_clusters": 2}, "multi_column"), ({"grid": 0.6}, "table_heavy"), ({"image": 0.6}, "figure_heavy"), ({"x_clusters": 2, "grid": 0.5}, "mixed")])
def test_layout(spark, changes, expected):
    assert triage.profile(stats(spark, **changes)).first().layout == expected


def test_cluster_count_is_anchored(spark):
    df = spark.createDataFrame([([0.0, 5.0, 10.0, 15.0],), ([],)], "p array<double>")
    assert [r[0] for r in df.select(triage.cluster_count(F.col("p"), 10.0)).collect()] == [2, 0]


def test_image_ratio_and_edges(spark):
    df = spark.createDataFrame([([(10.0, 30.0, 0.0, 30.0)], [(0.0, 0.0, 0.0, 50.0), (0.0, 50.0, 9.0, 9.0)])], "i array<struct<x0:double,x1:double,top:double,bottom:double>>, e array<struct<x0:double,x1:double,top:double,bottom:double>>")
    row = df.select(triage.image_ratio(F.col("i"), F.lit(100.0), F.lit(200.0)).alias("r"), triage.edge_density(F.col("e"), F.lit(10)).alias("e")).first()
    assert round(row.r, 6) == 0.03 and row.e == 0.5


def test_domains_and_language(spark):
    df = spark.createDataFrame([("a", "Invoice tax summary"), ("b", "nothing here"), ("c", None)], "doc_id string, text string")
    assert {r.doc_id: r.domain for r in triage.domains(df).collect()} == {"a": "financial", "b": "general", "c": "general"}
    lang = spark.createDataFrame([("a", "the cat and the dog of it"), ("b", None)], "doc_id string, text string")
    assert {r.doc_id: r.code for r in triage.language(lang).collect()} == {"a": "en", "b": "und"}


def ladder(spark, fast, layout, vision, pages=1, start="fast_text"):
    rows = [("d", pages, start, fast, True, layout, True, vision, True)]
    schema = "doc_id string, pages int, start string, c_fast_text double, has_fast_text boolean, c_layout_aware double, has_layout_aware boolean, c_vision double, has_vision boolean"
    return extraction.outcome(extraction.attempts(spark.createDataFrame(rows, schema))).first()


def test_escalation(spark):
    assert ladder(spark, 0.2, 0.9, 0.0)[1:4] == ("layout_aware", None, 2)
    assert ladder(spark, 0.2, 0.3, 0.95)[1:4] == ("vision", None, 3)
    assert ladder(spark, 0.1, 0.1, 0.1).error == "all_strategies_below_threshold"
    assert ladder(spark, 0.1, 0.1, 0.9, pages=200).error == "budget_cap_exceeded"
    assert ladder(spark, 0.1, 0.1, 0.9, start="vision")[1:4] == ("vision", None, 1)


def test_handwriting_starts_with_vision(spark):
    df = spark.createDataFrame([("a/Handwriting.pdf",), ("a.pdf",), (None,)], "p string")
    assert [r[0] for r in df.select(extraction.start_strategy(F.lit("fast_text"), F.col("p"), F.lit("x"))).collect()] == ["vision", "fast_text", "fast_text"]


def test_cell_matrix(spark):
    cells = spark.createDataFrame([("t", 0, 0, "h1"), ("t", 0, 1, "h2"), ("t", 1, 0, "a"), ("t", 1, 1, "b"), ("t", 2, 2, "z")], "table_id string, row int, col int, text string")
    assert {r.row: r.cells for r in extraction.cell_matrix(cells).collect()} == {0: ["h1", "h2"], 1: ["a", "b"], 2: ["", "", "z"]}


def test_provider_errors_and_boxes(spark):
    df = spark.createDataFrame([("The provider is not installed",), ("Timed out",), ("conversion_failed: x",), (None,)], "m string")
    assert [r[0] for r in df.select(extraction.provider_error(F.col("m"))).collect()] == ["layout_provider_not_available", "layout_provider_timeout", "layout_provider_conversion_failed", "layout_provider_error"]
    boxes = spark.createDataFrame([({"l": 1.0, "t": 0.0, "r": 5.0},)], "b map<string,double>")
    assert boxes.select(extraction.box(F.col("b"), (0, 2, 3, 4)).alias("b")).first().b.asDict() == {"x0": 1.0, "y0": 2.0, "x1": 5.0, "y1": 4.0}


BLOCKS = [
    ("h1", 1, 0, "heading", "1 Overview"),
    ("p1", 1, 12, "paragraph", "This section summarizes the report and introduces Table 1."),
    ("l1", 1, 32, "list_item", "1. First numbered item"),
    ("l2", 1, 39, "list_item", "2. Second numbered item"),
    ("p2", 2, 0, "paragraph", "Refer to Figure 1 and Section 1 for context."),
]


def report(spark, headers=("Metric", "Value"), rules=ChunkRules()):
    blocks = spark.createDataFrame([("d", b, p, y, 0, i, k, t) for i, (b, p, y, k, t) in enumerate(BLOCKS)], "doc_id string, block_id string, page_number int, y0 int, x0 int, reading_order int, block_type string, text string")
    tables = spark.createDataFrame([("d", "t1", 1, 46, 0, "Results", list(headers))], "doc_id string, table_id string, page_number int, y0 int, x0 int, caption string, headers array<string>")
    cells = spark.createDataFrame([("d", "t1", 1, ["Revenue", "10"]), ("d", "t1", 2, ["Profit", "5"]), ("d", "t1", 3, ["Margin", "50%"])], "doc_id string, table_id string, i int, cells array<string>")
    figures = spark.createDataFrame([("d", "f1", 2, 20, 0, "Performance chart", "chart")], "doc_id string, figure_id string, page_number int, y0 int, x0 int, caption string, figure_type string")
    return chunking.chunks(blocks, tables, cells, figures, rules)


def checked(made):
    edges = chunking.structural_edges(made).unionByName(chunking.reference_edges(made).drop("edge_id"))
    return edges, validation.violations(made, edges)


def test_chunks_and_edges(spark):
    made = report(spark).cache()
    kinds = [r.chunk_type for r in made.orderBy("n").collect()]
    assert kinds == ["section_header", "section_text", "numbered_list", "table", "section_text", "figure"]
    edges, broken = checked(made)
    assert {r.edge_type for r in edges.collect()} >= {"references_table", "references_figure", "references_section", "belongs_to_section", "follows"}
    assert edges.where("not resolved").count() == 0 and broken.count() == 0


def test_table_rows_and_list_thresholds(spark):
    made = report(spark, rules=ChunkRules(table_rows=1, list_tokens=4)).cache()
    tables = made.where("chunk_type = 'table_segment'").collect()
    assert len(tables) == 3 and all("Metric | Value" in r.content for r in tables)
    assert made.where("chunk_type = 'list_segment'").count() == 2
    assert report(spark, rules=ChunkRules(list_tokens=50)).where("chunk_type = 'numbered_list'").count() == 1


def test_missing_header_fails_closed(spark):
    made = report(spark, headers=()).cache()
    _, broken = checked(made)
    docs = spark.createDataFrame([("d",), ("none",)], "doc_id string")
    assert {r.doc_id: r.error for r in validation.errors(docs, made, broken).collect()} == {"d": "table_header_missing", "none": "no_ldus_emitted"}


def test_token_count_and_packs(spark):
    row = spark.range(1).select(ft.count_tokens(F.lit("Table 1 shows steady revenue growth.")).alias("n"), chunking.packs(F.expr("array(struct(1 as ord, 5 as tokens), struct(2 as ord, 9 as tokens), struct(3 as ord, 1 as tokens))"), 6).alias("s")).first()
    assert row.n == 7 and row.s == [1, 2, 3]


def test_index_of_report(spark):
    rows = [
        ("d", 1, "d-1", "section_header", "1 Overview", [1], None), ("d", 2, "d-2", "section_text", "Acme Corp filed TABLE-001.", [1], "1 Overview"), ("d", 3, "d-3", "section_header", "1.1 Financial Results", [2], None),
        ("d", 4, "d-4", "table", "Metric | Value\nMargin | 5%", [2], "1.1 Financial Results"), ("d", 5, "d-5", "figure", "Chart", [3], "1.1 Financial Results"), ("d", 6, "d-6", "numbered_list", "1. a", [3], "1.1 Financial Results"),
        ("d", 7, "d-7", "section_text", "orphan", [9], "elsewhere"),
    ]
    made = spark.createDataFrame(rows, "doc_id string, n int, chunk_id string, chunk_type string, content string, pages array<int>, section string").cache()
    tree = indexing.tree(indexing.headers(made)).cache()
    members = indexing.members(tree, made).cache()
    found = {r.title: (r.page_start, r.page_end, r.depth) for r in indexing.ranges(tree, members).collect()}
    assert found == {"1 Overview": (1, 3, 1), "1.1 Financial Results": (2, 3, 2)}
    assert sorted(r.data_types for r in indexing.data_types(members).collect()) == [["figures", "lists", "narrative_text", "tables"]] * 2
    assert {"Acme Corp", "TABLE-001"} <= {r.entity for r in indexing.entities(members).collect()}
    assert [r.chunk_ids for r in indexing.chunk_lists(members).where("section_id like '%'").collect() if len(r.chunk_ids) == 6] == [["d-1", "d-2", "d-3", "d-4", "d-5", "d-6"]]


def test_facts_and_lookup(spark):
    rows = [("d", 1, "c1", "table", "Metric | Value\nRevenue | USD 1250000\nMargin | 32%", [2], "s", "h"), ("d", 2, "c2", "section_text", "Due Date: 2024-01-05\nBad: ", [1], "s", "h")]
    made = spark.createDataFrame(rows, "doc_id string, n int, chunk_id string, chunk_type string, content string, pages array<int>, section string, content_hash string")
    found = facts.facts(made).cache()
    by_name = {r.normalized_name: r for r in found.collect()}
    assert (by_name["revenue value"].value_type, by_name["revenue value"].unit, by_name["revenue value"].numeric_value) == ("currency", "USD", 1250000.0)
    assert (by_name["margin value"].value_type, by_name["margin value"].numeric_value) == ("percentage", 32.0)
    assert by_name["due date"].value_type == "date"
    requests = spark.createDataFrame([(1, "d", "What is the revenue?"), (2, "d", "zzz")], "request_id int, doc_id string, query string")
    hits = retrieval.fact_lookup(requests, found).collect()
    assert hits and all(r.request_id == 1 for r in hits) and hits[0].content_hash == "h"


def test_routes_and_terms(spark):
    df = spark.createDataFrame([("What is the reported revenue?",), ("Which section covers results?",)], "q string")
    assert [r[0] for r in df.select(retrieval.preferred_path(F.col("q"))).collect()] == ["structured_query", "pageindex_navigate"]
    assert df.select(retrieval.query_terms(F.col("q"))).first()[0] == ["reported", "revenue"]


def test_audit(spark):
    claims = spark.createDataFrame([(1, "one two three four five six seven eight nine"), (2, "a b c d e f g h i"), (3, None)], "claim_id int, text string")
    docs = spark.createDataFrame([(7, "x One  two three four five six seven eight nine y"), (8, None), (9, "")], "doc_id int, text string")
    assert {r.claim_id: (r.status, r.first_doc) for r in answering.audit(claims, docs).collect()} == {1: ("supported", 7), 2: ("not_found", None), 3: ("not_found", None)}


def test_audit_of_short_claims(spark):
    claims = spark.createDataFrame([(1, "Seven"), (2, "even"), (3, "six seven eight"), (4, "one two three four five six seven eight nine"), (5, " "), (6, "six eight"), (7, "two three four five six seven eight")], "claim_id int, text string")
    docs = spark.createDataFrame([(7, "x One  two three four five six seven eight nine y"), (8, "seven"), (9, ""), (10, None)], "doc_id int, text string")
    assert {r.claim_id: r.n_docs for r in answering.audit(claims, docs).collect()} == {1: 2, 2: 0, 3: 1, 4: 1, 5: 0, 6: 0, 7: 1}


def test_more_queries_than_a_block(spark):
    vectors = spark.range(1300).select(F.col("id").alias("vec_id"), F.array(F.cos(F.col("id") * 1.7), F.sin(F.col("id") * 1.7), F.lit(0.5)).cast("array<float>").alias("embedding"))
    queries = vectors.select(F.col("vec_id").alias("request_id"), F.col("embedding").alias("query_vec"))
    rows = {(r.request_id, r["rank"]): r.vec_id for r in retrieval.nearest(queries, vectors, 2).collect()}
    assert len(rows) == 2600
    some = queries.where("request_id % 20 = 0")
    assert {(r.request_id, r["rank"]): r.vec_id for r in retrieval.nearest(some, vectors, 2).collect()} == {k: x for k, x in rows.items() if k[0] % 20 == 0}


def test_html_payload(spark):
    html = '<html><style>p{}</style><title>T &amp; x</title><script>var t="</p>";</script><h1>H</h1><li><a href="x">L</a></li><p>one<br><p>two</p>'
    rows = sp.html_payload(spark.createDataFrame([(1, html), (2, None)], "page_id int, html string")).orderBy("pos").collect()
    assert [(r.block_type, r.text) for r in rows][:3] == [("title", "T & x"), ("heading", "H"), ("list_item", "L")]
    assert {r.page_id for r in rows} == {1}


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "facts")
    df = spark.createDataFrame([(i, f"v{i}") for i in range(200)], "doc_id int, v string")
    stored = lambda: {r.doc_id: r.v for r in spark.read.parquet(path).collect()}
    sinks.overwrite_documents(df, path)
    sinks.overwrite_documents(df.where("doc_id = 3").withColumn("v", F.lit("new")), path)
    assert stored() == {i: "new" if i == 3 else f"v{i}" for i in range(200)}
    sinks.overwrite_documents(spark.createDataFrame([(500, "x"), (500, "y")], "doc_id int, v string"), path, df.where("doc_id < 100").select("doc_id"))
    assert set(stored()) == {*range(100, 200), 500} and spark.read.parquet(path).count() == 102


def test_emptied_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "BUCKETS", 10**6)
    path = str(tmp_path / "facts")
    df = spark.createDataFrame([(i, "v") for i in range(5)], "doc_id int, v string")
    sinks.overwrite_documents(df, path)
    sinks.overwrite_documents(df.limit(0), path, df.where("doc_id <= 1").select("doc_id"))
    assert {r.doc_id for r in spark.read.schema("doc_id int, v string").parquet(path).collect()} == {2, 3, 4}


def test_upsert(spark):
    old = spark.createDataFrame([(i, "old", 0) for i in range(20)], "k int, v string, n int")
    new = spark.createDataFrame([(1, "a", 1), (1, "c", 3), (1, "b", 2), (99, "y", 1), (99, "z", 1)], "k int, v string, n int")
    merged = {(r.k, r.v) for r in sinks.upserted(old, new, "k", "n").collect()}
    assert merged == {(i, "old") for i in range(20) if i != 1} | {(1, "c"), (99, "z")}
    assert sinks.upserted(old, new.limit(0), "k").count() == 20 and sinks.upserted(old.limit(0), new, "k", "n").count() == 2


def test_sections_of_documents_without_headers(spark):
    rows = [("a", 1, "a-1", "section_text", "some text", [2], None), ("a", 2, "a-2", "section_text", "more", [1], None), ("b", 1, "b-1", "section_header", "1 X", [1], None), ("b", 2, "b-2", "section_header", "1.1 Y", [1], None), ("b", 3, "b-3", "section_header", "1.1.1 Z", [2], None), ("b", 4, "b-4", "section_text", "before any", [1], None)]
    made = spark.createDataFrame(rows, "doc_id string, n int, chunk_id string, chunk_type string, content string, pages array<int>, section string").cache()
    spark.conf.set("spark.sql.cteRecursionRowLimit", "10")
    tree = indexing.tree(indexing.headers(made), made).cache()
    members = indexing.members(tree, made)
    assert {(r.doc_id, r.path) for r in tree.collect()} == {("a", "Document"), ("b", "1 X"), ("b", "1 X > 1.1 Y"), ("b", "1 X > 1.1 Y > 1.1.1 Z")}
    assert {(r.doc_id, r.title): (r.page_start, r.page_end, r.n_chunks) for r in indexing.ranges(tree, members).collect()} == {("a", "Document"): (1, 2, 2), ("b", "1 X"): (1, 2, 3), ("b", "1.1 Y"): (1, 2, 2), ("b", "1.1.1 Z"): (2, 2, 1)}
    nested = {r.doc_id: json.loads(r.tree) for r in sinks.nested_json(tree).collect()}
    assert nested["b"][0]["child_sections"][0]["child_sections"][0]["title"] == "1.1.1 Z" and nested["a"][0]["child_sections"] == []
    many = spark.range(40).select(F.concat(F.lit("d"), F.col("id")).alias("doc_id"), F.lit(1).alias("n"), F.col("id").cast("string").alias("chunk_id"), F.lit("section_header").alias("chunk_type"), F.lit("1 A").alias("content"), F.array(F.lit(1)).alias("pages"), F.lit(None).cast("string").alias("section"))
    assert indexing.tree(indexing.headers(many), many).count() == 40
    spark.conf.unset("spark.sql.cteRecursionRowLimit")


def test_boxes_and_empty_tables(spark):
    made = {r.chunk_type: r.box for r in report(spark).collect()}
    assert made["table"].asDict() == {"x0": 0.0, "y0": 46.0, "x1": 0.0, "y1": 46.0}
    boxes = spark.sql("select array(named_struct('x0', 5D, 'y0', 2D, 'x1', 9D, 'y1', 3D), named_struct('x0', 1D, 'y0', 4D, 'x1', 2D, 'y1', 8D)) as b")
    assert boxes.select(chunking.box_union(F.col("b")).alias("u")).first().u.asDict() == {"x0": 1.0, "y0": 2.0, "x1": 9.0, "y1": 8.0}
    parts = spark.createDataFrame([("d", [], 0), ("d", ["h"], 0), ("d", [], 2)], "doc_id string, headers array<string>, row_count int")
    assert chunking.with_content(parts).count() == 2


def test_page_words_and_signals(spark):
    text = "ab  cde f\n" + "x " * 3000
    boxes = sp.word_boxes(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")).orderBy("top", "x0").collect()
    assert [(r.x0, r.x1) for r in boxes if r.top == 0] == [(0.0, 10.0), (20.0, 35.0), (40.0, 45.0)] and len(boxes) == 3003
    row = spark.range(1).select(triage.boundary_repeat(F.expr("array(1L, 1L, 1L, 2L, 3L, 3L)")).alias("b"), triage.table_score(F.lit(3)).alias("t")).first()
    assert round(row.b, 6) == round(1 / 3, 6) and row.t == 1.0


def test_vectors_and_answers(spark):
    rows = [("d", 1, "c1", "section_text", "Revenue grew.\nA lot", [2], "1 X", "h1"), ("d", 2, "c2", "section_text", "Nothing else", [1], None, "h2")]
    made = spark.createDataFrame(rows, "doc_id string, n int, chunk_id string, chunk_type string, content string, pages array<int>, section string, content_hash string").withColumn("box", F.expr("named_struct('x0', 0D, 'y0', 1D, 'x1', 2D, 'y1', 3D)"))
    belonging = spark.createDataFrame([("d", "c1", "s1", "1 X", True), ("d", "c1", "s0", "0", False)], "doc_id string, chunk_id string, section_id string, section_title string, direct boolean")
    store = vectors.ingested(made, belonging).cache()
    by_id = {r.vec_id: r for r in store.collect()}
    assert (by_id["c1"].section_id, by_id["c1"].bounding_box, by_id["c2"].section_id, by_id["c2"].page_refs) == ("s1", "0.0,1.0,2.0,3.0", "", "1")
    assert vectors.ingest(store, made, belonging).count() == 2
    requests = spark.createDataFrame([(1, "d", "revenue grew a lot"), (2, "x", "q")], "request_id int, doc_id string, query string")
    hits = vectors.search(requests, store, made).cache()
    assert [r.chunk_id for r in hits.orderBy("rank").collect()] == ["c1", "c2"] and hits.first().score > 0.9
    assert vectors.search(requests, store, made.where("chunk_id = 'c2'"), narrow=belonging.select(F.lit(1).alias("request_id"), "section_id")).count() == 0
    none = spark.createDataFrame([], "request_id int, fact_id string, fact_name string, fact_value string, page_number int, content_hash string, rank int")
    paths = spark.createDataFrame([(1, ["semantic_search", "guess", "semantic_search"]), (2, ["guess"])], "request_id int, path array<string>")
    asked = requests.withColumn("preferred", F.lit("structured_query"))
    found = {r.request_id: r for r in answering.finalized(asked, paths, spark.createDataFrame([], "request_id int, call int, rank int"), hits, none).collect()}
    assert (found[1].status, found[1].answer, found[1].path, found[1].matched_section_ids) == ("supported", "Revenue grew.", ["semantic_search"], ["s1"])
    assert (found[2].status, found[2].answer, found[2].path) == ("not_found", answering.NOTHING_FOUND, ["structured_query"])
    assert [p.evidence_id for p in found[1].provenance] == ["c1", "c2"] and found[1].provenance[0].document_name == "d"


def test_evidence_heads(spark):
    navigations = spark.createDataFrame([(1, c, r) for c in (1, 2, 3) for r in range(1, 8)], "request_id int, call int, rank int")
    hits = spark.createDataFrame([(1, r) for r in range(1, 12)], "request_id int, rank int")
    last, chunks, rows = answering.evidence_heads(navigations, hits, hits)
    assert {(r.call, r["rank"]) for r in last.collect()} == {(c, r) for c in (2, 3) for r in range(1, 6)} and chunks.count() == rows.count() == 8


def test_audit_with_facts(spark):
    claims = spark.createDataFrame([(1, "Margin is 32%"), (2, "Margin is 3%"), (3, "x")], "request_id int, claim string")
    hits = spark.createDataFrame([(1, "f", "32%", 1), (2, "f", "32%", 1), (2, "g", "z", 7)], "request_id int, fact_id string, fact_value string, rank int")
    assert {r.request_id: (r.status, r.citations) for r in answering.audited(claims, hits).collect()} == {1: ("supported", ["f"]), 2: ("unverifiable", []), 3: ("not_found", [])}


def test_rules_from_a_file(tmp_path):
    from folioflow.config import load_rules

    (tmp_path / "rules.yaml").write_text("chunking: {table_rows: 3}\nother: {x: 1}\n")
    assert load_rules(str(tmp_path / "rules.yaml")).chunking.table_rows == 3 and load_rules().chunking.table_rows == 20


def test_stream_over_a_ledger(spark):
    stream = ledgers.ledger_stream(spark, "/root/testdata/sf0.001/events.parquet")
    total = ledgers.drained(ledgers.windowed(stream)).agg(F.sum("entries")).first()[0]
    assert total == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
