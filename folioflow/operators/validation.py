"""Fail-closed validation: rules as rows, the first violation of a document is its error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules in the order in which a chunk is checked. The error codes.
CODES = (
    "missing_required_fields",
    "missing_page_refs",
    "missing_parent_section",
    "table_header_missing",
    "table_header_not_repeated",
    "figure_caption_missing",
    "numbered_list_items_missing",
    "numbered_list_continuity_missing",
    "relationship_target_missing",
    "table_reference_not_resolved",
    "figure_reference_not_resolved",
    "section_reference_not_resolved",
)


def violations(chunks: DataFrame, edges: DataFrame) -> DataFrame:
    """(doc_id, n, rule, code): every rule that a chunk breaks.

    ``edges`` has doc_id, chunk_id, edge_type, target and resolved. Edge facts are
    gathered per chunk first (one row per chunk), so chunks and edges are joined once.
    """
    known = chunks.select("doc_id", F.col("chunk_id").alias("target"), F.lit(True).alias("known"))
    facts = edges.join(known, ["doc_id", "target"], "left").groupBy("doc_id", "chunk_id").agg(
        F.bool_or(F.col("resolved") & F.col("known").isNull()).alias("dangling"), *[F.bool_or(F.col("edge_type") == f"references_{k}").alias(f"to_{k}") for k in ("table", "figure", "section")]
    )
    c = chunks.join(facts, ["doc_id", "chunk_id"], "left")
    table = F.col("chunk_type").isin("table", "table_segment")
    header = F.array_join("headers", " | ")
    empty = F.coalesce(F.size("headers"), F.lit(0)) <= 0
    refers = lambda word, k: F.col("content").contains(f"{word} ") & ~F.coalesce(F.col(f"to_{k}"), F.lit(False))
    listed = F.col("chunk_type").isin("numbered_list", "list_segment")
    broken = (
        (F.coalesce(F.length("content"), F.lit(0)) == 0) | F.col("content_hash").isNull(),
        F.coalesce(F.size("pages"), F.lit(0)) <= 0,
        F.col("section_ord").isNotNull() & (F.coalesce(F.length("section"), F.lit(0)) == 0),
        table & empty,
        table & ~empty & (F.col("row_count") > 0) & ~F.col("content").contains(header),
        (F.col("chunk_type") == "figure") & F.col("caption").isNotNull() & (F.length("caption") == 0),
        listed & (F.coalesce("list_items", F.lit(0)) <= 0),
        (F.col("chunk_type") == "list_segment") & (F.col("parts") <= 1),
        F.coalesce("dangling", F.lit(False)),
        refers("Table", "table"),
        refers("Figure", "figure"),
        refers("Section", "section"),
    )
    marks = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(code).alias("code"), F.coalesce(b, F.lit(False)).alias("broken")) for i, (code, b) in enumerate(zip(CODES, broken))])
    rows = c.select("doc_id", "n", F.explode(F.filter(marks, lambda m: m["broken"])).alias("m"))
    return rows.select("doc_id", "n", "m.rule", "m.code")


def errors(docs: DataFrame, chunks: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, error) of every document that fails: its first violation, or no chunk at all."""
    first = found.groupBy("doc_id").agg(F.min_by("code", F.struct("n", "rule")).alias("error"))
    none = docs.select("doc_id").distinct().join(chunks.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("error", F.lit("no_ldus_emitted"))
    return first.unionByName(none)


def dangling(edges: DataFrame, chunks: DataFrame) -> DataFrame:
    """Resolved edges whose target does not exist."""
    return edges.where("resolved").join(chunks.select("doc_id", F.col("chunk_id").alias("target")), ["doc_id", "target"], "left_anti")


#: What a section may say that it holds.
SUPPORTED_TYPES = ("tables", "figures", "equations", "lists", "narrative_text")
STRATEGIES = ("fast_text", "layout_aware", "vision")


def _broken(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, code) of every rule that a row breaks; a rule without an answer is not broken."""
    marks = F.array(*[F.when(F.coalesce(b, F.lit(False)), F.lit(code)) for code, b in rules.items()])
    return rows.select(key, F.explode(F.array_compact(marks)).alias("code"))


def index_violations(sections: DataFrame, documents: DataFrame) -> DataFrame:
    """(section_id, code) of sections and (doc_id, code) of documents that break a rule of the page index.

    ``sections`` has section_id, doc_id, parent_id, page_start, page_end, data_types;
    ``documents`` has doc_id and section_count. Both come as (key, code).
    """
    parents = sections.select(F.col("section_id").alias("parent_id"), F.col("doc_id").alias("parent_doc"))
    known = sections.join(parents, "parent_id", "left")
    types = F.col("data_types")
    of_sections = _broken(
        known,
        "section_id",
        {
            "page_order": F.col("page_start") > F.col("page_end"),
            "data_types_not_unique": F.size(types) != F.size(F.array_distinct(types)),
            "data_types_not_supported": F.size(F.array_except(types, F.array(*map(F.lit, SUPPORTED_TYPES)))) > 0,
            "parent_missing": F.col("parent_id").isNotNull() & F.col("parent_doc").isNull(),
            "parent_of_other_document": F.col("parent_doc") != F.col("doc_id"),
        },
    )
    counts = sections.groupBy("doc_id").agg(F.count("*").alias("n"))
    of_documents = _broken(documents.join(counts, "doc_id", "left"), "doc_id", {"section_count": F.coalesce("n", F.lit(0)) != F.col("section_count")})
    return of_sections.withColumnRenamed("section_id", "key").unionByName(of_documents.withColumnRenamed("doc_id", "key"))


def bound_violations(profiles: DataFrame, attempts: DataFrame) -> DataFrame:
    """(key, code) of profiles and attempts that are out of bounds."""
    share = lambda c: (F.col(c) < 0) | (F.col(c) > 1)
    of_profiles = _broken(profiles, "doc_id", {"language_code": ~F.length("code").between(2, 8), "language_confidence": share("confidence")})
    rules = {
        "attempt_index": F.col("attempt") < 1,
        "attempt_confidence": share("confidence"),
        "attempt_cost": F.col("cost") < 0,
        "attempt_strategy": ~F.col("strategy").isin(*STRATEGIES),
    }
    of_attempts = _broken(attempts, "doc_id", rules)
    text = lambda df: df.select(F.col("doc_id").cast("string").alias("key"), "code")
    return text(of_profiles).unionByName(text(of_attempts))


def result_violations(found: DataFrame) -> DataFrame:
    """(request_id, code) of results that contradict themselves: status, provenance, path, explanation.

    ``found`` has request_id, status, answer, path (array) and provenance (array of structs).
    """
    none = F.coalesce(F.size("provenance"), F.lit(0)) <= 0
    return _broken(
        found,
        "request_id",
        {
            "supported_without_provenance": (F.col("status") == "supported") & none,
            "path_empty": F.coalesce(F.size("path"), F.lit(0)) <= 0,
            "path_not_unique": F.size("path") != F.size(F.array_distinct("path")),
            "explanation_missing": F.coalesce(F.length("answer"), F.lit(0)) == 0,
            "provenance_not_traceable": F.exists("provenance", lambda p: p["evidence_id"].isNull()),
        },
    )


def edge_violations(edges: DataFrame) -> DataFrame:
    """(chunk_id, code): resolved edges need a target, others a label."""
    return _broken(edges, "chunk_id", {"resolved_without_target": F.col("resolved") & F.col("target").isNull(), "unresolved_without_label": ~F.col("resolved") & F.col("label").isNull()})


def missing_stages(docs: DataFrame, extracted: DataFrame, chunks: DataFrame, requests: DataFrame) -> DataFrame:
    """(doc_id, error): documents that a stage cannot take: nothing extracted, no chunks, or no request.

    ``chunks`` has doc_id and ``of``, the document that the chunks were handed in for:
    chunks of another document fail it as a whole.
    """
    ids = lambda df: df.select("doc_id").distinct()
    lost = lambda df, error: ids(docs).join(ids(df), "doc_id", "left_anti").withColumn("error", F.lit(error))
    of = chunks.groupBy(F.col("of").alias("doc_id")).agg(F.bool_or(F.col("doc_id") != F.col("of")).alias("strange"))
    strange = of.where("strange").select("doc_id", F.lit("mixed_document_ids").alias("error"))
    none = lost(chunks.select(F.col("of").alias("doc_id")), "missing_chunked_document")
    return lost(extracted, "missing_extracted_document").unionByName(none).unionByName(strange).unionByName(lost(requests, "missing_query_request"))


def summary_sources(asked: Column, used: Column) -> Column:
    """Sources of a summary that were asked for, in the order of the request; all of them where none is left."""
    kept = F.filter(asked, lambda s: F.array_contains(used, s))
    return F.when(F.size(kept) > 0, kept).otherwise(asked)
