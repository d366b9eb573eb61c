"""Answers and audits with provenance, from evidence that retrieval found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.postings import phrases
from folioflow.operators.retrieval import best_of


#: Tools of a retrieval path. Fixed values.
TOOLS = ("pageindex_navigate", "semantic_search", "structured_query")
#: Evidence that an answer looks at: sections of the last navigations, chunks, facts; an audit takes six each.
LAST_NAVIGATIONS, HEAD_SECTIONS, HEAD_HITS, HEAD_AUDIT = 2, 5, 8, 6
NOTHING_FOUND = "No supporting evidence was found for this question in the available document artifacts."


def provenance(requests: DataFrame, fact_hits: DataFrame, chunk_hits: DataFrame) -> DataFrame:
    """(request_id, evidence_id, kind, document_name, page_number, content_hash, section_id, ord): chunks first, then facts.

    Of hits that share an id the best stays, the earlier one in ties.
    """
    of = lambda df, c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    name = lambda df: F.coalesce(of(df, "document_name"), of(df, "doc_id"))
    chunk = chunk_hits.select(
        "request_id", F.col("chunk_id").alias("evidence_id"), F.lit("chunk").alias("kind"), name(chunk_hits).alias("document_name"), F.array_min("pages").alias("page_number"), "content_hash", of(chunk_hits, "section_id").alias("section_id"), F.col("rank").alias("ord")
    )
    fact = fact_hits.select(
        "request_id", F.col("fact_id").alias("evidence_id"), F.lit("fact").alias("kind"), name(fact_hits).alias("document_name"), "page_number", "content_hash", of(fact_hits, "section_id").alias("section_id"), (F.col("rank") + 1000).alias("ord")
    )
    every = chunk.unionByName(fact).withColumn("minus", -F.col("ord"))
    return best_of(requests.select("request_id").join(every, "request_id"), ["request_id", "evidence_id"], "minus", "ord").drop("minus")


def cited(answers: DataFrame, index: DataFrame) -> DataFrame:
    """Citations (request_id, citations array) resolved, with their place ``pos``; unknown ids drop out, repeats stay."""
    ids = answers.select("request_id", F.posexplode("citations").alias("pos", "evidence_id"))
    return ids.join(index.drop("ord"), ["request_id", "evidence_id"])


def results(requests: DataFrame, evidence: DataFrame) -> DataFrame:
    """One result per request: supported with provenance, else not_found.

    A claimed support without any resolvable citation counts as unverifiable.
    """
    gathered = evidence.groupBy("request_id").agg(
        F.count("*").alias("n_evidence"), F.count_if(F.col("kind") == "fact").alias("n_facts"), F.min_by("evidence_id", "ord").alias("first_evidence"), F.array_sort(F.collect_set("page_number")).alias("pages")
    )
    joined = requests.join(gathered, "request_id", "left")
    status = F.when(F.coalesce("n_evidence", F.lit(0)) == 0, "not_found").when(F.size("pages") == 0, "unverifiable").otherwise("supported")
    return joined.withColumn("status", status)


def known_path(path: Column, preferred: Column) -> Column:
    """A retrieval path with known tools only, each once; the preferred one where none is left."""
    kept = F.array_distinct(F.filter(path, lambda p: p.isin(*TOOLS)))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.coalesce(preferred, F.lit(TOOLS[0]))))


def evidence_heads(navigations: DataFrame, chunk_hits: DataFrame, fact_hits: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What an answer looks at: the first sections of the last navigations (``call`` numbers them), the first chunks and facts."""
    w = Window.partitionBy("request_id")
    last = navigations.withColumn("_last", F.max("call").over(w)).where((F.col("call") > F.col("_last") - LAST_NAVIGATIONS) & (F.col("rank") <= HEAD_SECTIONS)).drop("_last")
    return last, chunk_hits.where(F.col("rank") <= HEAD_HITS), fact_hits.where(F.col("rank") <= HEAD_HITS)


def drafts(chunk_hits: DataFrame, fact_hits: DataFrame) -> DataFrame:
    """(request_id, answer, citations): facts as ``name = value``, else the first line of the best chunk.

    A model-backed draft takes the same evidence and gives the same columns.
    """
    facts = fact_hits.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("rank", "fact_id", F.concat("fact_name", F.lit(" = "), "fact_value").alias("line")))).alias("f"))
    chunks = chunk_hits.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", F.substring_index("content", "\n", 1).alias("line")))).alias("c"))
    both = facts.join(chunks, "request_id", "full")
    told = F.when(F.size("f") > 0, F.array_join(F.transform("f", lambda x: x["line"]), "; ")).otherwise(F.get("c", F.lit(0))["line"])
    ids = F.when(F.size("f") > 0, F.transform("f", lambda x: x["fact_id"])).otherwise(F.transform("c", lambda x: x["chunk_id"]))
    return both.select("request_id", told.alias("answer"), ids.alias("citations"))


def finalized(requests: DataFrame, paths: DataFrame, navigations: DataFrame, chunk_hits: DataFrame, fact_hits: DataFrame) -> DataFrame:
    """The result of every request: status, answer, path, matched sections and facts, and provenance in order of citation.

    ``requests`` has request_id and preferred; ``paths`` has request_id and path.
    """
    _, chunk_head, fact_head = evidence_heads(navigations, chunk_hits, fact_hits)
    draft = drafts(chunk_head, fact_head)
    found = cited(draft, provenance(requests, fact_hits, chunk_hits))
    item = F.struct("pos", "evidence_id", "kind", "document_name", "page_number", "content_hash", "section_id")
    chain = found.groupBy("request_id").agg(F.array_sort(F.collect_list(item)).alias("provenance"))
    rows = requests.join(paths, "request_id", "left").join(draft, "request_id", "left").join(chain, "request_id", "left")
    cites = F.coalesce(F.size("provenance"), F.lit(0)) > 0
    of = lambda kind, c: F.array_sort(F.array_distinct(F.transform(F.filter("provenance", lambda p: p[c].isNotNull() & (p["kind"] == kind if kind else F.lit(True))), lambda p: p[c])))
    none = F.array().cast("array<string>")
    return rows.select(
        *requests.columns,
        F.when(F.col("answer").isNull(), "not_found").when(cites, "supported").otherwise("unverifiable").alias("status"),
        F.coalesce("answer", F.lit(NOTHING_FOUND)).alias("answer"),
        known_path(F.coalesce("path", none), F.col("preferred")).alias("path"),
        F.coalesce(of(None, "section_id"), none).alias("matched_section_ids"),
        F.coalesce(of("fact", "evidence_id"), none).alias("matched_fact_ids"),
        "provenance",
    )


def audited(claims: DataFrame, fact_hits: DataFrame) -> DataFrame:
    """Claims (request_id, claim) against facts found for them: request_id, status, explanation and citations.

    A claim is supported by the facts whose value it states; found facts that it does not
    state leave it unverifiable, and without facts it is not found.
    """
    head = fact_hits.where(F.col("rank") <= HEAD_AUDIT).join(claims.select("request_id", "claim"), "request_id")
    states = F.lower("claim").contains(F.lower("fact_value"))
    seen = head.groupBy("request_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(states, F.col("fact_id")))).alias("citations"))
    rows = claims.select("request_id").join(seen, "request_id", "left").withColumn("citations", F.coalesce("citations", F.array().cast("array<string>")))
    status = F.when(F.col("n").isNull(), "not_found").when(F.size("citations") > 0, "supported").otherwise("unverifiable")
    told = F.when(status == "not_found", "No evidence was found for this claim.").when(status == "supported", "Facts of the document state this claim.").otherwise("The facts that were found do not state this claim.")
    return rows.select("request_id", status.alias("status"), told.alias("explanation"), "citations")


def audit(claims: DataFrame, docs: DataFrame) -> DataFrame:
    """Which claims (claim_id, text) are backed by documents (doc_id, text), word for word.

    Words end at white space on both sides; letter case and the kind of white space do not
    matter. Claims without text find nothing. Claims that share an id are one claim for each text,
    and each is backed by what backs any of them.
    """
    hits = phrases(claims, docs).select("claim_id", "row", "doc_id").distinct()
    backed = hits.groupBy("claim_id").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))
    return claims.select("claim_id").join(backed, "claim_id", "left").select("claim_id", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "first_doc", F.when(F.col("n_docs") > 0, "supported").otherwise("not_found").alias("status"))
