"""The stages put together: statements to chunks, edges, errors, sections, facts and vectors."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.config import Rules
from folioflow.operators import answering, chunking, facts, indexing, retrieval, validation, vectors
from folioflow.sources.accounts import HEADERS, Statements
from folioflow.sources.sinks import dealt, tasks_for, written


#: What sections and vectors read of chunks.
INDEXED = ("doc_id", "n", "chunk_id", "chunk_type", "content", "pages", "box", "section", "content_hash")


class Corpus:
    """Every stage's result over the account statements, each composed when it is asked for.

    Chunks feed all later stages, so they are written once to the shared folder: that
    cuts the plan and survives a lost executor.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, rules: Rules | None = None) -> None:
        self.spark, self.rules = spark, rules or Rules()
        self.inputs = Statements(spark, sf_dir)

    @cached_property
    def tasks(self) -> int:
        """Tasks that the statements' items are dealt to, and what is made of them: a list item per order, a dozen others per account."""
        return tasks_for(self.spark, self.inputs.orders.count() + 12 * self.inputs.accounts.count())

    @cached_property
    def tables(self) -> DataFrame:
        headers = F.when(F.col("bare"), F.array().cast("array<string>")).otherwise(F.array(*map(F.lit, HEADERS)))
        return self.inputs.tables.withColumn("headers", headers)

    @cached_property
    def cells(self) -> DataFrame:
        return self.inputs.orders.select("doc_id", F.lit("t1").alias("table_id"), "i", F.array("order_id", "status", "total", "day").alias("cells"))

    @cached_property
    def items(self) -> DataFrame:
        return chunking.sections(chunking.items(self.inputs.blocks, self.tables, self.inputs.figures, self.rules.chunking.headings, self.tasks), chunking.READING)

    @cached_property
    def chunks(self) -> DataFrame:
        ordered = written(chunking.runs(self.items, chunking.READING), "items", many=True)
        return written(chunking.chunks(self.inputs.blocks, self.tables, self.cells, self.inputs.figures, self.rules.chunking, ordered, self.tasks), "chunks", many=True)

    @cached_property
    def edges(self) -> DataFrame:
        return chunking.structural_edges(self.chunks).unionByName(chunking.reference_edges(self.chunks).drop("edge_id"))

    @cached_property
    def violations(self) -> DataFrame:
        return validation.violations(self.chunks, self.edges)

    @cached_property
    def errors(self) -> DataFrame:
        return validation.errors(self.inputs.accounts.select("doc_id"), self.chunks, self.violations)

    @cached_property
    def sections(self) -> DataFrame:
        return indexing.tree(indexing.headers(self.chunks, self.tasks), self.chunks, self.tasks)

    @cached_property
    def members(self) -> DataFrame:
        return indexing.members(self.sections, self.chunks, self.tasks)

    @cached_property
    def page_index(self) -> DataFrame:
        """Sections with ranges, entities, data types and summary, ready for retrieval."""
        m, key = self.members, ["doc_id", "section_id"]
        named = indexing.entities(m, self.rules.index, self.tasks).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("rank", "entity"))).alias("e"))
        named = named.select(*key, F.transform("e", lambda e: e["entity"]).alias("entities"))
        index = indexing.ranges(self.sections, m, self.tasks).join(named, key, "left").join(indexing.data_types(m), key, "left").join(indexing.summaries(m, self.rules.index), key, "left")
        return index.withColumn("entities", F.coalesce("entities", F.array().cast("array<string>")))

    @cached_property
    def facts(self) -> DataFrame:
        return facts.facts(self.chunks)

    @cached_property
    def located_facts(self) -> DataFrame:
        """Facts with the sections that they stand in."""
        return facts.facts(facts.with_sections(self.chunks, self.sections, "section"), more=("section_id",))

    @cached_property
    def vectors(self) -> DataFrame:
        return vectors.ingested(self.chunks, self.members)

    def lookup(self, requests: DataFrame, limit: int = 5) -> DataFrame:
        """The facts of requests (request_id, doc_id, query), best first."""
        return retrieval.chunk_lookup(requests, self.chunks, limit, self.rules.query, self.tasks)

    def about(self, documents: DataFrame) -> Corpus:
        """A corpus with the chunks of some documents (doc_id), for what sections and vectors are made of."""
        part = Corpus(self.spark, self.inputs.sf_dir, self.rules)
        part.inputs, part.tasks = self.inputs, self.tasks
        ids = dealt(documents.select("doc_id").distinct(), self.tasks, "doc_id")
        part.chunks = written(dealt(self.chunks.select(*INDEXED), self.tasks, "doc_id").join(ids, "doc_id", "left_semi"), "chunks", many=True)
        part.members = written(indexing.members(part.sections, part.chunks, part.tasks), "members", many=True)
        return part

    def answers(self, requests: DataFrame) -> DataFrame:
        """Questions (request_id, doc_id, query) answered from the documents that they are about.

        Questions for facts look facts up first. The others, and those that find no fact,
        go to the sections that fit and to the nearest chunks of these; only the documents that
        these are about are indexed.
        """
        asked = written(requests.withColumn("preferred", retrieval.preferred_path(F.col("query"))), "requests", many=True)
        hits = written(self.lookup(asked.where("preferred = 'structured_query'")), "fact-hits", many=True)
        rows = written(facts.with_sections(hits, self.sections), "fact-hits", many=True)
        rest = written(asked.join(rows.select("request_id").distinct(), "request_id", "left_anti"), "requests", many=True)
        part = self.about(rest)
        found = written(retrieval.navigate(rest.withColumnRenamed("query", "topic"), part.page_index).withColumn("call", F.lit(1)), "navigations", many=True)
        hits = written(vectors.search(rest, part.vectors, part.chunks, narrow=found.select("request_id", "section_id")), "chunk-hits", many=True)
        used = rest.select("request_id", F.lit(True).alias("read"))
        steps = F.array_compact(F.array(F.when(F.col("preferred") == "structured_query", F.lit("structured_query")), F.when(F.col("read"), F.lit("pageindex_navigate")), F.when(F.col("read"), F.lit("semantic_search"))))
        paths = asked.join(used, "request_id", "left").select("request_id", steps.alias("path"))
        return answering.finalized(asked, paths, found, hits, rows)
