"""The retrieval tools as polymorphic table functions, to be called from SQL.

    SELECT * FROM pageindex_navigate(TABLE(pairs) PARTITION BY (request_id), 5)

Each takes a table of candidates, one row for every request and what it may find, and gives the
best of each partition, so Spark deals out the requests. ``analyze`` says at planning what the input
lacks, clamps the limit to what the rules allow, and hands the candidates' own columns on with the
types that they have. A task holds no more than ``limit`` candidates at a time.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from folioflow.config import QueryRules
from folioflow.operators.retrieval import STOPWORDS, clamp

_TERM = re.compile("[a-z0-9]+")


def _analyzed(rows: AnalyzeArgument, limit: AnalyzeArgument | None, needed: tuple[str, ...], kept: tuple[str, ...], more: list[StructField]) -> AnalyzeResult:
    if not rows.isTable:
        raise ValueError("the first argument is TABLE(...), with a row for every request and candidate")
    known = {f.name: f for f in rows.dataType.fields}
    if missing := [c for c in needed if c not in known]:
        raise ValueError(f"the table of candidates lacks {', '.join(missing)}")
    if limit is not None and (not isinstance(limit.dataType, (IntegerType, LongType)) or limit.value is None):
        raise ValueError("the limit is a whole number that is known when the query is planned")
    return AnalyzeResult(StructType([known[c] for c in kept] + more))


class _Best:
    """The first ``limit`` candidates of a partition by an ascending key."""

    def __init__(self) -> None:
        self.heap: list[tuple] = []

    def add(self, key: tuple, row: tuple, limit: int) -> None:
        entry = (_Reversed(key), row)
        if len(self.heap) < limit:
            heapq.heappush(self.heap, entry)
        elif self.heap[0][0].key > key:
            heapq.heapreplace(self.heap, entry)

    def ranked(self) -> Iterator[tuple]:
        for rank, (_, row) in enumerate(sorted(self.heap, key=lambda e: e[0].key), 1):
            yield (*row, rank)


class _Reversed:
    def __init__(self, key: tuple) -> None:
        self.key = key

    def __lt__(self, other: "_Reversed") -> bool:
        return other.key < self.key


def _first(x):
    """Nulls come first."""
    return (x is not None, x)


def _terms(*texts: str | None) -> set[str]:
    return {t for text in texts if text for t in _TERM.findall(text.lower())}


@udtf
class PageindexNavigate:
    """Sections by the terms that they share with a topic."""

    @staticmethod
    def analyze(candidates: AnalyzeArgument, limit: AnalyzeArgument | None = None) -> AnalyzeResult:
        needed = ("request_id", "topic", "section_id", "title", "page_start", "entities", "summary", "data_types")
        return _analyzed(candidates, limit, needed, ("request_id", "section_id", "title"), [StructField("score", DoubleType()), StructField("matched", ArrayType(StringType())), StructField("rank", IntegerType())])

    def __init__(self) -> None:
        self.best = _Best()

    def eval(self, candidates, limit: int = 5) -> None:
        r = candidates
        topic = _terms(r["topic"])
        title, entities, summary, types = _terms(r["title"]), _terms(*(r["entities"] or ())), _terms(r["summary"]), set(r["data_types"] or ())
        score = 4 * len(topic & title) + 2 * len(topic & entities) + len(topic & summary) + len(topic & types)
        if score or not topic:
            row = (r["request_id"], r["section_id"], r["title"], float(score), sorted(topic & (title | entities | summary | types)))
            self.best.add((-score, _first(r["page_start"]), _first(r["title"]), _first(r["section_id"])), row, clamp(limit))

    def terminate(self) -> Iterator[tuple]:
        yield from self.best.ranked()


def query_terms(query: str, most: int) -> list[str]:
    lowered = query.lower()
    telling = [t for t in re.split(r"\s+", re.sub("[?,]", " ", lowered)) if len(t) > 2 and t not in STOPWORDS][:most]
    return telling or [lowered.strip(" ")]


@udtf
class StructuredQuery:
    """Facts by the terms of a question in their names and values."""

    @staticmethod
    def analyze(candidates: AnalyzeArgument, limit: AnalyzeArgument | None = None) -> AnalyzeResult:
        needed = ("request_id", "query", "fact_id", "fact_name", "fact_value", "normalized_name", "page_number")
        return _analyzed(candidates, limit, needed, ("request_id", "fact_id", "fact_value"), [StructField("score", LongType()), StructField("rank", IntegerType())])

    def __init__(self) -> None:
        self.best, self.asked, self.terms = _Best(), None, []

    def eval(self, candidates, limit: int = 5) -> None:
        r, most = candidates, QueryRules().terms
        if r["query"] is None:
            return
        if r["query"] != self.asked:
            self.asked, self.terms = r["query"], query_terms(r["query"], most)
        value, name, normal = (r["fact_value"] or "").lower(), (r["fact_name"] or "").lower(), r["normalized_name"] or ""
        score = sum(4 * (normal == t) + 2 * (t in normal) + (t in name) + (t in value) for t in self.terms)
        if score:
            self.best.add((-score, _first(r["page_number"]), r["fact_id"]), (r["request_id"], r["fact_id"], r["fact_value"], score), clamp(limit))

    def terminate(self) -> Iterator[tuple]:
        yield from self.best.ranked()


@udtf
class SemanticSearch:
    """Chunks by the cosine distance of their vectors to a question's; vectors without a direction are never found."""

    @staticmethod
    def analyze(candidates: AnalyzeArgument, limit: AnalyzeArgument | None = None) -> AnalyzeResult:
        needed = ("request_id", "q", "chunk_id", "section_id", "embedding", "page_number")
        return _analyzed(candidates, limit, needed, ("request_id", "chunk_id", "section_id"), [StructField("score", DoubleType()), StructField("rank", IntegerType())])

    def __init__(self) -> None:
        self.best = _Best()

    def eval(self, candidates, limit: int = 5) -> None:
        r = candidates
        a, b = r["embedding"], r["q"]
        if not a or not b or len(a) != len(b) or None in a or None in b:
            return
        size = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        if size > 0 and math.isfinite(size):
            distance = round(1 - sum(x * y for x, y in zip(a, b)) / size, 9)
            self.best.add((distance, _first(r["page_number"]), r["chunk_id"]), (r["request_id"], r["chunk_id"], r["section_id"], 1 / (1 + distance)), clamp(limit))

    def terminate(self) -> Iterator[tuple]:
        yield from self.best.ranked()


#: The tools' names.
TOOLS = {"pageindex_navigate": PageindexNavigate, "structured_query": StructuredQuery, "semantic_search": SemanticSearch}


def register(spark: SparkSession) -> None:
    """Makes the tools known to the session's SQL."""
    for name, function in TOOLS.items():
        spark.udtf.register(name, function)
