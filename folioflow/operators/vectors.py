"""Vectors of chunks: embedding, metadata of their sections, ingestion and search within a document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import lower_terms
from folioflow.operators.retrieval import cosine_distance
from folioflow.sources.sinks import upserted

DIMENSIONS = 8


def hashed_embedding(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """A stand-in for a model: how many terms of a text fall into each bucket of their hash, plus one.

    A model-backed embedding is another function from a text column to an array column.
    """
    buckets = F.transform(lower_terms(text), lambda t: F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int") % dimensions)
    return F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda d: (F.size(F.filter(buckets, lambda b: b == d)) + 1).cast("double"))


def joined(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


def box_text(box: Column) -> Column:
    return joined(F.array(*[box[c] for c in ("x0", "y0", "x1", "y1")]))


def ingested(chunks: DataFrame, belonging: DataFrame, embed: Callable[[Column], Column] = hashed_embedding) -> DataFrame:
    """One row per chunk for the vector store, with its own section; chunks of no section have empty ones."""
    own = belonging.where("direct").select("doc_id", "chunk_id", "section_id", "section_title")
    rows = chunks.join(own, ["doc_id", "chunk_id"], "left")
    return rows.select(
        F.col("chunk_id").alias("vec_id"),
        embed(F.col("content")).alias("embedding"),
        F.col("content").alias("document"),
        "doc_id",
        F.coalesce("section_id", F.lit("")).alias("section_id"),
        F.coalesce("section_title", F.lit("")).alias("section_title"),
        F.array_min("pages").alias("page_number"),
        joined(F.col("pages")).alias("page_refs"),
        box_text(F.col("box")).alias("bounding_box"),
        "chunk_type",
        "content_hash",
    )


def ingest(store: DataFrame, chunks: DataFrame, belonging: DataFrame) -> DataFrame:
    """The store with the chunks' vectors put in by id."""
    return upserted(store, ingested(chunks, belonging), "vec_id")


def search(requests: DataFrame, vectors: DataFrame, chunks: DataFrame, limit: int = 5, narrow: DataFrame | None = None, embed: Callable[[Column], Column] = hashed_embedding) -> DataFrame:
    """The nearest chunks of each request's document (request_id, doc_id, query), with their provenance.

    Hits are mapped to the chunks that exist now. ``narrow`` (request_id, section_id)
    keeps a request to some sections; requests that are not in it search all. Vectors that
    are null, zero or not finite are never found.
    """
    asked = requests.select("request_id", "doc_id", embed(F.col("query")).alias("q"))
    rows = asked.join(vectors.select("vec_id", "doc_id", "embedding", "section_id"), "doc_id")
    if narrow is not None:
        wanted = narrow.groupBy("request_id").agg(F.collect_set("section_id").alias("wanted"))
        rows = rows.join(wanted, "request_id", "left").where(F.col("wanted").isNull() | F.array_contains("wanted", F.col("section_id")))
    known = chunks.select("doc_id", F.col("chunk_id").alias("vec_id"), "content", "pages", "box", "content_hash")
    hits = rows.join(known, ["doc_id", "vec_id"]).withColumn("distance", F.round(cosine_distance(F.col("embedding"), F.col("q")), 9))
    order = Window.partitionBy("request_id").orderBy("distance", F.array_min("pages"), "vec_id")
    # Vectors without a direction have no distance.
    best = hits.where("distance is not null and not isnan(distance)").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return best.select("request_id", "doc_id", F.col("vec_id").alias("chunk_id"), F.nullif("section_id", F.lit("")).alias("section_id"), "content", "pages", "box", "content_hash", "rank", (1 / (1 + F.col("distance"))).alias("score"))
