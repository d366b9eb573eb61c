"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.sources.sinks import removed, scratch, written  # noqa: F401

#: A word is a run of characters other than the six ASCII white-space ones.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def words(text: Column) -> Column:
    """All words of a text as an array; null becomes an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids have no bucket."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


#: Bytes of text that tasks split at a time.
PIECE = 2**22


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about PIECE bytes of its column ``text``, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(lengths[at:]), PIECE, side="right")))
        yield batch.slice(at, n)
        at += n


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and how many each text has; null texts have none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, ends = lists.flatten(), np.asarray(lists.offsets)
    full = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full), np.diff(before[ends - ends[0]])
