"""Mixes sources to target weights by systematic sampling.

Every source gets a target: its weight's part of the wanted total, but at most
``most`` times its own size; what is cut off is shared again by weight among the
other sources until none is above. That is one water level L with
target = least(most * size, L * weight), found by a running sum over the sources
in the order of the level at which each fills up.

A document is expected target / size times. Along a fixed order of a source's
documents these expected copies are summed up (all documents of a source expect
the same, so the sum before a document is its rank times the rate), one random
offset is added, and the document is emitted once for each integer that its
stretch of the sum crosses. The order goes by size class, then by a hash of doc_id
and text: short and long documents are then drawn evenly, and what a source takes
differs from its target by no more than about its largest document. Offset and order
come from hashes, so reruns agree.

Ranks of a large source are not made in one task: documents are ranked within
buckets of (source, size class, leading hash digits), as many digits as the class
needs, and a running sum over the bucket counts gives each bucket its start. Buckets
refine the order, so the result does not depend on how many there are. Documents
without a doc_id spread by their texts.

Defined cases: null and empty texts have size 0 and are drawn like others, to no
effect on the sizes; a null source is a source of its own, the last one; repeated
rows are separate documents, and as they are equal it does not matter which of them
is drawn (rows that repeat doc_id and text go by the hash of their other columns in
``mixed``); a source without words has target 0 and its documents are left out; an
empty table gives an empty result. Extra columns are kept by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
#: Documents that a bucket should hold at most.
BUCKET_ROWS = 200_000


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, n_docs, target, rate) from (source, size) rows."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    # A row per source from here on.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    everything = Window.partitionBy()
    level = Window.orderBy(F.col("full"), F.col("source").asc_nulls_last())
    lower = level.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        by_source.withColumn("w", F.element_at(kinds, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("full", F.col("cap") / F.col("w"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("cap_below", F.coalesce(F.sum("cap").over(lower), F.lit(0.0)))
        .withColumn("w_from", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(lower), F.lit(0.0)))
        # The level if this source and all that fill up later are not full.
        .withColumn("try", (F.col("wanted") - F.col("cap_below")) / F.col("w_from"))
        .withColumn("level", F.max(F.when(F.col("try") <= F.col("full"), F.col("try"))).over(everything))
    )
    target = F.when(F.col("level").isNull() | (F.col("full") <= F.col("level")), F.col("cap")).otherwise(F.col("level") * F.col("w"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "n_docs", "target", "rate")


def identity(doc_id: Column, text: Column) -> Column:
    """The hash that orders documents."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text.cast("string"), F.lit("")))))


def _offset(source: Column, seed: str) -> Column:
    """One number from 0 to 1 for a source."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("")))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _size_class(size: Column) -> Column:
    """Classes a twelfth wide: size itself when small, then its logarithm."""
    return F.when(size < 16, size).otherwise(F.floor(F.log2(size.cast("double")) * 8)).cast("int")


def sampled(sized: DataFrame, row: str | None = None, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, and ``row``) for every row.

    ``sized`` has doc_id, source, size, h (see ``identity``) and, if named, one more
    column that is carried along, and ``tie``, which orders rows of the same h.
    """
    slim = written(sized.select("doc_id", "source", "size", "h", _size_class(F.col("size")).alias("class")), "sizes")
    goals = targets(slim, weights, share, most).withColumn("offset", _offset(F.col("source"), seed))
    goals = written(goals.select(F.col("source").alias("g_source"), "source_size", "target", "rate", "offset"), "targets")
    classes = slim.groupBy("source", "class").agg(F.count("*").alias("n"))
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("n") / F.lit(BUCKET_ROWS)))).cast("int")
    classes = written(classes.select(F.col("source").alias("d_source"), F.col("class").alias("d_class"), digits.alias("digits")), "classes")

    # Nulls are keys like any other in groups and windows, and in joins by <=>.
    def keyed(df: DataFrame) -> DataFrame:
        known = df.join(classes, F.col("source").eqNullSafe(F.col("d_source")) & (F.col("class") == F.col("d_class")))
        return known.withColumn("bucket", F.substr("h", F.lit(1), F.col("digits"))).drop("d_source", "d_class", "digits")

    counts = keyed(slim).groupBy("source", "class", "bucket").agg(F.count("*").alias("n"))
    start = Window.partitionBy("source").orderBy("class", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("source").alias("s_source"), F.col("class").alias("s_class"), F.col("bucket").alias("s_bucket"), F.coalesce(F.sum("n").over(start), F.lit(0)).alias("before"))
    starts = written(starts, "starts")
    within = Window.partitionBy("source", "class", "bucket").orderBy("h", *(["tie"] if row else []))
    ranked = keyed(sized.withColumn("class", _size_class(F.col("size"))) if row else slim).withColumn("rank", F.row_number().over(within) - 1)
    at = ranked.join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("class") == F.col("s_class")) & (F.col("bucket") == F.col("s_bucket")))
    drawn = at.join(goals, F.col("source").eqNullSafe(F.col("g_source"))).withColumn("position", F.col("before") + F.col("rank"))
    crossed = F.floor((F.col("position") + 1) * F.col("rate") + F.col("offset")) - F.floor(F.col("position") * F.col("rate") + F.col("offset"))
    copies = F.least(crossed, F.lit(most)).cast("int")
    return drawn.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"), *([row] if row else []))


def sized(docs: DataFrame, *more: str) -> DataFrame:
    """What ``sampled`` needs of documents, and more columns as they are."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), identity(doc_id, F.col("text")).alias("h"), *more)


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The documents that the mix takes, repeated as often as it takes them."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Maps have no hash; JSON writes them.
    others = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema if f.name != "text"]
    rows = docs.select(F.struct(*columns).alias("row"), F.xxhash64(*others, F.lit(0)).alias("tie"))
    plain = sized(rows.select("row", "tie", "row.doc_id", "row.source", "row.text"), "row", "tie")
    taken = sampled(plain, "row", weights, share, most, seed).where("copies > 0")
    return taken.withColumn("row", F.explode(F.array_repeat("row", F.col("copies")))).select("row.*")
