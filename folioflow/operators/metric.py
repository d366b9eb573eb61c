"""Exact nearest vectors by cosine, over blocks around pivots that triangle bounds rule out.

On unit vectors the chord is a metric, and cosine distance is half its square. Vectors are put
into blocks: those nearest to the same pivot, in a ring of distances from it, about ``BLOCK``
of them; rings are quantiles, and what is equally far is dealt out by hash. A query is first compared with one block near it; its k-th distance there bounds
what it still looks for. By the triangle inequality no vector of a block is nearer to the query
than the query's distance from the pivot is away from the block's ring, so only blocks within the
bound are met. Queries go to blocks by an equi-join on the pivot, and are dealt out in parts of
about ``ASKED``, so a task holds one block and one part. How much is pruned depends on the vectors:
much where they cluster, next to nothing where they point everywhere alike.

Vectors and queries without a direction (null, zero, or with a null or non-finite component), and
those whose length is not that of the pivots, are never found and find nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.sources.sinks import written

PIVOTS, RINGS, BLOCK, ASKED = 32, 16, 1024, 1024
#: Bounds are widened by this much, which is more than sums in 64 bits are off.
SLACK = 1e-6


def squares(v: Column) -> Column:
    return F.aggregate(F.transform(v, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda s, x: s + x)


def directed(vectors: DataFrame, column: str) -> DataFrame:
    """The rows whose vector has a direction."""
    size = F.sqrt(squares(F.col(column)))
    # A null component makes the sum null.
    return vectors.where(F.coalesce((size > 0) & ~F.isnan(size) & (size < float("inf")), F.lit(False)))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = pa.chunked_array(column).combine_chunks() if isinstance(column, list) else column
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def chosen_pivots(vectors: DataFrame) -> np.ndarray:
    """Unit vectors of up to PIVOTS rows by the hash of their id, one for each block: (pivot, component)."""
    many = max(1, min(PIVOTS, vectors.count() // BLOCK))
    rows = directed(vectors, "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(many).select("embedding").collect()
    rows = [r.embedding for r in rows if len(r.embedding) == len(rows[0].embedding)]
    return _units(np.array(rows, np.float64)) if rows else np.zeros((0, 0))


def _chords(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * _units(x) @ pivots.T))


def placed(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, pivot, away): every directed vector with its nearest pivot."""
    good = directed(vectors, "embedding").where(F.size("embedding") == pivots.shape[1]).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                chords = _chords(_matrix(batch.column("v")), pivots)
                pivot = chords.argmin(1)
                away = chords[np.arange(len(pivot)), pivot]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot.astype(np.int32)), pa.array(away)], ["vec_id", "v", "pivot", "away"])

    return good.mapInArrow(task, "vec_id long, v array<double>, pivot int, away double")


def _asked(queries: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(request_id, q, chords): every directed query with its distances from the pivots."""
    good = directed(queries, "query_vec").where(F.size("query_vec") == pivots.shape[1]).select(F.col("request_id").cast("long").alias("request_id"), F.col("query_vec").cast("array<double>").alias("q"))

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(_chords(_matrix(batch.column("q")), pivots)))], ["request_id", "q", "chords"])

    return good.mapInArrow(task, "request_id long, q array<double>, chords array<double>")


def _cosine_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the sums in the order of the components."""
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    for x, y in zip(a.T, b.T):
        dot += x * y
        aa += x * x
        bb += y * y
    return 1 - dot / (np.sqrt(aa) * np.sqrt(bb))


def _compared(limit: int):
    """The nearest of a block's vectors to each query of a part; ties go to the smaller id."""

    def task(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not asked.num_rows or not known.num_rows:
            return pa.table({"request_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "distance": pa.array([], pa.float64()), "met": pa.array([], pa.int64())})
        q, v = _matrix(asked.column("q")), _matrix(known.column("v"))
        near = 1 - _units(q) @ _units(v).T
        k = min(limit, near.shape[1])
        bound = np.partition(near, k - 1, axis=1)[:, k - 1 : k] + SLACK
        row, column = np.nonzero(near <= bound)
        ids = known.column("vec_id").to_numpy()[column]
        distance = _cosine_distances(q[row], v[column])
        order = np.lexsort((ids, distance, row))
        row, ids, distance = row[order], ids[order], distance[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < k
        met = np.where(np.arange(len(row)) == first, near.shape[1], 0)[keep]
        return pa.table({"request_id": asked.column("request_id").to_numpy()[row[keep]], "vec_id": ids[keep], "distance": distance[keep], "met": met})

    return task


def _met(pairs: DataFrame, queries: DataFrame, vectors: DataFrame, limit: int, parts: int) -> DataFrame:
    """(request_id, vec_id, distance, met): the best of each block for the queries that go to it."""
    part = F.pmod(F.xxhash64("request_id"), F.lit(parts))
    asked = pairs.join(queries.select("request_id", "q"), "request_id").withColumn("part", part)
    wanted = asked.select(F.col("block").alias("at"), F.col("part").alias("of")).distinct()
    known = vectors.join(wanted, F.col("block") == F.col("at")).select("at", "of", "vec_id", "v")
    return asked.groupBy("block", "part").cogroup(known.groupBy("at", "of")).applyInArrow(_compared(limit), "request_id long, vec_id long, distance double, met long")


def nearest(queries: DataFrame, vectors: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(hits, work): the ``limit`` nearest vectors of every query with distance and rank, and how many each query was compared with.

    ``queries`` has request_id and query_vec, ``vectors`` vec_id and embedding. Ids are unique.
    """
    spark = vectors.sparkSession
    pivots = chosen_pivots(vectors)
    if not len(pivots):
        none = spark.createDataFrame([], "request_id long, vec_id long, distance double, rank int")
        return none, spark.createDataFrame([], "request_id long, met long")
    rows = placed(vectors, pivots)
    cells = written(rows, "metric-rows")
    cuts = F.percentile_approx("away", F.array(*[F.lit(i / RINGS) for i in range(1, RINGS)]))
    rings = cells.groupBy("pivot").agg(F.least(F.lit(RINGS), F.ceil(F.count("*") / BLOCK).cast("int")).alias("rings"), cuts.alias("cuts"))
    below = F.size(F.filter("cuts", lambda x: x < F.col("away")))
    cells = cells.join(rings, "pivot").withColumn("ring", F.floor(below * F.col("rings") / RINGS)).drop("cuts", "rings")
    size = cells.groupBy("pivot", "ring").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("pieces"))
    cut = cells.join(size, ["pivot", "ring"]).withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.col("pieces")))
    cut = cut.withColumn("block", F.concat_ws("-", "pivot", "ring", "piece"))
    blocks = written(cut.groupBy("block", "pivot").agg(F.min("away").alias("lo"), F.max("away").alias("hi"), F.count("*").alias("n")), "metric-blocks")
    asked = written(_asked(queries, pivots), "metric-queries")
    parts = max(1, -(-asked.count() // ASKED))
    chords = asked.select("request_id", F.posexplode("chords").alias("pivot", "chord"))
    least = F.greatest(F.lit(0.0), F.col("chord") - F.col("hi"), F.col("lo") - F.col("chord"))
    bounds = chords.join(blocks, "pivot").select("request_id", "block", "n", least.alias("least"))
    # The block to begin with: the nearest one that can fill the list, else the largest.
    begin = F.struct(-F.least(F.col("n"), F.lit(limit)), "least", -F.col("n"), "block")
    home = bounds.groupBy("request_id").agg(F.min_by("block", begin).alias("block"))
    first = written(_met(home, asked, cut, limit, parts), "metric-hits")
    # The k-th chord so far, or none yet.
    so_far = first.groupBy("request_id").agg(F.max("distance").alias("d"), F.count("*").alias("k"))
    so_far = so_far.select("request_id", F.when(F.col("k") >= limit, F.sqrt(F.greatest(F.lit(0.0), 2 * F.col("d")))).alias("reach"))
    rest = bounds.join(home.withColumnRenamed("block", "home"), "request_id").join(so_far, "request_id", "left").where((F.col("block") != F.col("home")) & (F.col("reach").isNull() | (F.col("least") <= F.col("reach") + SLACK)))
    more = _met(rest.select("request_id", "block"), asked, cut, limit, parts)
    every = written(first.unionByName(more), "metric-hits")
    order = Window.partitionBy("request_id").orderBy("distance", "vec_id")
    hits = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).select("request_id", "vec_id", "distance", "rank")
    return hits, every.groupBy("request_id").agg(F.sum("met").alias("met"))
