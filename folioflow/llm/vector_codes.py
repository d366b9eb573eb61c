"""Vector code compression: product codes whose codebooks come from a dual-tree Lloyd's algorithm.

Components become integers, ``floor(SCALE * x)``, and a vector is cut into ``PARTS`` equal
parts. Every part position has a codebook of up to ``ENTRIES`` entries, which starts as that
part of the vectors with the smallest vec_ids. In each of ``ROUNDS`` rounds every part goes to
the nearest entry (squared Euclidean distance, the lower index in ties), and an entry becomes
the floor of the mean of its parts; an unused entry stays. Then parts are assigned once more.

A round is one scan. A task builds, for every block of its vectors and every part position, a
tree over the block's parts and one over the entries: binary trees of equal depth, split at the
median of the widest side, with the bounding box of every node. From the roots on, pairs of a
part node and an entry node are met level by level. The largest distance between the boxes of
a part node and one of its entry nodes bounds what its parts are away from their nearest entry;
entry nodes whose smallest distance is above that are pruned. A part node that has one entry
left is assigned as a whole, by its cached sum and count. Where the leaves leave several
entries, their distances are computed in integers. Boxes hold integers as well, so that all
bounds are exact and ties are never pruned.

A task gives out at most PARTS * ENTRIES rows of sums a round, which Spark adds up; the driver
holds codebooks only: ENTRIES vectors.

Defined cases: vectors that are null or hold null or non-finite components are dropped; so are
those whose length is not that of the smallest vec_id's vector, or not a multiple of PARTS, as
their parts compare with none. A null vec_id comes after all others; repeated vec_ids are rows
of their own, in the order of their vectors. With fewer vectors than ENTRIES the codebooks have
as many entries as vectors. An empty table gives an empty result. Components of ``MOST`` or
more in size would not fit into 64-bit distances: the job says so and stops. Other columns than
vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from folioflow.llm.common import written

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Parts in a leaf of the trees, vectors in a block, and integers in a block of very long vectors.
LEAF, BLOCK, BLOCK_CELLS = 8, 8192, 2_000_000
#: Integers stay below 2^24: squared distances of a million components fit into 64 bits.
MOST = 2**24


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): the scaled integers of the vectors that count, in the shared folder."""
    finite = lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    # A size of -1 or null, and so null vectors, fail the first test.
    v = v.where((F.coalesce(F.size("e"), F.lit(0)) > 0) & (F.size("e") % PARTS == 0) & F.forall("e", finite))
    v = v.select("vec_id", "label", F.transform("e", lambda x: F.floor(x * SCALE)).alias("v"))
    v = written(v, "scaled-vectors")
    length = v.agg(F.min_by(F.size("v"), F.struct(F.col("vec_id").isNull(), F.col("vec_id"), F.col("v")))).first()[0]
    return v.where(F.size("v") == length)


def first_codebooks(v: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """(part, entry, component) of the smallest vec_ids; no entry where there is no vector."""
    rows = v.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not rows:
        return np.zeros((PARTS, 0, 1), np.int64)
    return np.ascontiguousarray(np.array([r.v for r in rows], np.int64).reshape(len(rows), PARTS, -1).transpose(1, 0, 2))


class Tree:
    """A balanced binary tree over integer points: an order of the points, and per level node ends and boxes.

    Node i of a level has the nodes 2i and 2i + 1 of the next one as children.
    """

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        n = len(points)
        order, ends = np.arange(n), [np.array([0, n])]
        while np.diff(ends[-1]).max() > leaf and np.diff(ends[-1]).min() > 1:
            starts, sizes = ends[-1][:-1], np.diff(ends[-1])
            p = points[order]
            low, high = np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts)
            widest = np.repeat((high - low).argmax(1), sizes)
            order = order[np.lexsort((p[np.arange(n), widest], np.repeat(np.arange(len(sizes)), sizes)))]
            cuts = np.empty(2 * len(sizes) + 1, np.int64)
            cuts[::2], cuts[1::2] = ends[-1], starts + sizes // 2
            ends.append(cuts)
        self.order, self.ends, self.points = order, ends, points[order]
        self.low = [np.minimum.reduceat(self.points, e[:-1]) for e in ends]
        self.high = [np.maximum.reduceat(self.points, e[:-1]) for e in ends]
        #: Cached sums: those of a node are the difference of two rows.
        self.sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), self.points.cumsum(0)])


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


class Assignment:
    """Parts assigned to entries by a walk over both trees.

    ``nodes`` holds (first, end, entry) of the part nodes that were assigned as a whole, ``rest``
    the places and entries of single parts; both count places in the part tree's order.
    """

    def __init__(self, parts: Tree, entries: np.ndarray) -> None:
        # Copies of the last entry fill up the tree, and drop out at its leaves.
        e = Tree(np.concatenate([entries, np.repeat(entries[-1:], (1 << (len(entries) - 1).bit_length()) - len(entries), 0)]), 1)
        self.parts, self.nodes, self.met = parts, [], 0
        a = b = np.zeros(1, np.int64)  # pairs of nodes, sorted by part node
        deep, low_deep = 0, 0
        best = np.full(1, np.iinfo(np.int64).max)  # by part node: what its parts are away at most
        while len(a):
            p_low, p_high, e_low, e_high = parts.low[deep][a], parts.high[deep][a], e.low[low_deep][b], e.high[low_deep][b]
            least = _squares(np.maximum(0, np.maximum(p_low - e_high, e_low - p_high)))
            most = _squares(np.maximum(p_high - e_low, e_high - p_low))
            self.met += len(a)
            owners, first = np.unique(a, return_index=True)
            best[owners] = np.minimum(best[owners], np.minimum.reduceat(most, first))
            near = least <= best[a]
            if low_deep == len(e.ends) - 1:
                near &= e.order[b] < len(entries)
            a, b = a[near], b[near]
            owners, first, count = np.unique(a, return_index=True, return_counts=True)
            if low_deep == len(e.ends) - 1:
                one = count == 1
                whole = owners[one]
                self.nodes.append(np.stack([parts.ends[deep][whole], parts.ends[deep][whole + 1], e.order[b[first[one]]]], 1))
                left = np.repeat(~one, count)
                a, b = a[left], b[left]
                if deep == len(parts.ends) - 1:
                    break
            if low_deep < len(e.ends) - 1:
                low_deep += 1
                b = np.repeat(b * 2, 2) + np.tile([0, 1], len(b))
                a = np.repeat(a, 2)
            if deep < len(parts.ends) - 1:
                deep += 1
                best = np.repeat(best, 2)
                a, b = np.concatenate([2 * a, 2 * a + 1]), np.concatenate([b, b])
                order = np.lexsort((b, a))
                a, b = a[order], b[order]
        self.rest = self._uncertain(a, e.order[b], deep, entries)
        self.nodes = np.concatenate(self.nodes) if self.nodes else np.zeros((0, 3), np.int64)

    def _uncertain(self, leaves: np.ndarray, entry: np.ndarray, deep: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of a leaf's candidates for each of its parts, by integers; the lower index in ties."""
        if not len(leaves):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts, sizes = self.parts.ends[deep][leaves], np.diff(self.parts.ends[deep])[leaves]
        place = np.repeat(starts, sizes) + (np.arange(sizes.sum()) - np.repeat(sizes.cumsum() - sizes, sizes))
        entry = np.repeat(entry, sizes)
        away = _squares(self.parts.points[place] - entries[entry])
        order = np.lexsort((entry, away, place))
        place, entry = place[order], entry[order]
        first = np.concatenate([[True], place[1:] != place[:-1]])
        return place[first], entry[first]

    def sums(self, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """(count by entry, sum by entry and component)."""
        counts, sums = np.zeros(entries, np.int64), np.zeros((entries, self.parts.points.shape[1]), np.int64)
        first, end, entry = self.nodes.T
        np.add.at(counts, entry, end - first)
        np.add.at(sums, entry, self.parts.sums[end] - self.parts.sums[first])
        place, entry = self.rest
        np.add.at(counts, entry, 1)
        np.add.at(sums, entry, self.parts.points[place])
        return counts, sums

    def codes(self) -> np.ndarray:
        """The entry of every part, in the order that the parts had before the tree."""
        at = np.empty(len(self.parts.order), np.int64)
        first, end, entry = self.nodes.T
        sizes = end - first
        at[np.repeat(first, sizes) + (np.arange(sizes.sum()) - np.repeat(sizes.cumsum() - sizes, sizes))] = np.repeat(entry, sizes)
        at[self.rest[0]] = self.rest[1]
        codes = np.empty_like(at)
        codes[self.parts.order] = at
        return codes


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut to blocks, with (part, vector, component)."""
    step = max(1, min(BLOCK, BLOCK_CELLS // length))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            rows = batch.slice(at, step)
            v = rows.column("v").flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, PARTS, -1)
            if np.abs(v).max() >= MOST:
                raise ValueError(f"components of {MOST // SCALE} or more in size are too large for 64-bit distances")
            yield rows, np.ascontiguousarray(v.transpose(1, 0, 2))


def summed(v: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after a round."""
    parts, entries, width = codebooks.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, points in _blocks(batches, parts * width):
            for i in range(parts):
                c, s = Assignment(Tree(points[i], LEAF), codebooks[i]).sums(entries)
                counts[i] += c
                sums[i] += s
        part, entry = np.nonzero(counts)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(sums[part, entry].ravel()), width).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), flat], ["part", "entry", "n", "sums"])

    rows = v.select("v").mapInArrow(task, "part long, entry long, n long, sums array<long>")
    # Sums of tasks can add up to more than 64 bits.
    wide = rows.select("part", "entry", "n", F.posexplode("sums").alias("at", "s")).groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    after = codebooks.copy()
    for r in wide.collect():  # at most one row for each integer of the codebooks
        after[r.part, r.entry, r.at] = int(r.s) // r.n
    return after


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def trained(v: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    codebooks = first_codebooks(v)
    for _ in range(rounds if codebooks.size else 0):
        codebooks = summed(v, codebooks)
    return codebooks


def encoded(v: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of the kept vectors."""
    parts, _, width = codebooks.shape
    schema = StructType([*v.select("vec_id", "label").schema.fields, StructField("code", StringType()), StructField("error", LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, points in _blocks(batches, parts * width):
            codes, error = np.empty((rows.num_rows, parts), np.uint8), np.zeros(rows.num_rows, np.int64)
            for i in range(parts):
                found = Assignment(Tree(points[i], LEAF), codebooks[i]).codes()
                codes[:, i] = found
                error += _squares(points[i] - codebooks[i][found])
            hexed = codes.tobytes().hex()
            texts = [hexed[k : k + 2 * parts] for k in range(0, len(hexed), 2 * parts)]
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("label"), pa.array(texts, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return v.mapInArrow(task, schema)


def compressed(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that counts."""
    v = kept(vectors)
    codebooks = trained(v)
    coded = written(encoded(v, codebooks), "vector-codes")
    # Labels are summed up on the map side; the rows meet one sum a label.
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
