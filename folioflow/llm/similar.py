"""Near-duplicate groups of texts that are alike from a similarity of 0.8 on.

Two texts are linked where the sets of their ``SIZE``-word shingles have a Jaccard
similarity of ``SIMILAR`` or more; groups are the connected components of the links.

1. Texts with equal sets are merged first, so a group of copies is one class.
2. SimHash fingerprints of the same shingles are linked by the vantage-point trees of
   ``simhash``, up to ``RADIUS`` bits; links are confirmed on the full sets. That joins
   most of a large group.
3. No radius that trees can prune by reaches all pairs at 0.8: these differ in some
   ten bits of 64, as many as chance pairs of a large corpus may. So classes that
   share one of ``BANDS`` MinHash bands of ``ROWS`` values meet in a bucket, too. A pair
   at similarity s shares none with probability (1 - s^ROWS)^BANDS: 3 in 100,000 at
   0.8, one in ten billion at 0.9. Classes are compared with the smallest of their
   buckets, if that is not in their component yet.
4. Buckets that still hold several components get the sets of their classes, and one
   task compares all classes of different components. It gives out no more links than
   join them, so nothing grows with the square of a bucket but the comparisons of the
   task. Buckets of more than ``BUCKET`` classes, or of more than ``SHINGLES`` shingles, are
   dealt to several tasks as pairs of blocks, so a task holds the sets of two blocks.

Every comparison takes the full sets, so no link is below the limit.

Defined cases: as in ``simhash``; texts without words are one class, and texts of
fewer than ``SIZE`` words have one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import partitions, written
from folioflow.llm.simhash import SEED, _majority, components, links, longs, one_each, shingles, text_key

SIZE = 5
#: The least similarity of a link, as a fraction.
SIMILAR = (4, 5)
BANDS, ROWS = 20, 4
#: Classes of a bucket that one task compares with each other.
BUCKET = 2000
#: Shingles of all sets of a block, about: 16 MB.
SHINGLES = 2_000_000
#: Differing bits up to which trees look for links: as many as cost no wider search than four.
RADIUS = 7
_MIX = np.random.default_rng(SEED).integers(0, 2**63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _whole(found: np.ndarray) -> int:
    """The name of a set of shingles."""
    return xxhash.xxh64_intdigest(found.tobytes(), SEED)


def band_keys(found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.empty(0, np.uint64)
    least = np.full(BANDS * ROWS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(0, len(found), 1 << 12):
        least = np.minimum(least, ((found[at : at + (1 << 12), None] ^ _MIX[0]) * _MIX[1]).min(axis=0))
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), b) for b, r in enumerate(rows)], np.uint64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([np.empty(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat))


def _described(docs: DataFrame, name: str, of) -> DataFrame:
    """(doc_id, text_key, whole, fp, ``name``): the class of each text, its fingerprint, and what ``of`` makes of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                hashes = [shingles(x.as_py(), SIZE, SEED) for x in piece.column(1)]
                sets = [np.unique(h) for h in hashes]
                keys, fps = longs([text_key(x.as_py()) for x in piece.column(1)]), longs([_majority(h) if len(h) else 0 for h in hashes])
                yield pa.RecordBatch.from_arrays([piece.column(0), keys, longs([_whole(s) for s in sets]), fps, _lists([of(s) for s in sets])], names=["doc_id", "text_key", "whole", "fp", name])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(run, f"doc_id long, text_key long, whole long, fp long, {name} array<long>")


def _sets(needed: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(whole, set) of the classes in ``needed``."""
    ids = nodes.join(needed.distinct(), "whole").select("node").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, F.col("doc_id") == F.col("node"), "left_semi")
    # A doc_id may have several texts, and so name several classes.
    return written(_described(texts, "set", lambda s: s).dropDuplicates(["whole"]).select("whole", "set"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough."""
    both = pairs.join(sets.select(F.col("whole").alias("b"), F.col("set").alias("y")), "b").join(sets.select(F.col("whole").alias("a"), F.col("set").alias("x")), "a")
    common = F.size(F.array_intersect("x", "y"))
    return both.withColumn("n", common).where(SIMILAR[1] * F.col("n") >= SIMILAR[0] * (F.size("x") + F.size("y") - F.col("n"))).select("a", "b")


def spanning(block: np.ndarray, root: np.ndarray, sets: list[np.ndarray], both: bool) -> Iterator[tuple[int, int]]:
    """(i, j) that join what is similar among classes of different roots; across blocks only, where there are two (``both``)."""
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    block, root, size = block[order], root[order].copy(), size[order]
    shingle = np.concatenate([sets[k] for k in order])
    owner = np.repeat(np.arange(len(sets)), size)
    start = np.cumsum(size) - size
    for i in range(len(sets)):
        # Sizes of similar sets differ by a fifth at most; sets are sorted by size.
        end = int(np.searchsorted(size, SIMILAR[1] * size[i] // SIMILAR[0], "right"))
        other = root[i + 1 : end] != root[i]
        if both:
            other &= block[i + 1 : end] != block[i]
        if not other.any():
            continue
        upto = start[end - 1] + size[end - 1]
        mine, rest = shingle[start[i] : start[i] + size[i]], slice(start[i] + size[i], upto)
        at = np.minimum(np.searchsorted(mine, shingle[rest]), size[i] - 1) if size[i] else np.zeros(0, np.int64)
        common = np.bincount(owner[rest][mine[at] == shingle[rest]] - i - 1, minlength=end - i - 1) if size[i] else np.zeros(end - i - 1, np.int64)
        alike = other & (SIMILAR[1] * common >= SIMILAR[0] * (size[i] + size[i + 1 : end] - common))
        for j in (np.flatnonzero(alike) + i + 1).tolist():
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                yield int(order[i]), int(order[j])


def _across(bands: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join the similar classes of each bucket; bands has key, root, whole."""

    def edges(rows: list[tuple]) -> pa.RecordBatch:
        lo, hi = rows[0][1], rows[0][2]
        whole = np.array([r[5] for r in rows], np.int64)
        found = list(spanning(np.array([r[3] for r in rows]), np.array([r[4] for r in rows], np.int64), [r[6] for r in rows], lo != hi))
        a, b = whole[[i for i, _ in found]], whole[[j for _, j in found]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket and pair of blocks; these may span batches."""
        held: list[tuple] = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            lists = batch.column(6)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for n, row in enumerate(zip(*columns)):
                if held and held[0][:3] != row[:3]:
                    yield edges(held)
                    held = []
                held.append((*row, values[offsets[n] : offsets[n + 1]].copy()))
        if held:
            yield edges(held)

    sized = bands.join(sets.select("whole", F.size("set").alias("n")), "whole")
    counts = sized.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / BUCKET, F.sum("n") / SHINGLES, F.lit(1))).cast("int").alias("blocks"))
    placed = bands.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("whole"), F.col("blocks")).cast("int"))
    met = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("key", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "root", "whole").join(sets, "whole")
    met = met.select("key", "lo", "hi", "block", "root", "whole", "set")
    dealt = met.repartition(partitions(bands.sparkSession), "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "whole")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that the trees link, or whose fingerprints are equal."""
    points = written(nodes.groupBy("fp").agg(F.min("whole").alias("node")), "points")
    near = links(points, points.count(), RADIUS).select(F.col("b").alias("a"), F.col("a").alias("b"))
    equal = nodes.select("fp", "whole").join(points, "fp").where("node <> whole").select(F.col("node").alias("a"), F.col("whole").alias("b"))
    return written(near.unionByName(equal).distinct(), "pairs")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, component_id) for every row of ``docs``: the smallest doc_id of its group."""
    marked = written(_described(docs, "keys", band_keys), "bands")
    known = marked.where("doc_id is not null")
    # Texts of one class have the same set, but may repeat shingles: any of their fingerprints will do.
    nodes = written(known.groupBy("whole").agg(F.min("doc_id").alias("node"), F.min("fp").alias("fp"), F.first("keys").alias("keys")), "classes")
    bands = nodes.select("whole", F.explode("keys").alias("key"))
    full = bands.groupBy("key").agg(F.min("whole").alias("a"), F.max("whole").alias("most")).where("a <> most").select("key", "a")
    bands = written(bands.join(full, "key"), "buckets")
    near = _by_fingerprint(nodes)
    # One table of sets: those of all classes that are compared with any.
    sets = _sets(near.select(F.col("a").alias("whole")).unionByName(near.select(F.col("b").alias("whole"))).unionByName(bands.select("whole")), docs, nodes)
    edges = written(_verified(near, sets), "similar")

    def rooted(roots: DataFrame) -> DataFrame:
        return roots.select(F.col("node").alias("whole"), "root")

    roots = rooted(components(edges))
    first = bands.where("a <> whole").select("a", F.col("whole").alias("b")).distinct()
    first = first.join(roots.select(F.col("whole").alias("a"), F.col("root").alias("x")), "a", "left").join(roots.select(F.col("whole").alias("b"), F.col("root").alias("y")), "b", "left")
    first = written(first.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b"), "pairs")
    edges = written(edges.unionByName(_verified(first, sets)), "similar")
    placed = bands.select("key", "whole").join(rooted(components(edges)), "whole", "left").select("key", "whole", F.coalesce("root", "whole").alias("root"))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    still = written(placed.join(open_keys, "key", "left_semi"), "open-buckets")
    more = written(_across(still, sets), "similar")
    classes = nodes.select("whole", "node").join(rooted(components(edges.unionByName(more))), "whole", "left").select("whole", "node", F.coalesce("root", "whole").alias("root"))
    least = classes.groupBy("root").agg(F.min("node").alias("component_id"))
    named = written(classes.join(least, "root").select("whole", "component_id"), "classes")
    return marked.select("doc_id", "text_key", "whole").join(named, "whole", "left").select("doc_id", "text_key", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group, as ``simhash.deduplicated``."""
    return one_each(docs, groups(docs))
