"""Near-duplicate groups by SimHash fingerprints, linked with vantage-point trees.

Each text becomes a 64-bit fingerprint: the bitwise majority of the XXH64 hashes
of its word shingles. Two texts are linked where the fingerprints differ in at
most ``radius`` bits, and groups are the connected components of the links.

All pairs within the radius are found without comparing everything:

1. Equal fingerprints are merged first, so a group of exact copies of any size is
   one node afterwards (its smallest doc_id names the node).
2. The 64 bits are cut into ``PARTS`` equal parts. Two fingerprints at distance
   <= r agree to within r // PARTS bits in one part at least.
3. For every part a vantage-point tree partitions the nodes by the Hamming
   distance of that part to vantage points. A node lives in one leaf. It is
   copied into the leaf on the far side of a split only when the triangle bound
   says that a partner may be there (its distance to the vantage point lies
   within the part's radius of the split); other branches are pruned. Copying
   goes outwards only, since each pair needs to meet once.
   Where too many nodes look alike in a part for the tree to tell them apart, the
   nodes of that leaf go on to trees over each of the other parts, in one of which
   two of them agree to within r // (PARTS - 1) bits.
4. Every leaf is one task's work: it finds its exact links on all 64 bits and
   emits one edge per linked node (to the smallest node that it reaches in the
   leaf), never all pairs of a group.
5. Edges are contracted to components over the shared folder, without gathering
   links, nodes or components on the driver.

The trees are built from a bounded sample of fingerprints (``SAMPLE``): the sample
decides how evenly the leaves are filled, never which pairs are found.

Defined cases: null and empty texts have no words, fingerprint zero, and are
linked like any other; rows with a null doc_id get a fingerprint, and a null
component, and link nothing; repeated rows share node and component; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import partitions, written

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Parts that the bits are cut into. Narrow parts have small radii, so few copies are made across splits.
PARTS = 4
#: Most fingerprints drawn to build the trees.
SAMPLE = 2_000_000
#: And the largest share of all nodes that is drawn.
SAMPLE_SHARE = 0.1
#: Nodes that a leaf should hold, before copies from across splits.
LEAF_NODES = 6_000
#: A leaf with so many times more goes on to trees over the other parts.
TOO_MANY = 8


def fingerprint(text: bytes | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one UTF-8 text, as an unsigned integer."""
    hashes = shingles(text, size, seed)
    return _majority(hashes) if len(hashes) else 0


def shingles(text: bytes | None, size: int, seed: int) -> np.ndarray:
    """The hashes of all word shingles of one UTF-8 text, in order."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    line = b" ".join(tokens)
    n = len(tokens)
    if n <= size:
        return np.array([xxhash.xxh64_intdigest(line, seed)], dtype=np.uint64)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist())], dtype=np.uint64)


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; counted in blocks, so memory is bounded."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint of every row, its 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint(x.as_py(), size, seed) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), longs([text_key(x.as_py()) for x in batch.column(1)]), longs(got)], names=["doc_id", "text_key", "fp"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(run, "doc_id long, text_key long, fp long")


def text_key(text: bytes | None) -> int:
    """What Spark's xxhash64 makes of a text."""
    return 42 if text is None else xxhash.xxh64_intdigest(text, 42)


def longs(values: list[int]) -> pa.Array:
    """Unsigned 64-bit integers as signed ones."""
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _part(fps: np.ndarray, part: int, parts: int) -> np.ndarray:
    """The bits of one part, as unsigned integers."""
    width = 64 // parts
    mask = np.uint64((1 << width) - 1) if width < 64 else np.uint64(0xFFFFFFFFFFFFFFFF)
    return (fps >> np.uint64(part * width)) & mask


class VantageTree:
    """Splits of one part's space. ``split[i]`` is None for a leaf."""

    def __init__(self, sample: np.ndarray, leaf: int, radius: int, seed: int) -> None:
        self.radius = radius
        self.splits: list[tuple[int, int, int, int] | None] = []
        rng = np.random.default_rng(seed)
        self._build(sample, max(1, leaf), rng, 0)

    def _build(self, points: np.ndarray, leaf: int, rng: np.random.Generator, depth: int) -> int:
        here = len(self.splits)
        self.splits.append(None)
        if len(points) <= leaf or depth >= 40:
            return here
        best = None
        # Of some random vantage points the one whose split copies the least.
        for v in rng.choice(points, size=min(8, len(points)), replace=False):
            distance = np.bitwise_count(points ^ v).astype(np.int64)
            for cut in sorted({int(np.median(distance)) + d for d in (-1, 0)}):
                inner = int((distance <= cut).sum())
                copied = int(((distance <= cut) & (distance > cut - self.radius)).sum())
                if 0 < inner < len(points):
                    cost = max(inner, len(points) - inner + copied)
                    if best is None or cost < best[0]:
                        best = (cost, int(v), cut, distance)
        # A split that leaves nearly everything on one side prunes nothing.
        if best is None or best[0] > 0.95 * len(points):
            return here
        _, vantage, cut, distance = best
        inside = self._build(points[distance <= cut], leaf, rng, depth + 1)
        outside = self._build(points[distance > cut - self.radius], leaf, rng, depth + 1)
        self.splits[here] = (vantage, cut, inside, outside)
        return here

    def route(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, indices of the points that are there), copies across splits included."""
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            split = self.splits[node]
            if split is None:
                yield node, rows
                continue
            vantage, cut, inside, outside = split
            distance = np.bitwise_count(points[rows] ^ np.uint64(vantage)).astype(np.int64)
            todo.append((inside, rows[distance <= cut]))
            todo.append((outside, rows[distance > cut - self.radius]))


def _leaf_edges(ids: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its group within this leaf) for every linked node but that one."""
    order = np.argsort(ids, kind="stable")
    ids, fps = ids[order], fps[order]
    left = np.arange(len(ids))
    alive = np.ones(len(ids), dtype=bool)
    a, b = [], []
    while len(left):
        # One block of nodes against all that remain; most have no partner at all.
        block = left[: max(1, min(len(left), (1 << 21) // len(left)))]
        near = np.bitwise_count(fps[block][:, None] ^ fps[left][None, :]) <= radius
        for i in np.flatnonzero(near.sum(axis=1) > 1).tolist():
            start = block[i]
            if not alive[start]:
                continue
            # Search from a linked node, taking what it reaches out of the rest.
            alive[start] = False
            found = left[near[i]]
            found = found[alive[found]]
            if not len(found):
                continue
            alive[found] = False
            group, frontier = [found], found.tolist()
            rest = left[alive[left]]
            rest_fps = fps[rest]
            while frontier and len(rest):
                hit = np.bitwise_count(rest_fps ^ fps[frontier.pop()]) <= radius
                if hit.any():
                    found = rest[hit]
                    alive[found] = False
                    group.append(found)
                    frontier += found.tolist()
                    rest, rest_fps = rest[~hit], rest_fps[~hit]
            reached = ids[np.concatenate(group)]
            a.append(reached)
            b.append(np.full(len(reached), ids[start]))
        alive[block] = False
        left = left[alive[left]]
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


class Forest:
    """A tree for every part, and below leaves that hold too many nodes a tree for every other part."""

    def __init__(self, sample: np.ndarray, parts: int, leaf: int, radius: int) -> None:
        self.parts, self.trees = parts, []
        self.below: list[dict[int, list[tuple[int, int, VantageTree]]]] = []
        self.base, self.size = [], 0
        for p in range(parts):
            tree = VantageTree(_part(sample, p, parts), leaf, radius // parts, SEED + p)
            self.trees.append(tree)
            self.base.append(self.size)
            self.size += len(tree.splits)
            self.below.append({})
            for at, rows in tree.route(_part(sample, p, parts)) if parts > 1 else ():
                if len(rows) > TOO_MANY * leaf:
                    below = []
                    for q in [q for q in range(parts) if q != p]:
                        inner = VantageTree(_part(sample[rows], q, parts), leaf, radius // (parts - 1), SEED + parts * p + q)
                        below.append((self.size, q, inner))
                        self.size += len(inner.splits)
                    self.below[p][at] = below

    def route(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, indices of the fingerprints that are there), copies included."""
        for p, tree in enumerate(self.trees):
            for at, rows in tree.route(_part(fps, p, self.parts)):
                if at not in self.below[p]:
                    yield self.base[p] + at, rows
                for base, q, inner in self.below[p].get(at, ()):
                    for deeper, some in inner.route(_part(fps[rows], q, self.parts)):
                        yield base + deeper, rows[some]


def links(nodes: DataFrame, count: int, radius: int = RADIUS, parts: int = PARTS, leaf_nodes: int = LEAF_NODES) -> DataFrame:
    """(a, b): edges that join all nodes (node, fp) within ``radius`` bits, b < a.

    The edges span the same components as all pairs would; their number is at most
    one per node and leaf.
    """
    spark = nodes.sparkSession
    rate = min(SAMPLE_SHARE, 0.9 * SAMPLE / max(1, count))
    draw = F.pmod(F.xxhash64("fp"), F.lit(1_000_000_007)) < int(rate * 1_000_000_007)
    sample = np.sort(nodes.where(draw).select("fp").toArrow()["fp"].to_numpy()).astype(np.int64).view(np.uint64)
    forest = Forest(sample, parts, max(16, int(leaf_nodes * rate)), radius)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            fps = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), dtype=np.int64)
            for leaf, rows in forest.route(fps.view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), leaf, dtype=np.int32)), pa.array(ids[rows]), pa.array(fps[rows])], names=["leaf", "node", "fp"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by leaf; a leaf may span batches."""
        open_leaf, ids, fps = None, [], []

        def edges() -> Iterator[pa.RecordBatch]:
            a, b = _leaf_edges(np.concatenate(ids), np.concatenate(fps).view(np.uint64), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            leaf_col = batch.column(0).to_numpy(zero_copy_only=False)
            id_col = batch.column(1).to_numpy(zero_copy_only=False)
            fp_col = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(leaf_col)) + 1).tolist(), len(leaf_col)]
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                if open_leaf is not None and leaf_col[x] != open_leaf:
                    yield from edges()
                    ids, fps = [], []
                open_leaf = leaf_col[x]
                ids.append(np.array(id_col[x:y], dtype=np.int64))
                fps.append(np.array(fp_col[x:y], dtype=np.int64))
        if ids:
            yield from edges()

    routed = nodes.select("node", "fp").mapInArrow(route, "leaf int, node long, fp long")
    # Leaves are dealt by number, so that neighbours do not collide in a hash bucket.
    n = max(1, min(forest.size, 4 * partitions(spark)))
    dealt = routed.withColumn("leaf_part", F.pmod(F.col("leaf"), F.lit(n)).cast("int")).repartitionById(n, "leaf_part").select("leaf", "node", "fp")
    return dealt.sortWithinPartitions("leaf").mapInArrow(solve, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge (a, b) can reach.

    Every round points each node to its smallest neighbour and contracts the graph
    to the nodes pointed at. Each node but a local minimum vanishes in its round,
    so the rounds are few. Only the shrinking rest is written again.
    """
    spark = edges.sparkSession
    levels = []
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")).select(F.col("a").alias("node"), "p"), "parent")
        # Chains of pointers go downwards and end at local minima: halve them until they are stars.
        while True:
            step = parent.alias("x").join(parent.alias("y"), F.col("x.p") == F.col("y.node"), "left").select(
                F.col("x.node").alias("node"), F.coalesce(F.col("y.p"), F.col("x.p")).alias("p"), (F.col("y.p") < F.col("x.p")).alias("moved")
            )
            step = written(step, "parent")
            moved = not step.where("moved").limit(1).isEmpty()
            parent = step.select("node", "p")
            if not moved:
                break
        levels.append(parent)
        up, down = parent.select(F.col("node").alias("a"), F.col("p").alias("pa")), parent.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        edges = written(
            edges.join(up, "a").join(down, "b").where("pa <> pb").select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct(), "edges"
        )
        if edges.limit(1).isEmpty():
            break
    root = levels.pop()
    while levels:
        # What a later round moved, seen from the round before it.
        below = levels.pop()
        top = root.select(F.col("node").alias("p"), F.col("p").alias("top"))
        root = below.join(top, "p", "left").select("node", F.coalesce("top", "p").alias("p"))
    return root.select("node", F.col("p").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, parts: int = PARTS, leaf_nodes: int = LEAF_NODES) -> DataFrame:
    """(doc_id, text_key, fp, component_id) for every row of ``docs``."""
    marked = written(fingerprints(docs), "fingerprints")
    nodes = written(marked.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    edges = written(links(nodes, nodes.count(), radius, parts, leaf_nodes), "links")
    moved = components(edges).where("node <> root")
    classes = nodes.join(moved, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return marked.join(classes, "fp", "left").select(
        "doc_id", "text_key", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def deduplicated(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each group: that with the smallest doc_id, all columns kept.

    Rows with a null doc_id belong to no group and stay. Of rows that repeat both
    doc_id and text, one stays.
    """
    return one_each(docs, near_duplicates(docs, radius))


def one_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The texts of each group whose doc_id is the group's component_id, and all documents without an id.

    ``groups`` has doc_id, text_key and component_id. Rows that repeat doc_id and text
    are known by their counts, so only these are looked at twice.
    """
    columns = docs.columns
    packed = docs.select(F.col("doc_id").cast("long").alias("_kept_id"), F.xxhash64(F.col("text").cast("string")).alias("_kept_key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
    kept = groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key")).agg(F.count("*").alias("_n"))
    kept = written(kept, "kept")
    known = packed.where("_kept_id is not null").join(kept, ["_kept_id", "_kept_key"])
    if not kept.where("_n > 1").limit(1).isEmpty():
        many = known.where("_n > 1").groupBy("_kept_id", "_kept_key").agg(F.first("_row").alias("_row"))
        known = known.where("_n = 1").select("_row").unionByName(many.select("_row"))
    return known.select("_row").unionByName(packed.where("_kept_id is null").select("_row")).select("_row.*")
