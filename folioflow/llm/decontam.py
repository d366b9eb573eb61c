"""Benchmark decontamination by the q-gram lemma.

Texts are compared by characters, with A-Z lower-cased and white space collapsed. An
item of m characters may be contained with up to k = m // PER_EDIT edits. Such a
region shares at least m - q + 1 - k * q of the item's q-grams (the lemma; q is ``Q``,
and ``SHORT_Q`` for items under ``SHORT`` characters, where ``Q`` would say nothing),
and their diagonals (position in the text minus position in the item) drift by at
most k. So positions of matching q-grams are counted in bands of 2 (k + 1) diagonals
that overlap by half; every alignment within the budget lies in one band entirely.
Bands that meet the bound are verified by banded alignment, exact copies by plain
search. Three things keep the counting small, and none changes what is found:

- a q-gram that an item repeats stands for a run of diagonals, so a position of the
  text counts once in a band, however often the item has its q-gram;
- of each item some of its most frequent q-grams are not looked up, and the bound is
  lowered by their number;
- before bands, positions are counted in stretches of the text as long as the item
  with its edits, and only items that could meet the bound in two neighbours go on.

Documents are only mapped over, so nothing of them is shuffled, whatever item or
passage is frequent. Texts are handled whole, in blocks of ``BLOCK`` bytes; a longer
text comes in pieces that overlap by more than an item. The distinct texts of the
items are written to the shared folder in blocks of about ``ITEM_CHARS`` characters.
Tasks read one block after the other and match it with up to ``GROUP`` bytes of
documents, so all blocks take one scan of the documents and no task, nor the driver,
holds more than a block.

Items under ``TINY`` characters are found exactly, between word boundaries, in the
same scan.

Defined cases: null and empty texts contain nothing; items without text are left out,
items that share a text are all reported, repeated items once; documents with a null
id, and repeated rows, are judged like others; empty tables give empty results, and
without items all documents are clean; extra columns are ignored, and kept by
``clean``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import scratch, written

Q = 8
#: An item may differ in one edit for so many of its characters.
PER_EDIT = 10
#: Items of fewer characters are indexed by SHORT_Q-grams: from here on Q-grams allow the whole budget.
SHORT, SHORT_Q = 32, 4
#: Items of fewer characters are matched exactly, as words.
TINY = 8
BLOCK = 1 << 18
ITEM_CHARS = 1 << 21
GROUP = 1 << 26
#: Cells that stretches are counted in; where there are more, several share a cell.
MOST_CELLS = 1 << 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32
#: Bytes that words consist of: letters, digits, underscores, and all of other scripts.
_INSIDE = np.array([b >= 0x80 or chr(b).isalnum() or b == ord("_") for b in range(256)])


def _normalised(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, lo, hi): texts that lie between ``cuts`` of ``raw``, normalised, and where each now lies."""
    data = _LOWER[raw]
    space = data == 32
    after = np.empty_like(space)
    after[:-1] = space[1:]
    # The end of a text counts as white space, so that its last run goes entirely.
    after[cuts[1:][cuts[1:] > cuts[:-1]] - 1] = True
    keep = ~(space & after)
    upto = np.concatenate([[0], np.cumsum(keep)])[cuts] if len(raw) else np.zeros(len(cuts), np.int64)
    data = data[keep]
    lo, hi = upto[:-1].copy(), upto[1:].copy()
    # A first run has left one blank; it separates the text from the one before.
    some = np.flatnonzero(hi > lo)
    lo[some] += data[lo[some]] == 32
    return data, lo, hi


def _characters(data: np.ndarray, *places: np.ndarray) -> tuple[np.ndarray, ...]:
    """One number per character of UTF-8 bytes, and byte positions turned into those of characters."""
    if not len(data) or data.max() < 0x80:
        return data.astype(np.uint32), *places
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    codes = data[heads].astype(np.uint32)
    more = np.flatnonzero(codes >= 0xC0)
    for j in (1, 2, 3):
        at = heads[more] + j
        more = more[(at < len(data)) & ((data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80)]
        codes[more] |= data[heads[more] + j].astype(np.uint32) << np.uint32(8 * j)
    return codes, *[np.searchsorted(heads, p) for p in places]


def characters(text: bytes | None) -> np.ndarray:
    """The characters of one normalised text."""
    raw = np.frombuffer(text or b"", np.uint8)
    data, lo, hi = _normalised(raw, np.array([0, len(raw)]))
    return _characters(data[lo[0] : hi[0]])[0]


def normalised(text: bytes | None) -> bytes:
    raw = np.frombuffer(text or b"", np.uint8)
    data, lo, hi = _normalised(raw, np.array([0, len(raw)]))
    return data[lo[0] : hi[0]].tobytes()


class Block:
    """Characters of some texts in a row: text ``row[r]`` from its character ``base[r]`` on lies at lo[r] to hi[r].

    ``last`` says whether the texts end there.
    """

    def __init__(self, codes: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: np.ndarray, last: bool = True) -> None:
        self.codes, self.row, self.lo, self.hi, self.base, self.last = codes, row, lo, hi, base, last

    @functools.cached_property
    def grams(self) -> dict[int, np.ndarray]:
        """Hashes of the q-grams at every position, by q."""
        found, q, h = {}, 1, self.codes.astype(np.uint64)
        while q < Q:
            if len(h) > q:
                h = h[:-q] * np.uint64(pow(_BASE, q, 1 << 64)) + h[q:]
            else:
                h = h[:0]
            q *= 2
            found[q] = h
        return found


def blocks(texts: pa.Array, overlap: int) -> Iterator[Block]:
    """The texts in blocks; pieces of a long one overlap by ``overlap`` characters."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1)
        norm, lo, hi = _normalised(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        step = max(BLOCK, 4 * overlap)
        if j > i + 1 or len(norm) <= step:
            codes, lo, hi = _characters(norm, lo, hi)
            yield Block(codes, np.arange(i, j), lo, hi, np.zeros(j - i, np.int64))
        else:
            norm, base, at = norm[lo[0] : hi[0]], 0, 0
            while at < len(norm):
                upto = min(at + step, len(norm))
                while upto < len(norm) and norm[upto] & 0xC0 == 0x80:
                    upto += 1
                codes, end = _characters(norm[at : upto + 4 * overlap], np.array([upto - at]))
                yield Block(codes, np.array([i]), np.array([0]), np.array([len(codes)]), np.array([base]), upto + 4 * overlap >= len(norm))
                base, at = base + int(end[0]), upto
        i = j


class Items:
    """The q-gram index of some items, given by their characters."""

    def __init__(self, texts: list[np.ndarray], q: int = Q) -> None:
        self.q, self.texts = q, texts
        m = np.array([len(t) for t in texts], dtype=np.int64)
        self.k = m // PER_EDIT
        self.need = m - q + 1 - self.k * q
        if (self.need < 1).any():
            raise ValueError(f"{q}-grams cannot find items of {m[self.need < 1].min()} characters with their edits")
        self.unit = m + self.k + 1
        self.longest = int(m.max(initial=0))
        self.overlap = int((m + 2 * self.k + 1).max(initial=0))
        block = Block(np.concatenate([np.empty(0, np.uint32), *texts]), *[np.empty(0, np.int64)] * 4)
        starts = np.cumsum(m) - m
        item = np.repeat(np.arange(len(texts)), m - q + 1)
        at = np.arange(len(item)) - np.repeat(np.cumsum(m - q + 1) - (m - q + 1), m - q + 1)
        gram = block.grams[q][starts[item] + at] * _MIX if len(item) else np.empty(0, np.uint64)
        gram, item, at = self._without_frequent(gram, item, at)
        order = np.lexsort((at, item, gram))
        gram, item, at = gram[order], item[order], at[order]
        new = np.ones(len(gram), dtype=bool)
        new[1:] = (gram[1:] != gram[:-1]) | (item[1:] != item[:-1]) | (np.diff(at) > self.k[item[1:]] + 1)
        first = np.flatnonzero(new)
        #: Runs of an item's positions that have the same q-gram, sorted by q-gram.
        self.item, self.low = item[first], at[first]
        self.high = at[np.append(first[1:], len(at)) - 1] if len(first) else at[:0]
        self.grams, self.first, self.count = np.unique(gram[first], return_index=True, return_counts=True)
        self.bits = np.uint64(64 - min(24, max(16, (16 * len(self.grams)).bit_length())))
        self.table = np.zeros(1 << (64 - int(self.bits)), dtype=bool)
        self.table[self.grams >> self.bits] = True

    def _without_frequent(self, gram: np.ndarray, item: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaves out the most frequent q-grams of each item, at most half of its bound, and lowers the bound."""
        if not len(gram):
            return gram, item, at
        _, which, count = np.unique(gram, return_inverse=True, return_counts=True)
        order = np.lexsort((at, -count[which], item))
        # The place of each q-gram among those of its item, the most frequent first.
        size = np.bincount(item, minlength=len(self.need))
        place = np.arange(len(gram)) - np.repeat(np.cumsum(size) - size, size)
        gone = np.zeros(len(gram), dtype=bool)
        gone[order] = (place < (self.need // 2)[item[order]]) & (count[which][order] > 1)
        self.need = self.need - np.bincount(item[gone], minlength=len(self.need))
        return gram[~gone], item[~gone], at[~gone]

    def candidates(self, block: Block) -> Iterator[tuple[int, int, np.ndarray]]:
        """(place in the block, item, first diagonals of its bands) that meet the bound."""
        grams = block.grams[self.q] * _MIX
        pos = np.flatnonzero(self.table[(grams >> self.bits).view(np.int64)])
        if not len(pos) or not len(self.grams):
            return
        found = np.minimum(np.searchsorted(self.grams, grams[pos]), len(self.grams) - 1)
        hit = self.grams[found] == grams[pos]
        pos, found = pos[hit], found[hit]
        # Each item has cells of its own, and one more at the end.
        size = len(block.codes) // self.unit + 2
        cells = np.cumsum(size) - size
        # Long lists of matches are taken in parts; stretches and bands sum up over parts.
        count = self.count[found]
        parts = [slice(a, b) for a, b in _parts(count, 1 << 22)]
        totals = np.zeros(min(int(size.sum()), MOST_CELLS), dtype=np.int64)
        for part in parts:
            totals += np.bincount(self._cell(*self._pairs(pos[part], found[part], count[part])[:2], cells), minlength=len(totals))
        keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        width = len(block.codes) + 2 * self.longest + 3
        for part in parts:
            at, item, low, high = self._pairs(pos[part], found[part], count[part])
            cell = self._cell(at, item, cells)
            near = np.maximum(totals[cell - 1], totals[(cell + 1) % len(totals)])
            good = totals[cell] + near >= self.need[item]
            at, item, low, high = at[good], item[good], low[good], high[good]
            step = self.k[item] + 1
            # Half bands from the run's first diagonal to its last; each lies in two bands.
            a, b = (at - high + self.longest) // step, (at - low + self.longest) // step + 1
            n = b - a + 1
            which = np.repeat(np.arange(len(n)), n)
            band = a[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            text = np.maximum(np.searchsorted(block.lo, at, side="right") - 1, 0)
            key = (text[which] * len(self.k) + item[which]) * width + band
            keys, sums = _summed(np.concatenate([keys, key]), np.concatenate([sums, np.ones(len(key), np.int64)]))
        item = keys // width % len(self.k)
        good = sums >= self.need[item]
        keys, item = keys[good], item[good]
        # Bands count from one below their first half.
        diagonal = (keys % width - 1) * (self.k[item] + 1) - self.longest
        pair = keys // width
        for x, y in _stretches(pair):
            yield int(pair[x]) // len(self.k), int(item[x]), diagonal[x:y]

    def _pairs(self, pos: np.ndarray, found: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """(position, item, first and last of the item's positions) of every run that a position matches."""
        which = np.repeat(self.first[found] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return np.repeat(pos, count), self.item[which], self.low[which], self.high[which]

    def _cell(self, pos: np.ndarray, item: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return (cells[item] + pos // self.unit[item]) % MOST_CELLS

    def verify(self, text: np.ndarray, i: int, diagonals: np.ndarray) -> tuple[int, int] | None:
        """(edits, position) of item i in the bands that start at ``diagonals``, if within the budget."""
        k, item = int(self.k[i]), self.texts[i]
        low, high = max(0, int(diagonals.min())), max(0, min(len(text), int(diagonals.max()) + 2 * (k + 1) + len(item) + k))
        exact = _find(text[low:high], item)
        if exact >= 0:
            return 0, low + exact
        return banded(item, text, diagonals - k, 4 * k + 2, k)

    def matches(self, block: Block) -> Iterator[tuple[int, int, int, int]]:
        """(place in the block, item, edits, position in the place)."""
        for r, i, diagonals in self.candidates(block):
            got = self.verify(block.codes[block.lo[r] : block.hi[r]], i, diagonals - block.lo[r])
            if got:
                yield r, i, *got


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of ``sizes`` that sum to about ``most``."""
    upto = np.cumsum(sizes)
    x = 0
    while x < len(sizes):
        y = max(x + 1, int(np.searchsorted(upto, upto[x] - sizes[x] + most, "right")))
        yield x, y
        x = y


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, which = np.unique(keys, return_inverse=True)
    return found, np.bincount(which, values, len(found)).astype(np.int64)


def _stretches(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each run of equal values begins and ends."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]) if len(values) else iter(())


def _find(text: np.ndarray, item: np.ndarray) -> int:
    """Where ``item`` begins in ``text``, or -1."""
    whole, part, at = text.tobytes(), item.tobytes(), -1
    while True:
        at = whole.find(part, at + 1)
        if at < 0 or at % item.itemsize == 0:
            return at // item.itemsize if at >= 0 else -1


def banded(item: np.ndarray, text: np.ndarray, diagonals: np.ndarray, width: int, budget: int) -> tuple[int, int] | None:
    """(edits, position) of the best alignment of all of ``item`` with a part of ``text``.

    Each row of the table is a band of ``width`` diagonals; its cell d, after i
    characters of the item, pairs them with the text up to ``diagonal + d + i``.
    Position is where the alignment ends less the item's length. Bands that are
    beyond the budget are given up.
    """
    far = len(item) + budget + 1
    end = np.sort(diagonals)[:, None] + np.arange(width)
    steps = np.arange(width)
    cost = np.where((end >= 0) & (end <= len(text)), 0, far)
    for i in range(1, len(item) + 1):
        j = end + i
        inside = (j >= 1) & (j <= len(text))
        same = inside & (text[np.clip(j - 1, 0, max(0, len(text) - 1))] == item[i - 1]) if len(text) else inside
        new = np.where(inside, cost + ~same, far)
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
        there = (j >= 0) & (j <= len(text))
        new = np.where(there, new, far)
        new = np.minimum.accumulate(new - steps, axis=1) + steps
        cost = np.where(there, new, far)
        alive = cost.min(axis=1) <= budget
        if not alive.all():
            cost, end = cost[alive], end[alive]
            if not len(cost):
                return None
    best = int(cost.argmin())
    return int(cost.ravel()[best]), max(0, int(end.ravel()[best]))


class Words:
    """Items of fewer than ``TINY`` characters, found exactly where no word goes on at either end."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        self.overlap = TINY + 1 if texts else 0
        self.number = {t.tobytes(): i for i, t in enumerate(texts)}
        self.hashes = {m: np.unique([self._hash(t[None, :])[0] for t in texts if len(t) == m]) for m in {len(t) for t in texts}}

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(rows), np.uint64)
        for c in range(rows.shape[1]):
            h = h * np.uint64(_BASE) + rows[:, c]
        return h

    def matches(self, block: Block) -> Iterator[tuple[int, int, int, int]]:
        """(place in the block, item, 0, position), as ``Items``; each position of an item may come."""
        codes = block.codes
        inside = _INSIDE[np.minimum(codes, 255)]
        cut = np.ones(len(codes) + 1, dtype=bool)
        cut[1:-1] = ~(inside[1:] & inside[:-1])
        # Texts end where the next begins; a piece may be cut inside of a word at its ends.
        whole = block.base == 0
        cut[0] = False
        cut[block.lo[whole]] = True
        cut[block.hi] = block.last
        for m, hashes in self.hashes.items():
            starts = np.flatnonzero(cut[: len(codes) + 1 - m] & cut[m:]) if len(codes) >= m else np.empty(0, np.int64)
            starts = starts[np.isin(self._hash(codes[starts[:, None] + np.arange(m)]), hashes)]
            place = np.searchsorted(block.lo, starts, side="right") - 1
            for r, s in zip(place.tolist(), starts.tolist()):
                i = self.number.get(codes[s : s + m].tobytes())
                if i is not None and s + m <= block.hi[r]:
                    yield r, i, 0, s - int(block.lo[r])


class Index:
    """Some items, each found in the way that its length allows."""

    def __init__(self, texts: list[bytes], keys: list[int] | None = None) -> None:
        codes = [characters(t) for t in texts]
        self.keys = list(range(len(texts))) if keys is None else keys
        kinds = ((1, TINY, Words), (TINY, SHORT, lambda t: Items(t, SHORT_Q)), (SHORT, 1 << 62, Items))
        self.parts = []
        for low, high, made in kinds:
            of = [n for n, c in enumerate(codes) if low <= len(c) < high]
            if of:
                self.parts.append((of, made([codes[n] for n in of])))
        self.overlap = max([p.overlap for _, p in self.parts], default=0)

    def matches(self, texts: pa.Array) -> dict[tuple[int, int], tuple[int, int]]:
        """(text, key) -> (edits, position), each item's best alignment, the first of equals."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        if not self.parts:
            return best
        for block in blocks(texts, self.overlap):
            for of, part in self.parts:
                for r, i, edits, position in part.matches(block):
                    at, got = (int(block.row[r]), self.keys[of[i]]), (edits, int(block.base[r]) + position)
                    if at not in best or got < best[at]:
                        best[at] = got
        return best


class Benchmark:
    """The items' distinct texts in the shared folder, in blocks, and ``names``: (key, item_id) of every item."""

    def __init__(self, items: DataFrame) -> None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [normalised(x.as_py()) for x in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["item_id", "text"])

        spark = items.sparkSession
        plain = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
        known = written(plain.mapInArrow(run, "item_id long, text binary").where(F.length("text") > 0).distinct(), "items")
        texts = written(known.select("text").distinct().withColumn("key", F.monotonically_increasing_id()), "item-texts")
        self.names = written(known.join(texts, "text").select("key", "item_id"), "item-names")
        total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
        n = max(1, -(-total // ITEM_CHARS))
        self.path = scratch(spark, "item-blocks")
        placed = texts.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")).repartition(n, "block")
        placed.write.partitionBy("block").parquet(self.path)
        self.blocks = sorted(r.block for r in placed.select("block").distinct().collect())

    def matches(self, batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, dict[tuple[int, int], tuple[int, int]]]]:
        """Each batch with (row, key) -> (edits, position); ``column`` has the texts."""
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(column).nbytes
            if len(self.blocks) == 1 or size >= GROUP:
                yield from self._matched(held, column)
                held, size = [], 0
        yield from self._matched(held, column)

    def _matched(self, held: list[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, dict[tuple[int, int], tuple[int, int]]]]:
        found: list[dict[tuple[int, int], tuple[int, int]]] = [{} for _ in held]
        for b in self.blocks if held else []:
            index = _index(self.path, b)
            for got, batch in zip(found, held):
                got |= index.matches(batch.column(column))
        yield from zip(held, found)

    def scanner(self) -> Benchmark:
        """What tasks need of this."""
        slim = object.__new__(Benchmark)
        slim.path, slim.blocks = self.path, self.blocks
        return slim


@functools.lru_cache(maxsize=1)
def _index(path: str, block: int) -> Index:
    store, at = pyarrow.fs.FileSystem.from_uri(path)
    rows = pyarrow.parquet.read_table(f"{at}/block={block}", filesystem=store, columns=["key", "text"]).sort_by("key")
    return Index(rows["text"].to_pylist(), rows["key"].to_pylist())


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, position): every document and each item it contains.

    ``position`` counts characters of the normalised text.
    """
    known = Benchmark(benchmark)
    scanner = known.scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in scanner.matches(batches, 1):
            ids = batch.column(0)
            rows = sorted((t, key, e, p) for (t, key), (e, p) in found.items())
            t, key, e, p = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(t, pa.int64())), pa.array(key, pa.int64()), pa.array(e, pa.int32()), pa.array(p, pa.int64())], names=["doc_id", "key", "edits", "position"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = plain.mapInArrow(run, "doc_id long, key long, edits int, position long")
    return found.join(known.names, "key").select("doc_id", "item_id", "edits", "position")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as they were."""
    schema, at = docs.schema, docs.columns.index("text")
    scanner = Benchmark(benchmark).scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in scanner.matches(batches, at):
            hit = {t for t, _ in found}
            yield batch.filter(pa.array([t not in hit for t in range(batch.num_rows)], pa.bool_()))

    return docs.mapInArrow(run, schema)
