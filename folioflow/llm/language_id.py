"""Language identification with string kernels.

Texts are compared by a blended-spectrum presence kernel: how many character n-grams
of ``GRAMS`` lengths two texts share, over the root of the product of their numbers.
Some texts of the labelled sample are landmarks (Nystrom): every text is described
by its kernel with the landmarks, whitened by the landmarks' own kernel matrix, and
one ridge regression per language (one against the rest) maps that description to a
score. Texts are scored in batches by matrix products: presence matrix times
landmarks, times coefficients. All n-grams of a text count for its number, and all
that a landmark has for what they share.

Only text and non-null lang of rows outside the held-out fold are learned from, and
only a bounded sample of them, of every language: about ``PER_LANGUAGE`` rows, fewer
where ``MOST_ROWS`` rows would be exceeded, drawn by the hash of doc_id (rows that
share a doc_id by that of their text). There are ``MOST_LANDMARKS`` landmarks at most,
as many of each language as that leaves; with more languages than that, the last ones
(by name) have coefficients but no landmark. N-grams are extracted on the
executors; the sample comes to the driver as sets of n-gram numbers. Letters are
lower-cased and folded into 63 classes, everything else is a gap.

Whole texts are read, in blocks of bounded size.

Defined cases: null, empty and letterless texts are ``und`` with score 0, and so is
every text when nothing can be learned; a null doc_id is never learned from and not
held out; with one language every text is of that language; repeated rows repeat; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import id_bucket

FOLDS, HELD_OUT = 4, 2
PER_LANGUAGE = 150
#: Rows of all languages that are learned from.
MOST_ROWS = 30_000
LANDMARKS_PER_LANGUAGE = 32
MOST_LANDMARKS = 512
#: N-grams whose landmarks are multiplied at a time.
STRIPE = 1 << 14
GRAMS = (1, 2, 3)
#: Cells of the presence matrix of a batch.
CELLS = 1 << 24
RIDGE = 1e-2
BLOCK = 1 << 20
UNKNOWN = "und"
#: Where the n-gram numbers of each length begin.
BASES = {1: 0, 2: 64, 3: 64 + 64**2}
SPACE = 64 + 64**2 + 64**3


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point: a-z are 1 to 26, other letters share 27 to 63, the rest is 0."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            table[c] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 % 2**32 >> 16) % 37
    return table


def blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, n-gram numbers) of the texts, piece by piece; a long text comes in overlapping pieces."""
    parts, rows, size = [], [], 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(p) for p in parts])
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        c = classes()[points].astype(np.int32)
        row = np.repeat(np.array(rows, dtype=np.int32), lengths)
        # Two gaps in a row are one: an n-gram has at most one, at its ends or inside.
        keep = np.ones(len(c), dtype=bool)
        keep[1:] = (c[1:] > 0) | (c[:-1] > 0) | (row[1:] != row[:-1])
        c, row = c[keep], row[keep]
        out_rows, out = [row], [c]
        if len(c) > 1:
            two = c[:-1] * 64 + c[1:]
            same = row[:-1] == row[1:]
            out.append(two[same] + BASES[2]), out_rows.append(row[:-1][same])
            if len(c) > 2:
                three = two[:-1] * 64 + c[2:]
                same = row[:-2] == row[2:]
                out.append(three[same] + BASES[3]), out_rows.append(row[:-2][same])
        return np.concatenate(out_rows), np.concatenate(out)

    for k, text in enumerate(texts):
        text = text or ""
        for at in range(0, max(1, len(text)), BLOCK):
            # A text ends in a gap, whatever comes after it; a piece that is not its last stands alone.
            piece = text[at : at + BLOCK + 2] + ("\n" if at + BLOCK >= len(text) else "")
            parts.append(piece), rows.append(k)
            size += len(piece)
            if size >= BLOCK:
                yield flush()
                parts, rows, size = [], [], 0
    if parts:
        yield flush()


class Model:
    def __init__(self, samples: list[np.ndarray], langs: list[str]) -> None:
        """``samples`` are the sets of n-grams of texts, as sorted numbers."""
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        per = max(1, min(LANDMARKS_PER_LANGUAGE, MOST_LANDMARKS // len(self.langs)))
        own: dict[str, list[int]] = {}
        for k, x in enumerate(langs):
            own.setdefault(x, []).append(k)
        # Where there are more languages than landmarks, some have none of their own.
        marks = [i for lang in self.langs for i in own[lang][:per]][:MOST_LANDMARKS]
        has = np.zeros((SPACE, len(marks)), dtype=np.uint8)
        for c, i in enumerate(marks):
            has[samples[i], c] = 1
        has[0] = 0
        size = np.maximum(1, [np.count_nonzero(s) for s in samples])
        x = np.stack([has[s].sum(axis=0, dtype=np.int64) for s in samples]) / np.sqrt(size[:, None] * size[marks][None, :])
        values, vectors = np.linalg.eigh(x[marks].astype(np.float64))
        good = values > 1e-6 * max(values.max(), 1e-12)
        whiten = vectors[:, good] / np.sqrt(values[good])
        z = x @ whiten
        y = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        z1 = np.concatenate([z, np.ones((len(z), 1))], axis=1)
        beta = np.linalg.solve(z1.T @ z1 + RIDGE * len(z) * np.eye(z1.shape[1]) * 0.1, z1.T @ y)
        self.alpha, self.shift = whiten @ beta[:-1], beta[-1]
        #: The n-grams that any landmark has, and the landmarks' kernels' part of each.
        self.known = np.flatnonzero(has.any(axis=1))
        self.landmarks, self.sizes = has[self.known], size[marks]

    def rows(self) -> int:
        """Texts that are scored at a time."""
        return max(1, min(128, CELLS // SPACE))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of at most ``rows`` texts."""
        present = np.zeros((len(texts), SPACE), dtype=np.uint8)
        for row, grams in blocks(texts):
            present[row, grams] = 1
        letters = present[:, 1:64].any(axis=1)
        if not self.langs or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        size = np.maximum(1, present[:, 1:].sum(axis=1, dtype=np.int64))
        # The products are whole numbers, which single precision holds exactly; landmarks take a byte an n-gram otherwise.
        common = np.zeros((len(texts), len(self.sizes)), np.float32)
        for at in range(0, len(self.known), STRIPE):
            common += present[:, self.known[at : at + STRIPE]].astype(np.float32) @ self.landmarks[at : at + STRIPE].astype(np.float32)
        kernel = common / np.sqrt(size[:, None] * self.sizes[None, :])
        decision = kernel @ self.alpha + self.shift
        best = decision.argmax(axis=1)
        score = np.clip((decision[np.arange(len(texts)), best].astype(np.float64) + 1) / 2, 0, 1)
        return [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters)], np.where(letters, score, 0.0)


def learnable(docs: DataFrame) -> DataFrame:
    fold = id_bucket(F.col("doc_id"), FOLDS)
    return docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & fold.isNotNull() & (fold != HELD_OUT))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> Model:
    lang = F.col("lang").cast("string")
    rows = learnable(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return Model([], [])
    per = max(1, min(per_language, most_rows // len(counts)))
    modulus = 1 << 40
    # Twice as many are drawn as are needed, so that chance leaves none short.
    shares = {r.lang: modulus if r.n <= 2 * per else int(2 * modulus * per / r.n) for r in counts}
    # A literal, one entry a language, so that rows are drawn while they are scanned.
    most = F.element_at(F.create_map(*[F.lit(x) for share in shares.items() for x in share]), F.col("lang"))
    rows = rows.withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(modulus)))
    drawn = rows.where(F.col("h") < most).withColumn("t", F.xxhash64("text"))
    drawn = drawn.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "t", "text"))).where(F.col("k") <= per)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                found = [np.unique(g) for _, g in blocks([batch.column(1)[at].as_py()])]
                grams = np.unique(np.concatenate(found)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + 1], batch.column(2)[at : at + 1], pa.array([grams.tolist()], pa.list_(pa.int32()))], names=["k", "lang", "grams"])

    sample = drawn.select("k", "text", "lang").mapInArrow(run, "k int, lang string, grams array<int>").collect()
    sample = sorted(sample, key=lambda r: (r.k, r.lang))
    return Model([np.array(r.grams, dtype=np.int64) for r in sample], [r.lang for r in sample])


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row; nothing but the text is read for it.

    The model is sent to the tasks; it has MOST_LANDMARKS * SPACE bytes at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, model.rows()):
                part = batch.slice(at, model.rows())
                langs, scores = model.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, lang_pred string, score double")
