"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

Tokens of a text are its words, A to Z lower-cased, and one end. The most frequent training words
make ``CLASSES`` - 1 classes of ``SLOTS`` words each, in order of frequency; all others, known or not,
are the class ``rest``. A token's probability is that of its class times that of its word within it:

    P(w | h) = softmax(u + sum_f C[f])[class(w)] * softmax(v[class(w)] + sum_f W[f, class(w)])[w]

Features f of the history h are the word before, the word before that (a skip), and both as a
pair, hashed to ``ROWS`` rows of the tables C and, along with the class, W. Words of the rest are
hashed as well where they are history. u and v are the logarithms of the exact smoothed unigram
counts, so that a model without weights gives the base score. A word w of the rest has (c + 0.5)
shares of the rest's mass, as in the base score; the probabilities of all training words and one
unknown word add up to 1 for any history.

Steps, all over whole tables:

- counts of all training words: blocks of texts are split and counted in Arrow, Spark adds up;
- the ``LOOKUP`` most frequent words of at most ``LOOKUP_CHARS`` characters are sent to the tasks;
  every other token meets its count in a join, so any number of words is exact;
- texts become 16-bit codes once, written in ``ROUNDS`` slices of the training documents and one
  of held-out ones, with the words of each document that the join must look up;
- training: in a round every task takes gradient steps (AdaGrad by row) over its part of a slice
  from the common weights, and gives out what it has changed as fixed-point numbers; Spark adds
  these up by row, weighted by how often a task met the row. Every training token is used once.
- scoring: sparse batches of feature rows in numpy, one scan of the codes.

The driver holds the lookup and the weights, both of fixed size.

Defined cases: a null text is empty: it has the end only. A null doc_id is not held out, and so
learned from. Repeated rows are documents of their own. Without training tokens every score is
that of the unknown word, 0 for the base. An empty table gives an empty result. Other columns
than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from folioflow.llm.common import id_bucket, pieces, scratch, split_words, written

FOLDS, HELD_OUT = 5, 1
CLASSES, SLOTS, ROWS = 32, 64, 2**14
LOOKUP, LOOKUP_CHARS = 2**16, 64
ROUNDS, BATCH, RATE = 3, 2**16, 1.0
#: Squared gradients that every row begins with, so that a row that is met a few times moves a little.
BEGUN = 64.0
#: Weights stay within this, so that three of them have an exponential in 32 bits.
LARGEST = 20.0
#: Tokens that are scored at a time, and of a batch of gradients.
SCORED, STRIPE = 2**13, 2**13
#: Weights travel in steps of 2^-16.
FIXED = 2.0**16
#: The end of a text among the words; no word is empty.
END = ""
MODELLED = (CLASSES - 1) * SLOTS
HASHED = 2**16 - 1 - MODELLED
#: The history before the first token.
START = 2**16 - 1


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, A to Z lower-cased, and how many each text has."""
    return split_words(pc.ascii_lower(texts))


def learned(docs: DataFrame) -> DataFrame:
    """(doc_id, text, held_out)."""
    held_out = F.coalesce(id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out.alias("held_out"))


def counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all tokens of training documents, ends included, in the shared folder."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                flat, _ = words(piece.column("text"))
                found = flat.value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([batch.num_rows])], ["word", "n"])

    found = docs.where("not held_out").select("text").mapInArrow(task, "word string, n long")
    return written(found.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


@dataclass
class Vocabulary:
    """The most frequent words, in order, with their counts; and the sums over all words."""

    words: list[str]
    n: np.ndarray
    tokens: int
    kinds: int
    #: Words at or above this count, of at most LOOKUP_CHARS characters, are in the lookup.
    least: int

    @property
    def modelled(self) -> int:
        return min(MODELLED, len(self.words))

    @property
    def total(self) -> float:
        return self.tokens + 0.5 * (self.kinds + 1)

    @property
    def rest(self) -> float:
        """The mass of the words that have no class of their own, the unknown one included."""
        return self.tokens - int(self.n[: self.modelled].sum()) + 0.5 * (self.kinds - self.modelled + 1)


def vocabulary(found: DataFrame) -> Vocabulary:
    tokens, kinds = found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    short = found.where(F.length("word") <= LOOKUP_CHARS)
    size = F.floor(F.log2("n") * 16)
    bins = sorted(((r.size, r.least, r.words) for r in short.groupBy(size.alias("size")).agg(F.min("n").alias("least"), F.count("*").alias("words")).collect()), reverse=True)
    least, so_far = 2**62, 0
    for _, n, many in bins:  # at most some 1000
        so_far += many
        if so_far > LOOKUP:
            break
        least = n
    rows = short.where(F.col("n") >= least).toArrow()
    order = sorted(zip((-rows["n"].to_numpy()).tolist(), rows["word"].to_pylist(), strict=True))
    return Vocabulary([w for _, w in order], np.array([-n for n, _ in order], np.int64), int(tokens), int(kinds), int(least))


def encoded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Every document as codes, in the shared folder.

    Columns: row (its number), doc_id, held_out, slice (of training; -1 if held out), n_tokens,
    and, of the tokens in the lookup, n_known, base and rest_score (log10); codes; and others:
    the words that are not in it, with their numbers.
    """
    at = {w: i for i, w in enumerate(known.words)}
    base = np.log10((known.n + 0.5) / known.total)
    rest = np.log10((known.n + 0.5) / known.rest)
    rest[: known.modelled] = 0.0
    shared = docs.sparkSession.sparkContext.broadcast((at, base, rest))  # LOOKUP words of LOOKUP_CHARS characters at most
    modelled, none = known.modelled, len(known.words)

    def code(word: str, place: int) -> int:
        return place if place < modelled else MODELLED + zlib.crc32(word.encode()) % HASHED

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, base, rest = shared.value
        base, rest = np.append(base, 0.0), np.append(rest, 0.0)
        row = TaskContext.get().partitionId() << 40
        end_at = at.get(END, none)
        end_code = code(END, end_at)
        for batch in batches:
            for piece in pieces(batch):
                flat, many = words(piece.column("text"))
                coded = flat.dictionary_encode()
                kinds = coded.dictionary.to_pylist()
                place = np.array([at.get(w, none) for w in kinds] or [none], np.int64)
                codes = np.array([code(w, p) for w, p in zip(kinds, place.tolist(), strict=False)] or [0], np.uint16)
                index = coded.indices.to_numpy(zero_copy_only=False)
                ends = np.cumsum(many)
                places = np.insert(place[index], ends, end_at)
                tokens = np.insert(codes[index], ends, end_code)
                upto = np.cumsum(many + 1)
                starts = upto - (many + 1)
                sums = lambda x: np.add.reduceat(x, starts)
                other = np.flatnonzero(place[index] == none)
                of = np.repeat(np.arange(len(many)), many)[other]
                pairs, times = np.unique(of.astype(np.int64) << 32 | index[other], return_counts=True)
                if end_at == none:  # the end is a word like any other
                    last = len(kinds)
                    kinds.append(END)
                    pairs = np.concatenate([pairs, np.arange(len(many), dtype=np.int64) << 32 | last])
                    times = np.concatenate([times, np.ones(len(many), np.int64)])
                    order = np.argsort(pairs, kind="stable")
                    pairs, times = pairs[order], times[order]
                offsets = np.searchsorted(pairs >> 32, np.arange(len(many) + 1)).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(kinds, pa.string()).take(pa.array(pairs & 0xFFFFFFFF)), pa.array(times.astype(np.int64))], ["word", "n"])
                data = pa.py_buffer(tokens.tobytes())
                binary = pa.Array.from_buffers(pa.binary(), len(many), [None, pa.py_buffer((np.concatenate([[0], upto]) * 2).astype(np.int32).tobytes()), data])
                n = piece.num_rows
                numbers = np.arange(row, row + n)
                row += n
                held_out = piece.column("held_out").to_numpy(zero_copy_only=False)
                part = np.where(held_out, -1, numbers % ROUNDS).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers), piece.column("doc_id"), piece.column("held_out"), pa.array(part), pa.array((many + 1).astype(np.int64)), pa.array(sums((places != none).astype(np.int64))), pa.array(sums(base[places])), pa.array(sums(rest[places])), binary, pa.ListArray.from_arrays(pa.array(offsets), items)],
                    ["row", "doc_id", "held_out", "slice", "n_tokens", "n_known", "base", "rest_score", "codes", "others"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.mapInArrow(task, f"row long, doc_id {id_type}, held_out boolean, slice int, n_tokens long, n_known long, base double, rest_score double, codes binary, others array<struct<word: string, n: bigint>>")
    path = scratch(docs.sparkSession, "language-model-codes")
    rows.write.partitionBy("slice").parquet(path)
    shared.destroy()
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


@dataclass
class Model:
    """Weights of fixed size, and the logarithms of the unigram shares."""

    classes: np.ndarray  # u
    slots: np.ndarray  # v, by class
    class_weights: np.ndarray = field(default_factory=lambda: np.zeros((ROWS, CLASSES), np.float32))
    word_weights: np.ndarray = field(default_factory=lambda: np.zeros((ROWS, SLOTS), np.float32))


def unigram(known: Vocabulary) -> Model:
    mass = np.zeros((CLASSES - 1, SLOTS))
    mass.ravel()[: known.modelled] = known.n[: known.modelled] + 0.5
    by_class = np.append(mass.sum(1), known.rest)
    log = lambda x: np.log(x, out=np.full(x.shape, -1e4), where=x > 0)
    slots = log(mass / np.maximum(by_class[:-1, None], 1e-300))
    return Model(log(by_class / by_class.sum()).astype(np.float32), slots.astype(np.float32))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def history(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(feature, token): the hashed features before every token; texts begin at ``starts``."""
    one, two = np.empty_like(codes), np.empty_like(codes)
    one[1:], two[2:] = codes[:-1], codes[:-2]
    one[starts] = START
    two[starts] = START
    second = starts + 1
    two[second[second < len(codes)]] = START
    one, two = one.astype(np.uint64), two.astype(np.uint64)
    return np.stack([_mixed(one, 1 << 40), _mixed(two, 2 << 40), _mixed(one << np.uint64(16) | two, 3 << 40)])


def _rows(features: np.ndarray) -> np.ndarray:
    return (features & np.uint64(ROWS - 1)).astype(np.int32)


def _with_class(features: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return _rows(_mixed(features ^ (classes.astype(np.uint64) << np.uint64(48)), 7))


def _exponents(weights: np.ndarray, rows: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exponents, their sums) of a softmax by token; weights are kept so small that none overflows."""
    x = weights[rows[0]]
    for r in rows[1:]:
        x += weights[r]
    x += prior
    np.exp(x, out=x)
    return x, x.sum(1)


def _classes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of every token, and which tokens have a word of a class of its own."""
    codes = codes.astype(np.int64)
    return np.minimum(codes // SLOTS, CLASSES - 1), np.flatnonzero(codes < MODELLED)


def token_scores(model: Model, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Natural logarithm of every token's class and, for words with a class of their own, slot."""
    out = np.empty(len(codes))
    features = history(codes, starts)
    for at in range(0, len(codes), SCORED):
        f, c = features[:, at : at + SCORED], codes[at : at + SCORED]
        cls, own = _classes(c)
        x, total = _exponents(model.class_weights, _rows(f), model.classes)
        share = (x[np.arange(len(c)), cls] / total).astype(np.float64)
        x, total = _exponents(model.word_weights, _with_class(f[:, own], cls[own]), model.slots[cls[own]])
        share[own] *= x[np.arange(len(own)), c[own] % SLOTS] / total
        out[at : at + SCORED] = np.log(share + 1e-300)
    return out


class Learner:
    """Gradient steps from common weights; counts how often each row of a table was met."""

    def __init__(self, model: Model) -> None:
        self.model = Model(model.classes, model.slots, model.class_weights.copy(), model.word_weights.copy())
        self.squares = [np.full(ROWS, BEGUN), np.full(ROWS, BEGUN)]
        self.met = [np.zeros(ROWS, np.int64), np.zeros(ROWS, np.int64)]

    def _step(self, table: int, weights: np.ndarray, rows: np.ndarray, prior: np.ndarray, target: np.ndarray) -> None:
        """The gradient of all tokens of a batch, added up by row of the table; rows move by AdaGrad."""
        x = np.empty((rows.shape[1], weights.shape[1]), np.float32)
        for at in range(0, len(x), STRIPE):
            part = slice(at, at + STRIPE)
            expected, total = _exponents(weights, rows[:, part], prior if prior.ndim == 1 else prior[part])
            x[part] = expected / total[:, None]
        x[np.arange(len(x)), target] -= 1
        gradient = np.zeros((x.shape[1], ROWS))
        for column, sums in zip(x.T, gradient, strict=True):
            wrong = column.astype(np.float64)
            for r in rows:
                sums += np.bincount(r, wrong, ROWS)
        for r in rows:
            self.met[table] += np.bincount(r, minlength=ROWS)
        self.squares[table] += np.einsum("ij,ij->j", gradient, gradient)
        gradient *= RATE / np.sqrt(self.squares[table])
        weights -= gradient.T
        np.clip(weights, -LARGEST, LARGEST, out=weights)

    def learn(self, codes: np.ndarray, starts: np.ndarray) -> None:
        features, m = history(codes, starts), self.model
        for at in range(0, len(codes), BATCH):
            f, c = features[:, at : at + BATCH], codes[at : at + BATCH]
            cls, own = _classes(c)
            self._step(0, m.class_weights, _rows(f), m.classes, cls)
            if len(own):
                self._step(1, m.word_weights, _with_class(f[:, own], cls[own]), m.slots[cls[own]], c[own] % SLOTS)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a column of texts one after another, and where each begins. Every text has its end."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    codes = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint16)
    return codes, (offsets[:-1] - offsets[0]).astype(np.int64) // 2


def trained(rows: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> Model:
    """The weights after one pass over all training documents, in as many slices as rounds."""
    model, sc = unigram(known), rows.sparkSession.sparkContext
    for k in range(rounds):
        shared = sc.broadcast(model)

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            before, learner = shared.value, Learner(shared.value)
            for batch in batches:
                if batch.num_rows:
                    learner.learn(*_joined(batch.column(0)))
            after = learner.model
            for table, (old, new) in enumerate(((before.class_weights, after.class_weights), (before.word_weights, after.word_weights))):
                touched = np.flatnonzero(learner.met[table])
                change = np.rint((new[touched] - old[touched]) * FIXED).astype(np.int32)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(change.ravel()), change.shape[1]).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(touched), table, np.int32)), pa.array(touched.astype(np.int32)), pa.array(learner.met[table][touched]), lists], ["table", "at", "met", "change"])

        changes = rows.where(F.col("slice") == k).select("codes").mapInArrow(task, "table int, at int, met long, change array<int>")
        summed = changes.groupBy("table", "at").agg(F.sum("met").alias("met"), *[F.sum(F.col("met") * F.get("change", F.lit(i))).alias(f"c{i}") for i in range(max(CLASSES, SLOTS))])
        found = summed.toArrow()  # one row for each row of the tables at most
        for table, weights in enumerate((model.class_weights, model.word_weights)):
            own = found.filter(pc.equal(found["table"], table))
            at, met = own["at"].to_numpy(), own["met"].to_numpy()
            for i in range(weights.shape[1]):
                weights[at, i] += own[f"c{i}"].to_numpy() / met / FIXED
        shared.destroy()
    return model


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every document."""
    docs = learned(docs)
    found = counts(docs)
    known = vocabulary(found)
    rows = encoded(docs, known)
    shared = docs.sparkSession.sparkContext.broadcast(trained(rows, known))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, starts = _joined(batch.column("codes"))
            sums = np.add.reduceat(token_scores(shared.value, codes, starts), starts) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sums + batch.column("rest_score").to_numpy())], [*names, "score"])

    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base"]
    model_rows = rows.select(*names, "rest_score", "codes").mapInArrow(task, StructType([*rows.select(*names).schema.fields, StructField("score", DoubleType())]))
    rare = found.where((F.col("n") < known.least) | (F.length("word") > LOOKUP_CHARS)).withColumnRenamed("n", "c")
    others = rows.select("row", F.explode("others").alias("o")).select("row", "o.word", "o.n").join(rare, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    log = lambda mass: F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / F.lit(mass)))
    sums = others.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"), log(known.total).alias("more_base"), log(known.rest).alias("more_score"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return model_rows.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + zero("more_known")).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
