"""Language by profiles of character trigrams, learnt from the labelled rows of the table itself.

A word's trigrams are those of the word in lower case between blanks. A language's profile has
how often each occurs in its learnt documents, one added to every count; a document's language is
that under which its trigrams are likeliest, its confidence the posterior of that language
when all are equally likely beforehand. Profiles that fit (``MOST_GAINS``) are handed to all tasks,
which sum up their documents' words there, so that nothing is shuffled but a row a document, and
cut a word once for many documents. Others are joined to the documents' trigrams, counted before they meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.config import TriageRules
from folioflow.sources.sinks import written


#: Languages, and trigrams times languages, of profiles that are handed to all tasks.
MOST_LANGUAGES, MOST_GAINS = 32, 400_000


def numbered(texts: DataFrame, *columns: str) -> DataFrame:
    """The rows with a number that stays, as they are written."""
    return written(texts.select(*columns, F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id()), "numbered")


#: Rows whose words a task looks at together, and words that it remembers.
ROWS, REMEMBERED = 500, 200_000


def lines(rows: DataFrame, key: str) -> DataFrame:
    """(key, line): the words of each text in lower case, between blanks."""
    # Blanks that are there already need not be replaced.
    return rows.select(key, F.regexp_replace(F.lower("text"), r"[^\p{L} ]+", " ").alias("line"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part.column(0), pc.split_pattern(part.column(1), " ")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, word, n) of (key, line), each pair once for the rows of a part."""
    for keys, lists in _parts(batches):
        table = pa.table({"key": keys.take(pc.list_parent_indices(lists)), "word": lists.flatten()})
        table = table.filter(pc.not_equal(table["word"], "")).group_by(["key", "word"]).aggregate([([], "count_all")])
        yield from table.select(["key", "word", "count_all"]).rename_columns(["key", "word", "n"]).to_batches()


def grams(rows: DataFrame, key: str) -> DataFrame:
    """(key, gram, n): how often the trigrams of all words of a key's texts occur."""
    kind = rows.schema[key].dataType.simpleString()
    counted = lines(rows, key).mapInArrow(_counted, f"{key} {kind}, word string, n long").groupBy(key, "word").agg(F.sum("n").alias("n"))
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    # All occurrences in a word, not only distinct ones.
    cut = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substring(padded, i, F.lit(3)))
    return counted.select(key, "n", F.explode(cut).alias("gram")).groupBy(key, "gram").agg(F.sum("n").alias("n"))


def profiles(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((lang, gram, gain), (lang, unseen)) of rows with text and lang: the logarithm of what is not in a profile, and what those in it gain."""
    counts = written(grams(labelled.where("lang is not null"), "lang"), "language-counts")
    kinds = counts.select("gram").distinct().count()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    unseen = totals.select("lang", (-F.log(F.col("total") + F.lit(kinds + 1))).alias("unseen"))
    return counts.select("lang", "gram", F.log(F.col("n") + 1).alias("gain")), unseen


def identified(texts: DataFrame, labelled: DataFrame, rules: TriageRules = TriageRules()) -> DataFrame:
    """(doc_id, code, confidence) of every row of ``texts`` (doc_id, text), learnt from ``labelled`` (text, lang).

    Rows without a letter, and all rows where nothing can be learnt, are undetermined.
    """
    gains, unseen = profiles(labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang")))
    rows = numbered(texts, "doc_id")
    known = unseen.limit(MOST_LANGUAGES + 1).collect()
    fits = len(known) <= MOST_LANGUAGES and gains.count() <= MOST_GAINS
    found = _handed(rows, gains, {r.lang: r.unseen for r in known}) if fits else _joined(rows, gains, unseen)
    return rows.select("row", "doc_id").join(found, "row", "left").select("doc_id", F.coalesce("code", F.lit(rules.fallback_language)).alias("code"), F.coalesce("confidence", F.lit(rules.fallback_confidence)).alias("confidence"))


def _summed(model: dict[str, tuple[float, ...]], n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(row, total, gains) of (row, line): the number of trigrams, and what they gain in each of ``n`` languages."""

    def word_sums(word: str) -> tuple[float, ...]:
        padded, sums = f" {word} ", [float(len(word))] + [0.0] * n
        for i in range(len(word)):
            for k, x in enumerate(model.get(padded[i : i + 3], ()), 1):
                sums[k] += x
        return tuple(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[float, ...]] = {}
        for rows, lists in _parts(batches):
            words = lists.flatten().dictionary_encode()
            if len(held) > REMEMBERED:
                held.clear()
            table = np.array([held[w] if w in held else held.setdefault(w, word_sums(w)) for w in words.dictionary.to_pylist()])
            codes = words.indices.to_numpy()
            # A line has one word at least, the empty one.
            begins = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())[:-1]))
            sums = [np.add.reduceat(table[codes, k], begins) for k in range(n + 1)]
            gains = pa.FixedSizeListArray.from_arrays(np.stack(sums[1:], axis=1).ravel(), n).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows, pa.array(sums[0]), gains], ["row", "total", "gains"])

    return run


def _handed(rows: DataFrame, gains: DataFrame, unseen: dict[str, float]) -> DataFrame:
    """(row, code, confidence) of rows that have a known trigram, by profiles that every task gets."""
    langs = sorted(unseen)
    if not langs:
        return rows.select("row", F.lit(None).cast("string").alias("code"), F.lit(None).cast("double").alias("confidence")).limit(0)
    of = F.array(*[F.coalesce(F.max(F.when(F.col("lang") == x, F.col("gain"))), F.lit(0.0)) for x in langs])
    model = {r.gram: tuple(r.gains) for r in gains.groupBy("gram").agg(of.alias("gains")).toLocalIterator()}
    sums = lines(rows, "row").mapInArrow(_summed(model, len(langs)), "row long, total double, gains array<double>")
    # A gain is above zero, so a sum of zero is that of a language of which the document has no trigram.
    score = lambda i: F.col("total") * F.lit(unseen[langs[i]]) + F.col("gains")[i]
    rated = F.array_compact(F.array(*[F.when(F.col("gains")[i] > 0, F.struct((-score(i)).alias("minus"), F.lit(x).alias("lang"))) for i, x in enumerate(langs)]))
    best = sums.select("row", rated.alias("rated")).select("row", "rated", F.array_min("rated").alias("best")).where("best is not null")
    total = F.aggregate("rated", F.lit(0.0), lambda s, r: s + F.exp(F.col("best.minus") - r["minus"]))
    return best.select("row", F.col("best.lang").alias("code"), (1 / total).alias("confidence"))


def _joined(rows: DataFrame, gains: DataFrame, unseen: DataFrame) -> DataFrame:
    """(row, code, confidence) of rows that have a known trigram, by profiles of any size."""
    own = written(grams(rows, "row"), "document-grams")
    totals = own.groupBy("row").agg(F.sum("n").alias("total"))
    seen = own.join(gains, "gram").groupBy("row", "lang").agg(F.sum(F.col("n") * F.col("gain")).alias("gain"))
    # Languages of which a document has no trigram at all are behind those of which it has any.
    likely = seen.join(totals, "row").join(unseen, "lang")
    likely = likely.select("row", "lang", (F.col("total") * F.col("unseen") + F.col("gain")).alias("score"))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "lang")
    rated = likely.withColumn("k", F.row_number().over(order)).withColumn("p", F.exp(F.col("score") - F.max("score").over(Window.partitionBy("row"))))
    return rated.groupBy("row").agg(F.max(F.when(F.col("k") == 1, F.col("lang"))).alias("code"), (1 / F.sum("p")).alias("confidence"))
