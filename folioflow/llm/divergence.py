"""Source divergence audit: how far the sources of a language lie apart, and by which terms.

Terms are runs of letters and of characters beyond ASCII; only A to Z are lower-cased. Each lang keeps
the terms that ``LEAST_DOCS`` or more of its documents hold. A group (lang, source) gives a
kept term of ``count`` occurrences the share ``p = 1 + floor(SCALE * (count + 5) / (N + 5 * V))``,
with N the occurrences of kept terms in the group and V the lang's number of kept terms.

- ``pair``: for every other source of the lang, the sum of |p - q| over all kept terms;
- ``term``: the kept terms that the group holds more of than its lang does, by p - q.

Spark's CountVectorizer, with minDF and the largest vocabSize, builds the vocabulary and the
documents' sparse count vectors. Its words carry their lang, so one fit over all documents
gives the vocabulary of every lang, each by its own document counts. Vocabularies pass
through the driver and are sent to the tasks, so their size is kept in bounds: where the
corpus has more than ``MOST_TERMS`` terms, they are dealt by hash to several vectorizers of
about that size, each over all documents. The result is the same for any number of them.

Group sums are those of the sparse vectors' entries, added up in each batch of documents before they are dealt out. Pairs of
sources meet in blocks of terms and sources: a task holds the present counts of at most
about 2 * ``SOURCES`` sources and ``TERMS`` terms, puts all of them against each other in
numpy, and gives out one sum a pair. Terms that neither block holds differ by the two
sources' shares of a count of zero, which is added once for all of them. All arithmetic
is in 64-bit integers.

Defined cases: null text, lang and source count as empty strings; every row is a document,
repeated rows too; a lang without kept terms gives pairs of value 0 and no terms; a lang of
one source gives no pairs; an empty table gives an empty result; other columns are ignored.
Exact for groups of fewer than 9 * 10^15 occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import pieces, scratch, split_words, written

#: What a text's bytes become: ASCII ones other than letters blanks, A to Z small, all others what they are.
BYTES = bytes(x if x > 0x7F or chr(x).islower() else ord(chr(x).lower()) if chr(x).isalpha() else 0x20 for x in range(256))
LEAST_DOCS = 30
SCALE, SCALE_STEPS = 1_000_000_000, (1000, 1000, 1000)
#: Smaller counts can be multiplied by SCALE in 64 bits.
FITS = 9_000_000_000
PRIOR = 5
MOST_RANKS = 50
#: Terms (of any number of documents) that one vectorizer is given.
MOST_TERMS = 4_000_000
#: Terms and sources of a block.
TERMS, SOURCES = 1024, 256
#: A word of no term. It stands in ``LEAST_DOCS`` rows of its own, as a vocabulary must not be empty.
NO_TERM = " "

PAIRS = "lang string, source string, item string, part_value long"


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts one after another, and how many each text has. ASCII bytes never are a part of other characters."""
    texts = pc.fill_null(texts, "")
    data = texts.buffers()[2]
    moved = pa.Array.from_buffers(pa.string(), len(texts), [None, texts.buffers()[1], pa.py_buffer(data.to_pybytes().translate(BYTES) if data else b"")], 0, texts.offset)
    return split_words(moved)


def _documents(docs: DataFrame) -> DataFrame:
    """(lang, source, words): every document's terms with the lang behind them. No term holds a blank."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                flat, many = terms(piece.column("text"))
                lang = piece.column("lang").take(pa.array(np.repeat(np.arange(len(many)), many)))
                words = pc.binary_join_element_wise(flat, lang, " ")
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), words)
                yield pa.RecordBatch.from_arrays([piece.column("lang"), piece.column("source"), lists], ["lang", "source", "words"])

    full = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(full("lang"), full("source"), full("text")).mapInArrow(task, "lang string, source string, words array<string>")


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of sparse vectors, added up by group within each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lang, source = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
        many = len(source.dictionary)
        group = lang.indices.to_numpy().astype(np.int64) * many + source.indices.to_numpy()
        keys = np.repeat(group, pc.list_value_length(batch.column("indices")).to_numpy()) << 32 | batch.column("indices").flatten().to_numpy()
        if not len(keys):
            continue
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n = np.add.reduceat(batch.column("values").flatten().to_numpy()[order].astype(np.int64), first)
        keys = keys[first]
        group = keys >> 32
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(group // many)), source.dictionary.take(pa.array(group % many)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], ["lang", "source", "i", "n"]
        )


def group_sums(documents: DataFrame, least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS) -> tuple[DataFrame, DataFrame]:
    """The vocabularies (lang, id, term) and the sums (lang, source, id, count) of all documents' vectors."""
    spark = documents.sparkSession
    distinct = documents.select(F.explode("words").alias("word")).agg(F.approx_count_distinct("word", 0.05)).first()[0]
    slices = max(1, -(-distinct // most_terms))
    stand_in = spark.range(least_docs).select(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.array(F.lit(NO_TERM)).alias("words"))
    vocabularies, sums = [], []
    for k in range(slices):
        own = documents
        if slices > 1:
            own = own.withColumn("words", F.filter("words", lambda w: F.pmod(F.xxhash64(w), F.lit(slices)) == k))
        rows = own.unionByName(stand_in)
        model = CountVectorizer(inputCol="words", outputCol="vector", minDF=float(least_docs), vocabSize=2**31 - 1).fit(rows)
        path = scratch(spark, "vocabulary")
        model.write().save(path)
        number = F.col("i").cast("long") + k * 2**31
        words = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("i", "word")).where(F.col("word") != NO_TERM)
        vocabularies.append(words.select(F.substring_index("word", " ", 1).alias("term"), F.expr("substring(word, instr(word, ' ') + 1)").alias("lang"), number.alias("id")))
        vectors = model.transform(own).select("lang", "source", F.unwrap_udt("vector").alias("v"))
        entries = vectors.select("lang", "source", "v.indices", "v.values").mapInArrow(_added, "lang string, source string, i int, n long")
        sums.append(entries.groupBy("lang", "source", "i").agg(F.sum("n").alias("count")).select("lang", "source", number.alias("id"), "count"))
    union = lambda dfs: dfs[0] if len(dfs) == 1 else union([dfs[0].unionByName(dfs[1]), *dfs[2:]])
    return written(union(vocabularies), "vocabularies"), written(union(sums), "group-sums")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * kept)); by long division in steps where the product has over 64 bits."""
    divisor = total + PRIOR * kept
    div = lambda x: F.call_function("div", x, divisor)
    rest = count + PRIOR
    quotient = div(rest)
    rest = rest - quotient * divisor
    for step in SCALE_STEPS:
        digits = div(rest * step)
        rest = rest * step - digits * divisor
        quotient = quotient * step + digits
    return 1 + F.when(count < FITS, div((count + PRIOR) * SCALE)).otherwise(quotient)


def groups(documents: DataFrame, vocabulary: DataFrame, sums: DataFrame) -> DataFrame:
    """Every (lang, source) with n, the lang's lang_n, kept and sources, and the shares zero of no occurrence."""
    found = documents.select("lang", "source").distinct()
    n = sums.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    g = found.join(n, ["lang", "source"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    langs = g.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count("*").alias("sources"))
    langs = langs.join(vocabulary.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left").withColumn("kept", F.coalesce("kept", F.lit(0).cast("long")))
    g = g.join(langs, "lang")
    return g.withColumn("zero", F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("n"), F.col("kept"))).otherwise(F.lit(0).cast("long")))


def term_rows(found: DataFrame, vocabulary: DataFrame, sums: DataFrame) -> DataFrame:
    """The terms that a group holds more of than its lang, best first."""
    known = sums.join(vocabulary.select("id", "term"), "id").withColumn("lang_count", F.sum("count").over(Window.partitionBy("id")))
    rows = known.join(found.select("lang", "source", "n", "lang_n", "kept"), ["lang", "source"])
    more = share(F.col("count"), F.col("n"), F.col("kept")) - share(F.col("lang_count"), F.col("lang_n"), F.col("kept"))
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), more.alias("value")).where("value > 0")
    return _ranked(rows).where(F.col("rank") <= MOST_RANKS)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _met(table: pa.Table) -> pa.Table:
    """One block: sources of one or two source blocks, with their shares of the block's terms."""
    first = table.column("id").is_null()  # a source's own row, of which each has one
    own = table.filter(first)
    names, zero = own.column("source").to_pylist(), own.column("zero").to_numpy()
    lang, a, b = (own.column(c)[0].as_py() for c in ("lang", "a", "b"))
    part = own.column("block").to_numpy()
    rest = table.filter(pc.invert(first))
    number = {s: i for i, s in enumerate(names)}
    at = np.fromiter((number[s] for s in rest.column("source").to_pylist()), np.int64, rest.num_rows)
    ids, column = np.unique(rest.column("id").to_numpy(), return_inverse=True)
    shares = np.repeat(zero[:, None], len(ids), 1)
    shares[at, column] = rest.column("share").to_numpy()
    every = own.column("kept")[0].as_py() if own.column("terms")[0].as_py() < 0 else 0
    left = np.flatnonzero(part == a)
    found = [[], [], []]
    for i in left:
        others = np.flatnonzero(part == b) if a != b else left[left > i]
        if len(others):
            apart = np.abs(zero[others] - zero[i])
            sums = np.abs(shares[others] - shares[i]).sum(1) + (every - len(ids)) * apart
            found[0] += [names[i]] * len(others)
            found[1] += [names[j] for j in others]
            found[2].append(sums)
    values = np.concatenate(found[2]) if found[2] else np.zeros(0, np.int64)
    return pa.table({"lang": pa.array([lang] * len(values), pa.string()), "source": pa.array(found[0], pa.string()), "item": pa.array(found[1], pa.string()), "part_value": pa.array(values, pa.int64())})


def pair_rows(found: DataFrame, sums: DataFrame) -> DataFrame:
    """Every pair of sources of a lang, both ways, with the sum of their differences."""
    dealt = lambda key, n, size: F.pmod(F.xxhash64(key), F.ceil(F.col(n) / size).cast("long"))
    placed = found.where("sources > 1").withColumn("block", dealt("source", "sources", SOURCES)).withColumn("blocks", F.ceil(F.col("sources") / SOURCES).cast("long"))
    meets = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("a"), F.greatest(o, F.col("block")).alias("b"))))
    placed = placed.withColumn("m", meets).select("lang", "source", "kept", "n", "zero", "block", "m.a", "m.b")
    # Each source stands in every block of terms, and in one more (-1) that counts the terms of none.
    all_blocks = F.explode(F.sequence(F.lit(-1).cast("long"), F.ceil(F.col("kept") / TERMS).cast("long") - 1))
    own = placed.withColumn("terms", all_blocks).select("lang", "terms", "a", "b", "source", "block", "kept", "zero", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("share"))
    rows = sums.join(placed, ["lang", "source"]).withColumn("terms", dealt("id", "kept", TERMS))
    rows = rows.select(*own.columns[:-1], share(F.col("count"), F.col("n"), F.col("kept")).alias("share"))
    halves = own.unionByName(rows).groupBy("lang", "terms", "a", "b").applyInArrow(_met, PAIRS)
    pairs = halves.groupBy("lang", "source", "item").agg(F.sum("part_value").alias("value"))
    ways = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    both = pairs.select("lang", "value", ways.alias("w")).select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
    return _ranked(both)


def audited(docs: DataFrame, least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS) -> DataFrame:
    """lang, source, part, item, value and rank: see above."""
    documents = written(_documents(docs), "divergence-terms")
    vocabulary, sums = group_sums(documents, least_docs, most_terms)
    found = written(groups(documents, vocabulary, sums), "divergence-groups")
    return term_rows(found, vocabulary, sums).unionByName(pair_rows(found, sums)).select("lang", "source", "part", "item", "value", "rank")
