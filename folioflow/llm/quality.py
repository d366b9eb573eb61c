"""Quality rules: base counts, and divergence from language references.

The method compares two histograms of a document with those of its language over
the whole corpus, by Jensen-Shannon distance (base 2, so 0 to 1):

- character classes: small letters, capitals, other letters, digits, sentence
  punctuation and symbols among the characters of words, and white space;
- common words: each word that makes up at least ``COMMON_SHARE`` of the words of the
  language, the ``COMMON_WORDS`` most frequent of these, and all other words.

A document fails where a distance exceeds its limit. Distances of short documents
are noise, so each counts only from a least length on (``LEAST_CHARS``,
``LEAST_WORDS``); shorter documents pass that comparison. So do documents of a
language with fewer than ``LEAST_REFERENCE`` words in all, and of a null language:
too little is known of what they should look like.

All of it is DataFrame work inside the JVM. References come from all documents, one
row of at most COMMON_WORDS words a language; Spark's size check picks their joins.

Defined cases: null and empty texts count zero everywhere and fail the base rules;
a null doc_id and repeated rows are judged like any other; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import SPACE_CLASS, WORD_CLASS, words, written

COMMON_SHARE = 0.004
COMMON_WORDS = 12
#: Words that a language needs for a reference: its rarest common word is then seen some eight times.
LEAST_REFERENCE = 2000
LEAST_CHARS = 200
LEAST_WORDS = 60
MOST_CLASS_DISTANCE = 0.3
MOST_WORD_DISTANCE = 0.33
LEAST_N_WORDS = 50
MOST_REPEATED_PERCENT = 50

CLASSES = ("space", "lower", "upper", "letter", "digit", "punctuation", "symbol")


def _stripped(docs: DataFrame) -> DataFrame:
    """``docs`` with the words and the character-class counts c_<class> of each text.

    Each step strips one class from what the step before has left, so that later
    patterns run over short strings.
    """
    strip = lambda c, pattern: F.regexp_replace(c, pattern, "")
    d = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    d = d.withColumn("t1", strip(F.col("text"), "[a-z]+"))
    d = d.withColumn("t2", strip(F.col("t1"), SPACE_CLASS + "+"))
    d = d.withColumn("t3", strip(F.col("t2"), r"[.,;:!?'\"()\-]+"))
    d = d.withColumn("t4", strip(F.col("t3"), "[#*$%&|<>]+"))
    d = d.withColumn("t5", strip(F.col("t4"), "[A-Z]+"))
    d = d.withColumn("t6", strip(F.col("t5"), r"\p{L}+"))
    d = d.withColumn("t7", strip(F.col("t6"), r"\p{N}+"))
    less = lambda a, b: (F.length(a) - F.length(b)).cast("long")
    return d.select(
        "doc_id",
        "lang",
        "text",
        words(F.col("text")).alias("words"),
        less("text", "t1").alias("c_lower"),
        less("t1", "t2").alias("c_space"),
        less("t2", "t3").alias("c_punctuation"),
        less("t3", "t4").alias("n_symbols"),
        less("t4", "t5").alias("c_upper"),
        less("t5", "t6").alias("c_letter"),
        less("t6", "t7").alias("c_digit"),
        F.length("t7").cast("long").alias("c_other"),
    ).withColumn("c_symbol", F.col("n_symbols") + F.col("c_other"))


def counted(docs: DataFrame) -> DataFrame:
    """Adds n_words and the base counts to the columns of ``_stripped``."""
    d = _stripped(docs).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_CLASS)))
    return (
        d.withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.length("text").cast("long") - F.col("c_space"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .withColumn("n_repeat_words", _repeated(F.col("words")))
    )


def _repeated(words: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more in the array.

    Windows are hashed and sorted with their positions; equal neighbours repeat.
    The positions of those, in order, each cover three words less the overlap with
    the next.
    """
    hashed = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - 2),
            lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            # get() answers null beyond the ends.
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            hits = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
            return F.array_sort(F.transform(hits, lambda x: x["i"]))

        at = _let(pairs, positions)
        return _let(at, lambda p: F.aggregate(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.when(b.isNull(), 3).otherwise(F.least(F.lit(3), b - a))), F.lit(0).cast("int"), lambda s, x: s + x))

    # Most texts repeat no window; they need no sort.
    return _let(hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def references(docs: DataFrame) -> DataFrame:
    """(lang, shares r_<class>, common words) of the languages with enough words."""
    plain = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    sums = _stripped(plain).groupBy("lang").agg(F.sum(F.size("words").cast("long")).alias("total"), *[F.sum(f"c_{c}").alias(f"c_{c}") for c in CLASSES])
    sums = written(sums, "quality-languages")
    chars_of = reduce(lambda a, b: a + b, [F.col(f"c_{c}") for c in CLASSES])
    large = sums.where(F.col("lang").isNotNull() & (F.col("total") >= LEAST_REFERENCE))
    large = large.select("lang", "total", *[(F.col(f"c_{c}") / chars_of).alias(f"r_{c}") for c in CLASSES])
    tokens = plain.where("lang is not null").select("lang", F.explode(words(F.col("text"))).alias("word"))
    counts = tokens.groupBy("lang", "word").agg(F.count("*").alias("n"))
    frequent = counts.join(large.select("lang", "total"), "lang").where(F.col("n") >= COMMON_SHARE * F.col("total"))
    # At most 1 / COMMON_SHARE words a language are left here.
    listed = frequent.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus"), "word", (F.col("n") / F.col("total")).alias("share")))).alias("listed"))
    common = listed.select("lang", F.slice("listed", 1, COMMON_WORDS).alias("common"))
    return written(large.join(common, "lang", "left").drop("total"), "quality-references")


def _distance(pairs: list[tuple[Column, Column]]) -> Column:
    """Jensen-Shannon distance of two histograms, given as pairs of shares."""

    def half(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    terms = [half(p, (p + q) / 2) + half(q, (p + q) / 2) for p, q in pairs]
    return F.sqrt(F.greatest(F.lit(0.0), reduce(lambda a, b: a + b, terms) / 2))


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, class_distance, word_distance, base_failed and kept.

    A distance is null where the document is too short for it or has no reference.
    """
    refs = references(docs)
    d = counted(docs).withColumn("padded", F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))).drop("text", "words", "lines")
    d = d.join(refs, "lang", "left")
    chars = reduce(lambda a, b: a + b, [F.col(f"c_{c}") for c in CLASSES])
    d = d.withColumn("chars", chars.cast("double"))
    classes = [(F.col(f"c_{c}") / F.col("chars"), F.col(f"r_{c}")) for c in CLASSES]
    d = d.withColumn("class_distance", F.when((F.col("chars") >= LEAST_CHARS) & F.col("r_space").isNotNull(), _distance(classes)))

    def found(i: int) -> Column:
        """How often the i-th common word occurs; words in ``padded`` have a blank on either side."""
        word = F.get("common", F.lit(i))["word"]
        key = F.concat(F.lit(" "), word, F.lit(" "))
        gone = F.octet_length("padded") - F.octet_length(F.replace("padded", key, F.lit("")))
        return F.coalesce(gone / F.octet_length(key), F.lit(0.0))

    d = d.withColumn("n", F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
    d = d.select("*", *[(found(i) / F.col("n")).alias(f"p_{i}") for i in range(COMMON_WORDS)], *[F.coalesce(F.get("common", F.lit(i))["share"], F.lit(0.0)).alias(f"q_{i}") for i in range(COMMON_WORDS)])
    total = lambda x: reduce(lambda a, b: a + b, [F.col(f"{x}_{i}") for i in range(COMMON_WORDS)])
    rest = lambda x: F.greatest(F.lit(0.0), F.lit(1.0) - total(x))
    d = d.withColumn("p_rest", rest("p")).withColumn("q_rest", rest("q"))
    pairs = [(F.col(f"p_{i}"), F.col(f"q_{i}")) for i in [*range(COMMON_WORDS), "rest"]]
    d = d.withColumn("word_distance", F.when((F.col("n_words") >= LEAST_WORDS) & (F.size("common") > 0), _distance(pairs)))
    failed = (F.col("n_words") < LEAST_N_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    d = d.withColumn("base_failed", failed)
    far = F.coalesce(F.col("class_distance") > MOST_CLASS_DISTANCE, F.lit(False)) | F.coalesce(F.col("word_distance") > MOST_WORD_DISTANCE, F.lit(False))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", (~F.col("base_failed") & ~far).alias("kept")
    )
