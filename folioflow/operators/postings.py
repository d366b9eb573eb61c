"""Inverted indexes: positions of terms in texts, and trigrams of short strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.sources.sinks import written


def line(text: Column) -> Column:
    """A text in lower case on one line, with single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def term_places(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, at): the blank-separated terms of every text with their places; texts without any have none."""
    rows = texts.select(key, line(F.col(text)).alias("_line")).where("_line <> ''")
    return rows.select(key, F.posexplode(F.split("_line", " ")).alias("at", "term"))


def positions(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Positional postings (term, row, doc_id, places), stored in the shared folder.

    ``row`` numbers the rows of ``docs`` (doc_id, text), so that rows that share a doc_id stay
    apart. ``terms`` (term) keeps the postings of these terms only. Places are sorted. A term
    has one posting a document, so the lists are as long as a document at most.
    """
    places = term_places(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()).withColumn("id", F.struct("row", "doc_id")), "id", "text")
    if terms is not None:
        places = places.join(terms.select("term").distinct(), "term", "left_semi")
    lists = places.groupBy("term", F.col("id.row").alias("row"), F.col("id.doc_id").alias("doc_id")).agg(F.array_sort(F.collect_list("at")).alias("places"))
    return written(lists, "positions")


def phrases(claims: DataFrame, docs: DataFrame) -> DataFrame:
    """(claim_id, row, doc_id, at): where documents hold the words of a claim (claim_id, text) in a row.

    A claim's rarest term gives the places where it may begin; every other term, shifted by its
    offset, must stand behind them. So frequent terms are met only in documents that hold the
    rarest one, claims of any length and number take this one plan, and the words of both sides
    begin and end at blanks. Claims without words are found nowhere.
    """
    named = claims.select("claim_id", line(F.col("text")).alias("text")).where("text <> ''").distinct()
    named = written(named.withColumn("claim", F.monotonically_increasing_id()), "claims")
    own = term_places(named, "claim", "text").withColumnRenamed("at", "offset")
    lists = positions(docs, own)
    frequency = lists.groupBy("term").agg(F.sum(F.size("places")).alias("times"))
    # A term that no document holds counts as the rarest of all, and ends its claim.
    rated = own.join(frequency, "term", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    least = rated.groupBy("claim").agg(F.min_by(F.struct("term", "offset"), F.struct("times", "offset")).alias("rarest"), F.count("*").alias("words"))
    least = least.select("claim", "words", "rarest.term", "rarest.offset")
    begins = F.filter(F.transform("places", lambda p: p - F.col("offset")), lambda b: b >= 0)
    found = least.join(lists, "term").select("claim", "words", "row", "doc_id", begins.alias("begins")).where(F.size("begins") > 0)
    wanted = found.join(own, "claim").join(lists.select("term", "row", "places"), ["term", "row"])
    fits = wanted.withColumn("fits", F.array_intersect("begins", F.transform("places", lambda p: p - F.col("offset")))).where(F.size("fits") > 0)
    every = fits.groupBy("claim", "row", "doc_id", "words").agg(F.collect_list("fits").alias("all"))
    at = F.aggregate(F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))), F.get("all", F.lit(0)), F.array_intersect)
    # As many lists as words: a term that stands in a claim twice gives two.
    whole = every.where(F.size("all") == F.col("words")).select("claim", "row", "doc_id", F.explode(at).alias("at"))
    return whole.join(named.select("claim", "claim_id"), "claim").select("claim_id", "row", "doc_id", "at")


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of a string; shorter strings have none."""
    at = F.when(F.length(text) >= 3, F.sequence(F.lit(1), F.length(text) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.substring(text, i, F.lit(3))))
