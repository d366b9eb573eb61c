"""URL filter: rules first, then a logistic regression on hashed character n-grams.

Rules name a host and a path prefix. A rule fits its host and all subdomains, if
the URL's path starts with the rule's; the longest fitting rule decides (of equally
long ones the first by code point). All other URLs are judged by a logistic
regression over the character n-grams of host and path, hashed into ``BUCKETS``
weights and trained from a small labelled URL table.

Everything runs as DataFrame expressions. N-grams are hashed with xxhash64, for
training and for judging alike; the trained weights enter the plan as one literal
array, so judging reads nothing but the URL column and shuffles nothing. URLs are
grouped by what the model sees only within a row, never across rows.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no
rule, and is judged on the empty strings; repeated rows repeat; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MOST_RULES = 1000
BUCKETS = 2048
GRAMS = (3, 4, 5)
ITERATIONS = 100
RATE = 2.0
PENALTY = 1e-4
MOST_LABELLED = 5000

#: The labelled table: common names of hosts (placeholders) that are to be blocked, and ones that are not.
BAD_HOSTS = (
    "spam-mail", "spam-links", "link-farm", "click-farm", "cheap-meds", "cheap-loans", "pills-store", "online-pills", "casino-online", "best-casino", "big-win",
    "win-prizes", "bets-online", "best-bets", "free-spins", "free-prizes", "poker-night-win", "ad-track", "track-ads", "pop-ads", "adult-cams", "payday-loans", "fake-watches",
)
GOOD_HOSTS = (
    "blog", "news", "wiki", "docs", "library", "museum", "weather", "recipes", "travel", "gardening", "history", "science", "music", "theater", "mountains", "harbour",
    "physics", "carpentry", "painting", "orchestra", "cathedral", "students", "teachers", "hospital", "engineering", "languages", "school", "university", "city", "village", "railway",
    "city-library", "town-hall", "open-source", "book-club", "home-garden", "public-school", "bus-times", "local-news", "opening-hours", "river-walks", "art-museum", "science-fair", "county-archive",
)
PLACES = (("http://www.", ".example.com", "/en/12"), ("https://", ".example.org", "/de/7/"), ("https://m.", ".example.net", "/fr/301.html"), ("http://blog.", ".example.com", "/es/45"))


#: One host in so many is held out where the model is measured.
FOLDS = 4


def labelled_urls(spark: SparkSession, fold: int | None = None, held_out: bool = False) -> DataFrame:
    """The labelled URL table: each host name in a few places; without one fold of the hosts, or that fold alone."""
    hosts = [(h, y) for y, names in ((1, BAD_HOSTS), (0, GOOD_HOSTS)) for i, h in enumerate(names) if fold is None or (i % FOLDS == fold) == held_out]
    return spark.createDataFrame([(f"{a}{h}{b}{c}", y) for h, y in hosts for a, b, c in PLACES], "url string, label int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    return lower, path


def rule_fit(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the character n-grams of host and path, marks for start, end and the border."""
    line = F.concat(F.lit("^"), host, F.lit("$"), F.regexp_replace(path, r"[0-9]+", "0"), F.lit("$"))

    def of(n: int) -> Column:
        last = F.length(line) - (n - 1)
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.pmod(F.xxhash64(F.substr(line, i, F.lit(n))), F.lit(buckets)).cast("int"))).otherwise(F.array().cast("array<int>"))

    return F.concat(*[of(n) for n in GRAMS])


def _score(features: Column, weights: Sequence[float], bias: float) -> Column:
    """The regression's log-odds: mean weight of the n-grams present, scaled by their number's root."""
    table = F.lit([float(w) for w in weights])
    total = F.aggregate(features, F.lit(0.0), lambda s, k: s + F.get(table, k))
    return total / F.sqrt(F.greatest(F.size(features), F.lit(1)).cast("double")) + F.lit(float(bias))


def train(labelled: DataFrame, buckets: int = BUCKETS, most: int = MOST_LABELLED) -> tuple[list[float], float]:
    """Weights and bias, by gradient descent over the (url, label) rows.

    The table is small: more than ``most`` rows are refused. N-gram counts come from
    the same expression that judges URLs.
    """
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("url is not null and label is not null").select(F.array_sort(grams(host, path, buckets)).alias("g"), F.col("label").cast("int").alias("y")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} labelled URLs")
    weights, bias = [0.0] * buckets, 0.0
    if not rows:
        return weights, bias
    import numpy as np

    x = np.zeros((len(rows), buckets))
    for i, row in enumerate(sorted(rows, key=lambda r: (r.g, r.y))):
        np.add.at(x[i], row.g, 1.0)
    y = np.array([row.y for row in sorted(rows, key=lambda r: (r.g, r.y))], dtype=float)
    x /= np.sqrt(np.maximum(1, x.sum(axis=1, keepdims=True)))
    w = np.zeros(buckets)
    for _ in range(ITERATIONS * 10):
        error = 1 / (1 + np.exp(-(x @ w + bias))) - y
        w -= RATE * (x.T @ error / len(y) + PENALTY * w)
        bias -= RATE * error.mean()
    return w.tolist(), float(bias)


def judged(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row; score is the model's probability of block."""
    spark = pages.sparkSession
    weights, bias = train(labelled_urls(spark) if labelled is None else labelled)
    host, path = host_and_path(F.col("url").cast("string"))
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_fit(F.col("host"), F.col("path"), rules)
    d = d.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("grams", grams(F.col("host"), F.col("path")))
    d = d.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-_score(F.col("grams"), weights, bias))))
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return d.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
