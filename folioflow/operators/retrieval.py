"""Retrieval: section navigation, fact lookup and vector search, for many requests at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.config import QueryRules
from folioflow.functions.text import terms
from folioflow.operators import metric
from folioflow.operators.facts import facts as facts_of
from folioflow.operators.postings import trigrams
from folioflow.sources.sinks import dealt

#: Words that say nothing about what is asked.
STOPWORDS = ("a", "about", "an", "and", "are", "does", "for", "from", "how", "in", "is", "of", "show", "tell", "that", "the", "this", "to", "was", "what", "which", "with")
#: Words that ask for a fact.
FACTUAL = r"(?i)\b(revenue|amount|total|balance|ratio|margin|date|period|invoice|expense|expenditure|profit|tax|fiscal)\b"

def preferred_path(query: Column) -> Column:
    """Fact lookup for questions with a fact word or a digit, else section navigation."""
    return F.when(query.rlike(FACTUAL) | query.rlike("[0-9]"), "structured_query").otherwise("pageindex_navigate")


def clamp(limit: int, rules: QueryRules = QueryRules()) -> int:
    return max(1, min(rules.most, limit))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def section_scores(requests: DataFrame, sections: DataFrame, weights: tuple[int, int, int, int]) -> DataFrame:
    """Requests (request_id, doc_id, topic) against the sections of their document.

    ``sections`` has doc_id, section_id, title, page_start, page_end, entities (array),
    summary and data_types (array). Weights are those of title, entities, summary and
    data types.
    """
    s = sections.select(
        "doc_id", "section_id", "title", "page_start", "page_end", terms(F.col("title")).alias("a"), terms(F.array_join("entities", " ")).alias("b"), terms(F.col("summary")).alias("c"), "data_types"
    )
    pairs = requests.withColumn("terms", terms(F.col("topic"))).join(s, "doc_id")
    parts = [weights[i] * overlap(F.col("terms"), F.col(c)) for i, c in enumerate(("a", "b", "c", "data_types"))]
    matched = F.array_intersect("terms", F.array_union(F.array_union("a", "b"), F.array_union("c", F.col("data_types") if weights[3] else F.array().cast("array<string>"))))
    return pairs.withColumn("score", (parts[0] + parts[1] + parts[2] + parts[3]).cast("double")).withColumn("matched", F.array_sort(matched))


def _best(rows: DataFrame, limit: int) -> DataFrame:
    order = Window.partitionBy("request_id").orderBy(F.desc("score"), "page_start", "title", "section_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def navigate(requests: DataFrame, sections: DataFrame, limit: int = 5) -> DataFrame:
    """The best sections per request; sections without a common term drop out."""
    scored = section_scores(requests, sections, (4, 2, 1, 1))
    return _best(scored.where((F.col("score") > 0) | (F.size("terms") == 0)), clamp(limit))


def rank_sections(requests: DataFrame, sections: DataFrame, limit: int = 5) -> DataFrame:
    """The best sections per request, whether or not they match."""
    return _best(section_scores(requests, sections, (3, 2, 1, 0)), limit)


def query_terms(query: Column, filters: Column | None = None, most: int = 4) -> Column:
    """Terms of a question: explicit filters, else its first telling words, else all of it."""
    lowered = F.lower(query)
    tokens = F.split(F.regexp_replace(lowered, "[?,]", " "), r"\s+")
    telling = F.slice(F.filter(tokens, lambda t: (F.length(t) > 2) & ~t.isin(*STOPWORDS)), 1, most)
    given = F.filter(F.transform(filters, lambda t: F.lower(F.trim(t))), lambda t: F.length(t) > 0) if filters is not None else F.array().cast("array<string>")
    found = F.when(F.size(given) > 0, given).otherwise(telling)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.trim(lowered)))


def with_terms(rows: DataFrame, rules: QueryRules = QueryRules()) -> DataFrame:
    """Candidates (query and a fact's columns) that have a term of their question; a tool gives no other a score."""
    text = lambda c: F.coalesce(F.lower(c), F.lit(""))
    has = lambda t: text("normalized_name").contains(t) | text("fact_name").contains(t) | text("fact_value").contains(t)
    return rows.where(F.exists(F.slice(query_terms(F.col("query"), None, rules.terms), 1, rules.terms), has))


def fact_postings(facts: DataFrame, requests: DataFrame | None = None, rules: QueryRules = QueryRules()) -> DataFrame:
    """(doc_id, gram, fact_id): the trigrams of each fact's names and value, in lower case, each once a fact.

    ``requests`` (doc_id, query) keeps the postings that these ask for: those of the trigrams of a
    document's own terms. They are told apart where facts are cut, so that no others are stored.
    """
    texts = F.array_distinct(F.flatten(F.transform(F.array("normalized_name", F.lower("fact_name"), F.lower("fact_value")), trigrams)))
    if requests is None:
        return facts.select("doc_id", "fact_id", F.explode(texts).alias("gram"))
    terms = F.explode(query_terms(F.col("query"), None, rules.terms))
    asked = requests.select("doc_id", terms.alias("term")).select("doc_id", F.explode(trigrams(F.col("term"))).alias("gram"))
    asked = asked.groupBy("doc_id").agg(F.collect_set("gram").alias("asked"))
    return facts.join(asked, "doc_id").select("doc_id", "fact_id", F.explode(F.array_intersect(texts, "asked")).alias("gram"))


def fact_candidates(requests: DataFrame, postings: DataFrame, facts: DataFrame, rules: QueryRules = QueryRules()) -> DataFrame:
    """(request_id, doc_id, fact_id): facts that hold all trigrams of a term of the request; a superset of its hits.

    Only postings of the terms' trigrams are met. A term of fewer than three characters has none
    and takes the facts of its document that contain it.
    """
    asked = requests.select("request_id", "doc_id", F.explode(query_terms(F.col("query"), None, rules.terms)).alias("term")).distinct()
    grams = asked.where(F.length("term") >= 3).withColumn("grams", trigrams(F.col("term"))).withColumn("wanted", F.size("grams"))
    met = grams.select("request_id", "doc_id", "term", "wanted", F.explode("grams").alias("gram")).join(postings, ["doc_id", "gram"])
    whole = met.groupBy("request_id", "doc_id", "term", "wanted", "fact_id").agg(F.count("*").alias("n")).where("n = wanted").select("request_id", "doc_id", "fact_id")
    short = asked.where(F.length("term") < 3).join(facts.select("doc_id", "fact_id", F.concat_ws("\n", "normalized_name", F.lower("fact_name"), F.lower("fact_value")).alias("text")), "doc_id")
    return whole.unionByName(short.where(F.col("text").contains(F.col("term"))).select("request_id", "doc_id", "fact_id")).distinct()


def fact_lookup(requests: DataFrame, facts: DataFrame, limit: int = 5, rules: QueryRules = QueryRules(), postings: DataFrame | None = None) -> DataFrame:
    """Facts per request (request_id, doc_id, query), best first. Percent signs in terms are literal.

    With ``postings`` only facts that hold a term's trigrams are scored, else all of the document.
    """
    asked = requests.withColumn("terms", query_terms(F.col("query"), None, rules.terms))
    if postings is None:
        pairs = asked.join(facts, "doc_id")
    else:
        pairs = asked.join(fact_candidates(requests, postings, facts, rules), ["request_id", "doc_id"]).join(facts, ["doc_id", "fact_id"])
    return _ranked(pairs, limit, rules)


def chunk_lookup(requests: DataFrame, chunks: DataFrame, limit: int = 5, rules: QueryRules = QueryRules(), tasks: int = 0) -> DataFrame:
    """``fact_lookup`` over the facts of chunks, which are taken where a document's chunks meet its requests.

    Chunks are shuffled, a fraction of their facts; of these only hits go on. A chunk is read once
    for all requests of its document. ``tasks`` as in ``sinks.dealt``.
    """
    asked = requests.withColumn("terms", query_terms(F.col("query"), None, rules.terms))
    own = F.struct(*[c for c in asked.columns if c != "doc_id"])
    per_document = dealt(asked, tasks, "doc_id").groupBy("doc_id").agg(F.collect_list(own).alias("asked"))
    found = facts_of(dealt(chunks, tasks, "doc_id").join(per_document, "doc_id"), more=("asked",))
    pairs = found.select("*", F.explode("asked").alias("request")).select("*", "request.*").drop("asked", "request")
    return _ranked(pairs, limit, rules)


def _ranked(pairs: DataFrame, limit: int, rules: QueryRules) -> DataFrame:
    """The best facts of each request, of pairs of requests with their terms and facts."""
    value, name, normal = F.lower("fact_value"), F.lower("fact_name"), F.col("normalized_name")

    def points(t: Column) -> Column:
        yes = lambda c, n: F.when(c, n).otherwise(0)
        return yes(normal == t, 4) + yes(normal.contains(t), 2) + yes(name.contains(t), 1) + yes(value.contains(t), 1)

    score = F.aggregate(F.slice("terms", 1, rules.terms), F.lit(0), lambda s, t: s + points(t))
    hit = F.exists("terms", lambda t: normal.contains(t) | name.contains(t) | value.contains(t))
    order = Window.partitionBy("request_id").orderBy(F.desc("score"), "page_number", "fact_id")
    found = pairs.where(hit).withColumn("score", score)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= clamp(limit, rules))


def cosine_distance(a: Column, b: Column) -> Column:
    """One less the cosine; null where a vector is null or has no direction, or a component is null."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return 1 - F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(queries: DataFrame, vectors: DataFrame, limit: int, section_ids: DataFrame | None = None) -> DataFrame:
    """The nearest vectors (vec_id, embedding, ...) of every query (request_id, query_vec), through the metric index.

    ``section_ids`` narrows the vectors before the search. Vectors and queries without a
    direction are never found and find nothing.
    """
    v = vectors if section_ids is None else vectors.join(section_ids, "section_id", "left_semi")
    hits, _ = metric.nearest(queries, v, limit)
    return hits.withColumn("score", 1 / (1 + F.col("distance")))


def best_of(rows: DataFrame, key: list[str], score: str, order: str) -> DataFrame:
    """One row per key: that with the largest score, the earlier one in ties."""
    w = Window.partitionBy(*key).orderBy(F.desc(score), order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
