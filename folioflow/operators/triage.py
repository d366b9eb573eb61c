"""Triage: page statistics, rolled up to documents, and the profile they imply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.config import TriageRules
from folioflow.functions.text import letters

#: Words that tell languages apart, for the default language vote. Fixed values.
STOPWORDS = {
    "de": ("der", "die", "das", "und", "ein", "nicht", "mit", "sich", "den", "von"),
    "en": ("the", "and", "of", "to", "in", "is", "that", "for", "with", "are"),
    "es": ("el", "los", "las", "del", "que", "con", "por", "para", "una", "al"),
    "fr": ("le", "les", "des", "et", "que", "dans", "pour", "est", "du", "qui"),
}


def cluster_count(points: Column, threshold: Column | float) -> Column:
    """Clusters of sorted points: a new one starts where a point is farther than
    ``threshold`` from the first point of the current one."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        new = acc["anchor"].isNull() | (x - acc["anchor"] > limit)
        return F.struct(F.when(new, x).otherwise(acc["anchor"]).alias("anchor"), (acc["n"] + F.when(new, 1).otherwise(0)).alias("n"))

    # Points that occur again begin no cluster.
    return F.aggregate(F.sort_array(F.array_distinct(F.array_compact(points))), start, step)["n"]


def boundary_repeat(bins: Column) -> Column:
    """Share of the different bins that occur more than twice: the sorted bins that are the third of their kind."""
    third = lambda s: F.size(F.filter(s, lambda x, i: (i >= 2) & (F.get(s, i - 2) == x) & ((i == 2) | (F.get(s, i - 3) != x))))
    often = F.element_at(F.transform(F.array(F.sort_array(bins)), third), 1)
    return often / F.greatest(F.size(F.array_distinct(bins)), F.lit(1))


def page_stats(words: DataFrame, marks: DataFrame | None = None, width: float = 612.0, height: float = 792.0) -> DataFrame:
    """Per page: characters, density, x clusters, column balance and repeated word boundaries.

    ``words`` has doc_id, page_number, x0, x1, top; one group per page gives everything.
    ``marks`` has what text does not have (see ``page_signals``); pages without get zeros.
    """
    return placed_stats(words.groupBy("doc_id", "page_number").agg(F.collect_list(F.struct("x0", "x1")).alias("xs")), marks, width, height)


def placed_stats(pages: DataFrame, marks: DataFrame | None = None, width: float = 612.0, height: float = 792.0) -> DataFrame:
    """``page_stats`` of pages that have their words already: doc_id, page_number, xs (array of x0 and x1).

    Everything is taken within the row, so nothing is shuffled.
    """
    centres = F.transform("xs", lambda w: (w["x0"] + w["x1"]) / 2)
    bins = F.concat(F.transform("xs", lambda w: F.floor(w["x0"] / 10)), F.transform("xs", lambda w: F.floor(w["x1"] / 10)))
    chars = F.aggregate("xs", F.lit(0.0), lambda s, w: s + (w["x1"] - w["x0"]) / 5)
    pages = pages.withColumns({"centres": centres, "bins": bins}).select(
        "doc_id",
        "page_number",
        "centres",
        "bins",
        F.size("xs").cast("long").alias("n_words"),
        chars.cast("long").alias("chars"),
        F.size(F.filter("centres", lambda c: c < 0.4 * width)).cast("long").alias("left"),
        F.size(F.filter("centres", lambda c: c > 0.6 * width)).cast("long").alias("right"),
    )
    n = F.col("n_words")
    gutter = (n - F.col("left") - F.col("right")) / n
    balanced = (F.col("left") / n >= 0.25) & (F.col("right") / n >= 0.25)
    signals = ("image_ratio", "edge_density", "table_score")
    if marks is not None:
        pages = pages.join(page_signals(marks, pages.select("doc_id", "page_number", "n_words")), ["doc_id", "page_number"], "left")
    return pages.select(
        "doc_id",
        "page_number",
        "n_words",
        "chars",
        (F.col("chars") / F.lit(width * height)).alias("density"),
        cluster_count(F.col("centres"), 0.12 * width).alias("x_clusters"),
        F.when(balanced, F.greatest(F.lit(0.0), 1 - 2 * gutter)).otherwise(0.0).alias("column_balance"),
        boundary_repeat(F.col("bins")).alias("boundary_repeat"),
        *[(F.coalesce(F.col(c), F.lit(0.0)) if marks is not None else F.lit(0.0)).alias(c) for c in signals],
    )


def page_signals(marks: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_id, page_number, image_ratio, edge_density, table_score) of pages.

    ``marks`` has doc_id, page_number, width, height, images and edges (arrays of boxes)
    and n_tables; ``words`` has doc_id, page_number, n_words.
    """
    known = marks.join(words, ["doc_id", "page_number"], "left")
    return known.select(
        "doc_id",
        "page_number",
        image_ratio(F.col("images"), F.col("width"), F.col("height")).alias("image_ratio"),
        edge_density(F.col("edges"), F.coalesce("n_words", F.lit(0))).alias("edge_density"),
        table_score(F.col("n_tables")).alias("table_score"),
    )


def table_score(n_tables: Column) -> Column:
    """Half a point per ruled table, at most 1."""
    return F.least(F.lit(1.0), n_tables / 2.0)


def image_ratio(images: Column, page_width: Column, page_height: Column) -> Column:
    """Share of a page under images, at most 1; sides of the page are at least 1."""
    area = F.greatest(page_width, F.lit(1.0)) * F.greatest(page_height, F.lit(1.0))
    covered = F.aggregate(images, F.lit(0.0), lambda s, i: s + F.abs(i["x1"] - i["x0"]) * F.abs(i["bottom"] - i["top"]))
    return F.least(F.lit(1.0), covered / area)


def edge_density(edges: Column, n_words: Column) -> Column:
    """Crossing rules per five words, at most 1."""
    dx, dy = (lambda e: F.abs(e["x1"] - e["x0"])), (lambda e: F.abs(e["bottom"] - e["top"]))
    upright = F.size(F.filter(edges, lambda e: (dx(e) <= 1.5) & (dy(e) > 5)))
    level = F.size(F.filter(edges, lambda e: (dy(e) <= 1.5) & (dx(e) > 5)))
    per = F.greatest(F.lit(1), F.floor(n_words / 5))
    return F.least(F.lit(1.0), F.least(upright, level) / per)


def grid_score(boundary: Column, edges: Column, tables: Column) -> Column:
    return 0.45 * boundary + 0.30 * edges + 0.25 * tables


def document_stats(pages: DataFrame) -> DataFrame:
    """Pages rolled up to documents: means of ratios, most clusters, sums of characters."""
    return pages.groupBy("doc_id").agg(
        F.count("*").alias("pages"),
        F.sum("chars").alias("chars"),
        F.avg("density").alias("density"),
        F.avg("image_ratio").alias("image"),
        F.max("x_clusters").alias("x_clusters"),
        F.max("column_balance").alias("balance"),
        F.avg(grid_score(F.col("boundary_repeat"), F.col("edge_density"), F.col("table_score"))).alias("grid"),
    )


def origin(rules: TriageRules = TriageRules()) -> Column:
    """Origin class from density, image, font, form, chars and pages columns."""
    d, i = F.col("density"), F.col("image")
    native = (d >= rules.native_density) & (i <= rules.native_image) & F.col("font")
    scanned = (F.col("chars") / F.greatest(F.col("pages"), F.lit(1)) <= rules.scanned_chars) & (i >= rules.scanned_image)
    return (
        F.when(F.col("form"), "form_fillable")
        .when(native & ~scanned, "native_digital")
        .when(scanned & ~native, "scanned_image")
        .when(native & scanned, "mixed")
        .when((i > 0.30) & (d > 0.0005), "mixed")
        .when(d <= 0.0003, "scanned_image")
        .otherwise("native_digital")
    )


def layout(rules: TriageRules = TriageRules()) -> Column:
    columns = (F.col("x_clusters") >= rules.columns) | (F.col("balance") >= rules.column_balance)
    table, figure = F.col("grid") >= rules.grid, F.col("image") >= rules.figure
    flags = columns.cast("int") + table.cast("int") + figure.cast("int")
    return F.when(flags > 1, "mixed").when(table, "table_heavy").when(figure, "figure_heavy").when(columns, "multi_column").otherwise("single_column")


def cost_class(origin: Column, layout: Column) -> Column:
    vision = (origin == "scanned_image") | (layout == "figure_heavy")
    model = origin.isin("mixed", "form_fillable") | layout.isin("multi_column", "table_heavy", "mixed")
    return F.when(vision, "needs_vision_model").when(model, "needs_layout_model").otherwise("fast_text_sufficient")


def needs_advanced(cost: Column) -> Column:
    return cost.isin("needs_layout_model", "needs_vision_model")


def _counted(rows: DataFrame, tokens: Column, kinds: dict[str, tuple[str, ...]]) -> DataFrame:
    """(doc_id, a column per kind): how many of a row's tokens are of each kind.

    All tokens are looked up once, in the words of all kinds; only those found are compared with each kind's.
    """
    among = lambda found, words: F.filter(found, lambda t: t.isin(*words))
    known = rows.select("doc_id", among(tokens, sorted({w for words in kinds.values() for w in words})).alias("tokens"))
    return known.select("doc_id", *[F.size(among(F.col("tokens"), words)).alias(kind) for kind, words in kinds.items()])


def domains(texts: DataFrame, rules: TriageRules = TriageRules()) -> DataFrame:
    """(doc_id, domain): the domain with the most keyword tokens, the first listed in ties, else general.

    Keywords are counted within a row, so nothing is shuffled but the counts.
    """
    per_row = _counted(texts, letters(F.col("text")), rules.domains)
    sums = per_row.groupBy("doc_id").agg(*[F.sum(n).alias(n) for n in rules.domains])
    best = F.greatest(*[F.col(n) for n in rules.domains])
    chosen = F.lit("general")
    for name in reversed(list(rules.domains)):
        chosen = F.when((F.col(name) == best) & (best > 0), name).otherwise(chosen)
    return sums.select("doc_id", chosen.alias("domain"), best.alias("hits"))


def language(texts: DataFrame, rules: TriageRules = TriageRules()) -> DataFrame:
    """(doc_id, code, confidence): a vote of common words; undetermined without any."""
    tokens = F.split(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+", " "), " ")
    rows = _counted(texts, tokens, {f"v_{c}": ws for c, ws in sorted(STOPWORDS.items())})
    total = sum((F.col(f"v_{c}") for c in sorted(STOPWORDS)), F.lit(0))
    best = F.greatest(*[F.col(f"v_{c}") for c in sorted(STOPWORDS)])
    code = F.lit(rules.fallback_language)
    for c in sorted(STOPWORDS, reverse=True):
        code = F.when((F.col(f"v_{c}") == best) & (best > 0), c).otherwise(code)
    return rows.select("doc_id", code.alias("code"), F.when(best > 0, best / total).otherwise(rules.fallback_confidence).alias("confidence"))


def profile(stats: DataFrame, rules: TriageRules = TriageRules()) -> DataFrame:
    """Document statistics with origin, layout, cost and the need for advanced processing."""
    d = stats.withColumn("origin", origin(rules)).withColumn("layout", layout(rules))
    return d.withColumn("cost", cost_class(F.col("origin"), F.col("layout"))).withColumn("advanced", needs_advanced(F.col("cost")))
