"""Extraction routing: confidence of each strategy, costs, budget and escalation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.config import ExtractionRules

LADDER = ("fast_text", "layout_aware", "vision")


def initial_strategy(origin: Column, layout: Column) -> Column:
    """A native document with many figures starts with fast text, whatever its cost class says."""
    model = layout.isin("multi_column", "table_heavy", "mixed") | origin.isin("mixed", "form_fillable")
    return F.when(origin == "scanned_image", "vision").when(model, "layout_aware").otherwise("fast_text")


def start_strategy(initial: Column, path: Column, doc_id: Column, rules: ExtractionRules = ExtractionRules()) -> Column:
    """Handwriting, by path or listed id, starts with vision."""
    written = F.lower(F.coalesce(path, F.lit(""))).rlike("handwriting|handwritten") | doc_id.cast("string").isin(*rules.handwriting_ids)
    return F.when(written, "vision").otherwise(initial)


def next_strategy(strategy: Column) -> Column:
    return F.when(strategy == "fast_text", "layout_aware").when(strategy == "layout_aware", "vision")


def fast_confidence(chars: Column, density: Column, image: Column, font: Column, rules: ExtractionRules = ExtractionRules()) -> Column:
    a, b, c, d = rules.weights
    clear = F.when(image <= rules.most_image, 1.0).otherwise(1 - (image - rules.most_image))
    score = a * F.least(F.lit(1.0), chars / rules.least_chars) + b * F.least(F.lit(1.0), density / rules.least_density) + c * clear + d * font.cast("double")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def layout_confidence(blocks: Column, tables: Column, figures: Column) -> Column:
    found = F.least(F.lit(1.0), blocks / 80 + 0.15 * tables + 0.10 * figures)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.45 + found))


def vision_confidence(blocks: Column, pages: Column) -> Column:
    wanted = F.greatest(F.lit(1.0), 12 * F.sqrt(pages.cast("double")))
    return F.when(blocks <= 0, 0.0).otherwise(0.55 + 0.45 * F.least(F.lit(1.0), blocks / wanted))


def costs(pages: Column, rules: ExtractionRules = ExtractionRules()) -> dict[str, Column]:
    tokens = rules.vision_tokens[0] + rules.vision_tokens[1] * pages
    return {
        "fast_text": rules.fast_cost[0] + rules.fast_cost[1] * pages,
        "layout_aware": rules.layout_cost[0] + rules.layout_cost[1] * pages,
        "vision": F.round(tokens / 1000.0 * rules.vision_per_1k, 8),
    }


def attempts(docs: DataFrame, rules: ExtractionRules = ExtractionRules()) -> DataFrame:
    """The attempts of the escalation ladder, one row each.

    ``docs`` has doc_id, start, pages, and confidence and document columns
    c_<strategy> and has_<strategy>. Attempts go up from the start strategy until one
    is accepted. Before vision the spent budget and a one-page estimate must not
    exceed the cap; otherwise a row without an attempt says so. The running cost is a
    window sum per document.
    """
    price, one_page = costs(F.col("pages"), rules), costs(F.lit(1), rules)["vision"]
    rungs = F.array(
        *[
            F.struct(
                F.lit(i).alias("rung"), F.lit(s).alias("strategy"), F.col(f"c_{s}").alias("confidence"), F.col(f"has_{s}").alias("has_document"), price[s].alias("cost"), F.lit(rules.accept[s]).alias("threshold")
            )
            for i, s in enumerate(LADDER)
        ]
    )
    start = F.array_position(F.array(*map(F.lit, LADDER)), F.col("start")) - 1
    rows = docs.select("doc_id", start.alias("first"), F.explode(rungs).alias("r")).select("doc_id", "first", "r.*").where("rung >= first")
    rows = rows.withColumn("accepted", F.col("has_document") & (F.col("confidence") >= F.col("threshold")))
    order = Window.partitionBy("doc_id").orderBy("rung")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("done", F.coalesce(F.bool_or("accepted").over(before), F.lit(False))).where("not done")
    rows = rows.withColumn("spent", F.coalesce(F.sum(F.greatest("cost", F.lit(0.0))).over(before), F.lit(0.0)))
    over = (F.col("strategy") == "vision") & (F.col("spent") + one_page > rules.budget)
    last = F.col("rung") == len(LADDER) - 1
    error = F.when(over, "budget_cap_exceeded").when(last & ~F.col("accepted"), "all_strategies_below_threshold")
    return rows.select(
        "doc_id", F.row_number().over(order).alias("attempt"), "strategy", "confidence", "cost", (F.col("spent") + F.when(over, 0.0).otherwise(F.col("cost"))).alias("budget_spent"), (F.col("accepted") & ~over).alias("accepted"), (F.row_number().over(order) > 1).alias("escalated"), error.alias("error")
    )


def outcome(tried: DataFrame) -> DataFrame:
    """One row per document: accepted strategy or error, attempts and spent budget."""
    return tried.groupBy("doc_id").agg(
        F.max(F.when(F.col("accepted"), F.col("strategy"))).alias("strategy"), F.max("error").alias("error"), F.max("attempt").alias("attempts"), F.max("budget_spent").alias("budget_spent")
    )


def cell_matrix(cells: DataFrame) -> DataFrame:
    """Sparse cells (table_id, row, col, text) as dense rows; a row is as wide as its last cell.

    Row 0 is the header. Gaps are empty strings; of cells at one place the largest text stays.
    """
    rows = cells.groupBy("table_id", "row", "col").agg(F.max("text").alias("text")).groupBy("table_id", "row").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("col", "text")))).alias("m"), F.max("col").alias("width"))
    dense = F.transform(F.sequence(F.lit(0), F.col("width")), lambda c: F.coalesce(F.element_at("m", c), F.lit("")))
    return rows.select("table_id", "row", (F.col("row") == 0).alias("is_header"), dense.alias("cells"))


def provider_error(message: Column) -> Column:
    """Class of a provider's error message."""
    m = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(m.contains("not installed"), "layout_provider_not_available")
        .when(m.contains("timeout") | m.contains("timed out"), "layout_provider_timeout")
        .when(m.contains("conversion_failed"), "layout_provider_conversion_failed")
        .otherwise("layout_provider_error")
    )


def box(raw: Column, fallback: tuple[float, float, float, float]) -> Column:
    """A bounding box from x0/y0/x1/y1 or l/t/r/b of a map; missing and zero sides take the fallback."""
    sides = [F.coalesce(F.nullif(F.coalesce(raw[a], raw[b]), F.lit(0.0)), F.lit(float(f))).alias(a) for a, b, f in zip(("x0", "y0", "x1", "y1"), "ltrb", fallback)]
    return F.struct(*sides)


def page_count(payload_count: Column, metadata_count: Column, n_pages: Column) -> Column:
    """The number of pages as the payload has it, else its metadata, else its pages, else one."""
    some = lambda c: F.when(c.try_cast("int") > 0, c.try_cast("int"))
    return F.coalesce(some(payload_count), some(metadata_count), some(n_pages), F.lit(1))


def table_serial(headers: Column, rows: Column) -> Column:
    """A table as the text that its hash is made of."""
    return F.concat(F.array_join(headers, "|"), F.lit("\n"), F.array_join(F.transform(rows, lambda r: F.array_join(r, "|")), "\n"))


def tables_with_content(tables: DataFrame) -> DataFrame:
    """Tables (headers, rows) that have any, with their hash."""
    full = tables.where((F.coalesce(F.size("headers"), F.lit(0)) > 0) | (F.coalesce(F.size("rows"), F.lit(0)) > 0))
    none = lambda c, t: F.coalesce(F.col(c), F.array().cast(t))
    return full.withColumn("content_hash", F.sha2(table_serial(none("headers", "array<string>"), none("rows", "array<array<string>>")), 256))


def needs_ocr_retry(n_blocks: Column, n_tables: Column, n_figures: Column, provider: Column, did_ocr: Column) -> Column:
    """Whether an empty payload is worth a second try with text recognition."""
    none = lambda c: F.coalesce(c, F.lit(0)) == 0
    return none(n_blocks) & none(n_tables) & none(n_figures) & (provider == "docling") & ~F.coalesce(did_ocr, F.lit(False))
