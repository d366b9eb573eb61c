"""Payloads of layout providers as VARIANT: blocks, tables and figures whatever keys a provider uses.

A payload is a JSON text without a fixed schema. It is parsed once to a variant; every field is
then a path into it, so payloads of different providers stand in one column. Rules that hold
for all parts: of several keys for one thing the first that says something counts; zero and
empty values say nothing; what cannot be read as its type counts as missing; items that are
not objects are skipped but counted in the numbering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import content_hash, nothing_if_empty
from folioflow.operators.extraction import page_count, table_serial

#: Keys of the three kinds of items, most telling first.
BLOCK_KEYS, TABLE_KEYS, FIGURE_KEYS = ("text_blocks", "blocks", "texts"), ("tables",), ("figures", "pictures")
#: Confidences and boxes of items that have none.
BLOCK_CONFIDENCE, TABLE_CONFIDENCE, FIGURE_CONFIDENCE = 0.9, 0.85, 0.8
WHOLE_BOX = {"x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0}
#: The other spelling of the sides.
SHORT = {"x0": "l", "y0": "t", "x1": "r", "y1": "b"}
CELL_ROW, CELL_COLUMN = "start_row_offset_idx", "start_col_offset_idx"


def at(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


def parsed(payloads: DataFrame, key: str = "doc_id", column: str = "payload") -> DataFrame:
    """(key, v, error): the payload as a variant, or why there is none."""
    v = F.try_parse_json(column)
    missing = F.when(F.col(column).isNull(), "layout_provider_error").when(at(v, "$", "map<string,variant>").isNull(), "layout_provider_conversion_failed")
    return payloads.select(key, F.when(missing.isNull(), v).alias("v"), missing.alias("error"))


def pages_of(v: Column) -> Column:
    """The number of pages: the payload's own, its metadata's, that of its pages, else one."""
    return page_count(at(v, "$.page_count", "string"), at(v, "$.metadata.page_count", "string"), F.size(F.map_keys(at(v, "$.pages", "map<string,variant>"))))


def _items(rows: DataFrame, key: str, keys: tuple[str, ...]) -> DataFrame:
    """(key, idx, b): the objects of the first list that has any item."""
    lists = [at(F.col("v"), f"$.{k}", "array<variant>") for k in keys]
    first = F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])
    return rows.select(key, F.posexplode(first).alias("idx", "b")).where(at(F.col("b"), "$", "map<string,variant>").isNotNull())


def _some(x: Column, zero: object) -> Column:
    return F.nullif(x, F.lit(zero))


def _placed(items: DataFrame, prefix: str, confidence: float) -> DataFrame:
    """Adds item_id, page_number, box and confidence, which all kinds of items have."""
    b = F.col("b")
    page = F.coalesce(at(b, "$.page_number", "int"), at(b, "$.prov[0].page_no", "int"))
    own = F.size(F.map_keys(at(b, "$.bounding_box", "map<string,variant>"))) > 0

    def side(root: str, x: str) -> Column:
        return _some(F.coalesce(at(b, f"{root}.{x}", "double"), at(b, f"{root}.{SHORT[x]}", "double")), 0.0)

    box = F.struct(*[F.coalesce(F.when(own, side("$.bounding_box", x)).otherwise(side("$.prov[0].bbox", x)), F.lit(v)).alias(x) for x, v in WHOLE_BOX.items()])
    placed = items.withColumn("page_number", F.greatest(F.lit(1), F.coalesce(_some(page, 0), F.lit(1))))
    named = F.coalesce(nothing_if_empty(at(b, "$.id", "string")), F.concat_ws("-", F.lit(prefix), "page_number", "idx"))
    return placed.withColumn("item_id", named).withColumn("box", box).withColumn("confidence", F.coalesce(_some(at(b, "$.confidence", "double"), 0.0), F.lit(confidence)))


def _hash(text: Column) -> Column:
    return F.coalesce(nothing_if_empty(at(F.col("b"), "$.content_hash", "string")), content_hash(text))


def text_blocks(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Text blocks of parsed payloads; blank ones are skipped."""
    b = F.col("b")
    text = F.regexp_replace(F.coalesce(at(b, "$.text", "string"), at(b, "$.orig", "string"), F.lit("")), r"^\s+|\s+$", "")
    found = _placed(_items(rows, key, BLOCK_KEYS), "ltb", BLOCK_CONFIDENCE).withColumn("text", text).where("text <> ''")
    order = F.greatest(F.lit(0), F.coalesce(_some(at(b, "$.reading_order", "int"), 0), F.col("idx")))
    return found.select(
        key, "idx", "item_id", "page_number", "box", order.alias("reading_order"), F.coalesce(nothing_if_empty(at(b, "$.block_type", "string")), F.lit("paragraph")).alias("block_type"), "text", _hash(F.col("text")).alias("content_hash"), "confidence"
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _dense(cells: Column) -> Column:
    """Rows of sparse cells: each as wide as its last cell, gaps empty, the later of two cells at a place.

    Cells are read and sorted once; rows are then stretches of them, so a table takes time in
    proportion to its cells. ``_let`` keeps them from being read anew for every row.
    """
    place = lambda c, k: F.coalesce(at(c, f"$.{k}", "int"), F.lit(0))
    objects = F.filter(cells, lambda c: at(c, "$", "map<string,variant>").isNotNull())
    plain = F.array_sort(F.transform(objects, lambda c, i: F.struct(place(c, CELL_ROW).alias("r"), place(c, CELL_COLUMN).alias("c"), i.alias("i"), F.coalesce(at(c, "$.text", "string"), F.lit("")).alias("t"))))
    zero, bare = F.lit(0), F.array().cast("array<string>")
    numbers = lambda a: F.when(F.size(a) > 0, F.sequence(zero, F.size(a) - 1)).otherwise(F.array().cast("array<int>"))

    def row(own: Column) -> Column:
        before = lambda i: F.coalesce(F.get(own, i - 1)["c"], F.lit(-1))
        return F.flatten(F.transform(own, lambda c, i: F.concat(F.array_repeat(F.lit(""), c["c"] - before(i) - 1), F.array(c["t"]))))

    def stretches(kept: Column) -> Column:
        """(r, cells) of every row that has cells."""
        begins = F.filter(numbers(kept), lambda k: (k == 0) | (F.get(kept, k)["r"] != F.get(kept, k - 1)["r"]))
        end = lambda b, j: F.coalesce(F.get(b, j + 1), F.size(kept))
        return _let(begins, lambda b: F.transform(b, lambda k, j: F.struct(F.get(kept, k)["r"].alias("r"), row(F.slice(kept, k + 1, end(b, j) - k)).alias("cells"))))

    def grid(every: Column) -> Column:
        height = F.element_at(every, -1)["r"]
        # A table whose rows are all below zero is read downwards, from zero to its last one.
        last = F.filter(every, lambda c: (c["c"] >= 0) & F.when(height >= 0, c["r"] >= 0).otherwise(c["r"] == height))
        kept = _let(last, lambda a: F.filter(a, lambda c, k: F.coalesce((F.get(a, k + 1)["r"] != c["r"]) | (F.get(a, k + 1)["c"] != c["c"]), F.lit(True))))
        return _let(_let(kept, stretches), lambda rows: F.when(height >= 0, _filled(rows, height)).otherwise(F.concat(F.array_repeat(bare, -height), F.array(F.coalesce(F.get(rows, zero)["cells"], bare)))))

    def _filled(rows: Column, height: Column) -> Column:
        before = lambda j: F.coalesce(F.get(rows, j - 1)["r"], F.lit(-1))
        some = F.flatten(F.transform(rows, lambda r, j: F.concat(F.array_repeat(bare, r["r"] - before(j) - 1), F.array(r["cells"]))))
        return F.concat(some, F.array_repeat(bare, height - F.coalesce(F.get(rows, F.size(rows) - 1)["r"], F.lit(-1))))

    return _let(plain, lambda every: F.when(F.size(every) > 0, grid(every)))


def tables(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tables of parsed payloads: headers and rows as given, else put together from cells; empty ones are skipped."""
    b, none, nothing = F.col("b"), F.array().cast("array<string>"), F.array().cast("array<array<string>>")
    headers = F.coalesce(F.transform(at(b, "$.headers", "array<variant>"), lambda h: F.coalesce(at(h, "$", "string"), F.lit(""))), none)
    lists = F.transform(at(b, "$.rows", "array<variant>"), lambda r: at(r, "$", "array<variant>"))
    given = F.coalesce(F.transform(F.filter(lists, lambda r: r.isNotNull()), lambda r: F.transform(r, lambda c: F.coalesce(at(c, "$", "string"), F.lit("")))), nothing)
    table = lambda h, r: F.struct(h.alias("headers"), r.alias("rows"))
    cut = lambda g: F.when(g.isNotNull(), table(F.get(g, F.lit(0)), F.slice(g, 2, F.greatest(F.size(g), F.lit(1)))))
    whole = lambda t: F.when((F.size(t["headers"]) > 0) | (F.size(t["rows"]) > 0), t).otherwise(_let(_dense(at(b, "$.data.table_cells", "array<variant>")), cut))
    full = lambda t: t.isNotNull() & ((F.size(t["headers"]) > 0) | (F.size(t["rows"]) > 0))
    # Exploded, so that a table is put together once, whatever is asked of it.
    found = _placed(_items(rows, key, TABLE_KEYS), "tbl", TABLE_CONFIDENCE)
    found = found.withColumn("table", F.explode(F.filter(F.array(_let(table(headers, given), whole)), full)))
    found = found.withColumn("headers", F.col("table.headers")).withColumn("rows", F.col("table.rows"))
    return found.select(key, "idx", "item_id", "page_number", "box", at(b, "$.caption", "string").alias("caption"), "headers", "rows", _hash(table_serial(F.col("headers"), F.col("rows"))).alias("content_hash"), "confidence")


def figures(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Figures of parsed payloads; those without a caption are kept."""
    b = F.col("b")
    caption = F.coalesce(at(b, "$.caption", "string"), F.lit(""))
    found = _placed(_items(rows, key, FIGURE_KEYS), "fig", FIGURE_CONFIDENCE)
    serial = F.concat_ws("-", caption, "page_number", "idx")
    return found.select(key, "idx", "item_id", "page_number", "box", nothing_if_empty(caption).alias("caption"), F.coalesce(nothing_if_empty(at(b, "$.figure_type", "string")), F.lit("image")).alias("figure_type"), _hash(serial).alias("content_hash"), "confidence")


def normalized(payloads: DataFrame, key: str = "doc_id", column: str = "payload") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(documents, text blocks, tables, figures); documents have page_count and error."""
    rows = parsed(payloads, key, column)
    documents = rows.select(key, F.when(F.col("error").isNull(), pages_of(F.col("v"))).alias("page_count"), "error")
    good = rows.where("error is null")
    return documents, text_blocks(good, key), tables(good, key), figures(good, key)
