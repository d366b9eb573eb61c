"""The fact table: key-value lines, table cells and inline amounts of chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import DATE, KEY_VALUE, first_match, first_value, normal_name, short_hash, value_type

#: Names that an amount in the text is filed under.
HINTS = ("amount due", "date", "expenditure", "expense", "fiscal period", "income", "invoice number", "margin", "period", "profit", "ratio", "revenue")


def _lines(content: Column) -> Column:
    return F.filter(F.transform(F.split(content, r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def _described(chunks: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """What all facts of a chunk have in common, taken once a chunk, with the columns ``more``."""
    box = F.to_json("box") if "box" in chunks.columns else F.lit(None).cast("string")
    return chunks.select("doc_id", "chunk_id", "chunk_type", "content", "section", "content_hash", first_match(F.col("content"), DATE).alias("period"), F.array_min("pages").alias("page_number"), box.alias("bounding_box_json"), _lines(F.col("content")).alias("lines"), *more)


def _cells(line: Column) -> Column:
    return F.transform(F.split(line, r"\s*\|\s*"), lambda x: F.trim(x))


def _pair(name: Column, value: Column) -> Column:
    return F.struct(name.alias("name"), value.alias("value"))


def _key_values() -> Column:
    """Names and values of lines like ``name: value``."""
    told = F.transform(F.filter("lines", lambda x: x.rlike(KEY_VALUE)), lambda x: _pair(*(F.trim(F.regexp_extract(x, KEY_VALUE, g)) for g in (1, 2))))
    return F.filter(told, lambda p: F.length(p["value"]) > 0)


def _with_heads(rows: DataFrame) -> DataFrame:
    """Adds the cells of the header line; none where a chunk is no table."""
    tabular = (F.col("chunk_type").isin("table", "table_segment") | F.col("content").contains("|")) & (F.size("lines") >= 2)
    return rows.withColumn("heads", F.when(tabular, F.filter(_cells(F.element_at("lines", 1)), lambda x: F.length(x) > 0)))


def _table_cells() -> Column:
    """Names and values of table rows that have as many cells as headers: row label and header name the value."""
    rows = F.filter(F.transform(F.slice("lines", F.lit(2), F.size("lines")), _cells), lambda row: F.size(row) == F.size("heads"))

    def pairs(row: Column) -> Column:
        zipped = F.arrays_zip(F.slice("heads", F.lit(2), F.size("heads")).alias("h"), F.slice(row, F.lit(2), F.size("heads")).alias("v"))
        return F.transform(F.filter(zipped, lambda p: F.length(p["v"]) > 0), lambda p: _pair(F.trim(F.concat(F.element_at(row, 1), F.lit(" "), p["h"])), p["v"]))

    return F.when(F.size("heads") >= 2, F.flatten(F.transform(rows, pairs)))


def _inline_values() -> Column:
    """For every hint that the text contains, the first amount, share or date of the chunk."""
    hints = F.filter(F.array(*map(F.lit, HINTS)), lambda h: F.lower("content").contains(h))
    return F.when(F.col("inline").isNotNull(), F.transform(hints, lambda h: _pair(F.initcap(h), F.col("inline"))))


def key_values(chunks: DataFrame) -> DataFrame:
    """Facts of lines like ``name: value``."""
    return _facts(_described(chunks).select("*", F.explode(_key_values()).alias("p")), F.lit("key_value"))


def table_cells(chunks: DataFrame) -> DataFrame:
    """Facts of table rows that have as many cells as headers."""
    return _facts(_with_heads(_described(chunks)).select("*", F.explode(_table_cells()).alias("p")), F.lit("table"))


def inline_values(chunks: DataFrame) -> DataFrame:
    """Facts of hints and the first amount, share or date of the chunk."""
    return _facts(_described(chunks).withColumn("inline", first_value(F.col("content"))).select("*", F.explode(_inline_values()).alias("p")), F.lit("inline"))


def _facts(rows: DataFrame, extraction: Column, more: tuple[str, ...] = ()) -> DataFrame:
    value, name = F.col("p.value"), normal_name(F.col("p.name"))
    typed = value_type(value)
    fact_id = F.concat(F.lit("fact-"), short_hash(16, F.col("doc_id"), F.col("chunk_id"), name, value))
    return rows.select(
        fact_id.alias("fact_id"),
        "doc_id",
        F.col("chunk_id").alias("source_chunk_id"),
        F.trim("p.name").alias("fact_name"),
        name.alias("normalized_name"),
        F.trim(value).alias("fact_value"),
        typed["value_type"].alias("value_type"),
        typed["unit"].alias("unit"),
        typed["numeric_value"].alias("numeric_value"),
        "period",
        F.col("doc_id").alias("document_name"),
        "page_number",
        "bounding_box_json",
        F.col("section").alias("section_title"),
        "content_hash",
        extraction.alias("extraction"),
        *more,
    )


#: What the lookup of facts reads.
LOOKED_UP = ("doc_id", "fact_name", "normalized_name", "fact_value", "page_number")


#: Kinds of extraction; of equal facts the later kind's stays.
KINDS = ("key_value", "table", "inline")


def facts(chunks: DataFrame, kept: tuple[str, ...] | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """All facts, one row per fact_id (the later kind of extraction wins), with the columns ``kept``, or all, and the chunks' columns ``more``.

    ``chunks`` has one row per chunk_id. A fact's id is made of its chunk's, so facts that share one stand in one
    chunk, and what is told twice drops out in the chunk's row: nothing is shuffled, and facts stay where their chunks are.
    """
    none = F.array().cast("array<struct<name: string, value: string>>")

    def ranked(rank: int, pairs: Column) -> Column:
        same = lambda p: F.concat(normal_name(p["name"]), F.lit(":"), p["value"])
        return F.transform(F.coalesce(pairs, none), lambda p: F.struct(same(p).alias("same"), F.lit(rank).alias("rank"), p["name"].alias("name"), p["value"].alias("value")))

    told = F.concat(*[ranked(n, pairs) for n, pairs in enumerate((_key_values(), _table_cells(), _inline_values()), 1)])
    rows = _with_heads(_described(chunks, more)).withColumn("inline", first_value(F.col("content")))
    rows = rows.withColumn("told", F.array_sort(told)).drop("content", "lines", "heads", "inline")
    last = F.filter("told", lambda p, i: ~F.coalesce(F.get("told", i + 1)["same"] == p["same"], F.lit(False)))
    every = _facts(rows.select("*", F.explode(last).alias("p")), F.element_at(F.array(*map(F.lit, KINDS)), F.col("p.rank")), more)
    return every if kept is None else every.select("fact_id", *kept, *more)


def with_sections(rows: DataFrame, sections: DataFrame, title: str = "section_title") -> DataFrame:
    """Facts, or chunks, with the id of the section that their column ``title`` names."""
    known = sections.select("doc_id", "key", "section_id")
    return rows.withColumn("key", F.coalesce(title, F.lit(""))).join(known, ["doc_id", "key"], "left").drop("key")


def typed(rows: DataFrame) -> DataFrame:
    """Stored facts as they are handed out: the box parsed, a missing score zero."""
    box = F.from_json("bounding_box_json", "x0 double, y0 double, x1 double, y1 double")
    score = F.coalesce("score", F.lit(0.0)) if "score" in rows.columns else F.lit(0.0)
    return rows.withColumn("box", box).withColumn("score", score.cast("double")).drop("bounding_box_json")
