"""Page-wise views of text and HTML tables, and the layout payload of web pages."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A page takes so many lines; a line is LINE_HEIGHT high, a character CHAR_WIDTH wide.
LINES, LINE_HEIGHT, CHAR_WIDTH, PAGE_WIDTH = 40, 12, 5, 612


def line_blocks(docs: DataFrame) -> DataFrame:
    """One paragraph block per non-blank line: doc_id, ord, page_number, line, text."""
    lines = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("ord", "text"))
    placed = lines.select(
        "doc_id", "ord", (F.floor(F.col("ord") / LINES) + 1).cast("int").alias("page_number"), (F.col("ord") % LINES).alias("line"), "text"
    )
    return placed.where(F.length(F.trim("text")) > 0)


def word_blocks(docs: DataFrame) -> DataFrame:
    """One block per word; the reading order starts anew on every page (the fast text mode)."""
    lines = line_blocks(docs)
    words = lines.select("doc_id", "page_number", "ord", F.posexplode(F.filter(F.split("text", r"\s+"), lambda w: F.length(w) > 0)).alias("pos", "text"))
    order = F.row_number().over(Window.partitionBy("doc_id", "page_number").orderBy("ord", "pos"))
    return words.select("doc_id", "page_number", order.alias("reading_order"), "text").withColumn("block_id", F.format_string("tb-%d-%d", "page_number", "reading_order"))


def word_boxes(docs: DataFrame) -> DataFrame:
    """Word boxes as a text layout implies them: doc_id, page_number, x0, x1, top.

    A word begins behind the words before it in its line, a running sum. Rows are dealt
    by page, so the sum and what groups by page later need one shuffle.
    """
    lines = line_blocks(docs)
    words = lines.select("doc_id", "page_number", "line", F.posexplode(F.split("text", " ")).alias("i", "w")).repartition("doc_id", "page_number")
    before = Window.partitionBy("doc_id", "page_number", "line").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("w") + 1).over(before), F.lit(0))
    x0 = (at * CHAR_WIDTH % PAGE_WIDTH).cast("double")
    boxes = words.select("doc_id", "page_number", x0.alias("x0"), (x0 + F.length("w") * CHAR_WIDTH).alias("x1"), (F.col("line") * LINE_HEIGHT).cast("double").alias("top"))
    return boxes.where("x1 > x0")


#: Characters that are placed at a time, about; a text is not divided.
PLACED_CHARS = 1 << 20


def _placed(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    """The pages of some texts with their words: positions of blanks and line ends, by numpy over all their characters."""
    chars = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.append(np.flatnonzero((chars == 32) | (chars == 10)), len(chars))
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = np.append(chars[ends[:-1]] == 10, True)
    line = np.cumsum(last) - last
    line_starts = np.concatenate([[0], ends[last][:-1] + 1])
    doc_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
    doc = np.searchsorted(doc_starts, line_starts, "right") - 1
    page = (np.arange(len(line_starts)) - np.searchsorted(line_starts, doc_starts)[doc]) // LINES + 1
    word = ends > starts
    line, n, at = line[word], (ends - starts)[word], (starts - line_starts[line])[word]
    x0 = at * CHAR_WIDTH % PAGE_WIDTH
    first = np.flatnonzero((np.diff(doc[line], prepend=-1) != 0) | (np.diff(page[line], prepend=-1) != 0))
    boxes = pa.StructArray.from_arrays([pa.array(x0.astype("f8")), pa.array((x0 + n * CHAR_WIDTH).astype("f8"))], ["x0", "x1"])
    xs = pa.ListArray.from_arrays(pa.array(np.append(first, len(x0)).astype("i4")), boxes)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(doc[line[first]])), pa.array(page[line[first]].astype("i4")), xs], ["doc_id", "page_number", "xs"])


def _placed_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, held, size = batch.column(0), [], 0
        for i, text in enumerate(batch.column(1), 1):
            held.append(text.as_py() or "")
            size += len(held[-1])
            if size >= most or i == len(ids):
                yield _placed(ids.slice(i - len(held), len(held)), held)
                held, size = [], 0


def page_boxes(docs: DataFrame, most: int = PLACED_CHARS) -> DataFrame:
    """The rows of ``word_boxes`` as whole pages: doc_id, page_number, xs (array of x0 and x1). Pages without words are left out.

    A document's words are placed in the task that reads it, about ``most`` characters at a time, so
    nothing is shuffled; Python only finds where words begin and end.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, page_number int, xs array<struct<x0: double, x1: double>>"
    return docs.select("doc_id", "text").mapInArrow(partial(_placed_batches, most=most), schema)


def _texts(html: Column, tag: str) -> Column:
    """What follows each opening tag, up to the next tag that is not an inline one."""
    return F.regexp_extract_all(html, F.lit(rf"<{tag}(?: [^>]*)?>([^<]*(?:</?(?:a|b|br|em|i)(?: [^>]*)?>[^<]*)*)"), F.lit(1))


def html_payload(pages: DataFrame) -> DataFrame:
    """Layout payload of web pages: (page_id, pos, block_type, text, confidence), noise removed.

    Headings come from title and h1, list items from li, paragraphs from p. Blank
    blocks are dropped; text keeps no tags and no entities of the common five.
    """
    noise = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<(?:style|script)[^>]*>.*?</(?:style|script)>", "")

    def blocks(tag: str, kind: str) -> Column:
        return F.transform(_texts(F.col("clean"), tag), lambda t: F.struct(F.lit(kind).alias("block_type"), t.alias("raw")))

    found = pages.select("page_id", noise.alias("clean"))
    flat = found.select("page_id", F.posexplode(F.concat(blocks("title", "title"), blocks("h1", "heading"), blocks("li", "list_item"), blocks("p", "paragraph"))).alias("pos", "b"))
    text = F.regexp_replace(F.col("b.raw"), r"<[^>]*>", "")
    for entity, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(mark))
    out = flat.select("page_id", "pos", F.col("b.block_type").alias("block_type"), F.trim(text).alias("text"), F.lit(0.9).alias("confidence"))
    return out.where(F.length("text") > 0)
