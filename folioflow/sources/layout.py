"""Stored pages through a layout parser, as a data source: ``spark.read.format("layout_pages")``.

The parser is the boundary: a provider takes the place of ``parse``. Spark plans the reading:
one partition for each row group of the stored Parquet files (so a file of any size is
read in pieces, and a lost one is read again), with filters on the page's number and on the
kind of rows pushed to the reader. Row groups whose range of numbers no filter lets through are
not planned at all; pages that are filtered out are not parsed.

Rows: page_id, kind (block, table or error), pos, block_type, text, confidence, error.
Null pages give one error row, pages in which nothing is found another.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

SCHEMA = "page_id long, kind string, pos int, block_type string, text string, confidence double, error string"
KINDS = ("block", "table", "error")
CONFIDENCE = {"block": 0.9, "table": 0.85}

_NOISE = re.compile(r"(?s)<(?:style|script)[^>]*>.*?</(?:style|script)>")
_TAGS = re.compile(r"<[^>]*>")
_FOUND = [(kind, re.compile(rf"<{tag}(?: [^>]*)?>([^<]*(?:</?(?:a|b|br|em|i)(?: [^>]*)?>[^<]*)*)")) for tag, kind in (("title", "title"), ("h1", "heading"), ("li", "list_item"), ("p", "paragraph"))]
_TABLE, _ROW, _CELL = re.compile(r"(?s)<table[^>]*>(.*?)</table>"), re.compile(r"(?s)<tr[^>]*>(.*?)</tr>"), re.compile(r"(?s)<t[hd][^>]*>(.*?)</t[hd]>")
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def _plain(raw: str) -> str:
    text = _TAGS.sub("", raw)
    for entity, mark in _ENTITIES:
        text = text.replace(entity, mark)
    return text.strip(" ")


def parse(html: str | None) -> Iterator[tuple[str, int, str | None, str | None, str | None]]:
    """(kind, pos, block_type, text, error) of a page."""
    if html is None:
        yield "error", 0, None, None, "layout_provider_error"
        return
    clean, pos, some = _NOISE.sub("", html), -1, False
    for kind, pattern in _FOUND:
        for raw in pattern.findall(clean):
            pos += 1
            if text := _plain(raw):
                some = True
                yield "block", pos, kind, text, None
    for k, body in enumerate(_TABLE.findall(clean)):
        rows = [" | ".join(_plain(c) for c in _CELL.findall(r)) for r in _ROW.findall(body)]
        if text := "\n".join(r for r in rows if r):
            some = True
            yield "table", k, None, text, None
    if not some:
        yield "error", 0, None, None, "layout_provider_conversion_failed"


@dataclass
class RowGroup(InputPartition):
    path: str
    number: int


#: Filters on page_id that the reader takes, as (comparison of a page, of a row group's least and largest page).
_COMPARED = {
    EqualTo: (lambda x, v: x == v, lambda lo, hi, v: lo <= v <= hi),
    GreaterThan: (lambda x, v: x > v, lambda lo, hi, v: hi > v),
    GreaterThanOrEqual: (lambda x, v: x >= v, lambda lo, hi, v: hi >= v),
    LessThan: (lambda x, v: x < v, lambda lo, hi, v: lo < v),
    LessThanOrEqual: (lambda x, v: x <= v, lambda lo, hi, v: lo <= v),
    In: (lambda x, v: x.isin(list(v)), lambda lo, hi, v: any(lo <= y <= hi for y in v)),
}


class LayoutReader(DataSourceReader):
    def __init__(self, path: str, key: str, column: str) -> None:
        self.path, self.key, self.column = path, key, column
        self.pages: list[tuple[type, object]] = []
        self.kinds = set(KINDS)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if f.attribute == ("page_id",) and type(f) in _COMPARED:
                self.pages.append((type(f), f.value))
            elif f.attribute == ("kind",) and isinstance(f, EqualTo):
                self.kinds &= {f.value}
            elif f.attribute == ("kind",) and isinstance(f, In):
                self.kinds &= set(f.value)
            elif isinstance(f, IsNotNull) and f.attribute == ("kind",):
                continue  # it never is
            else:
                yield f

    def _dataset(self, path: str) -> ds.Dataset:
        system, inner = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        return ds.dataset(inner, filesystem=system, format="parquet", exclude_invalid_files=True)

    def partitions(self) -> list[RowGroup]:
        found = []
        if self.kinds:
            for fragment in self._dataset(self.path).get_fragments():
                for group in fragment.row_groups:
                    range_ = (group.statistics or {}).get(self.key)
                    if range_ is None or all(_COMPARED[t][1](range_["min"], range_["max"], v) for t, v in self.pages):
                        found.append(RowGroup(fragment.path, group.id))
        return found or [RowGroup("", -1)]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        if partition.number < 0:
            return
        prefix = self.path.split("://")[0] + "://" if "://" in self.path else ""
        fragment = next(iter(self._dataset(prefix + partition.path).get_fragments())).subset(row_group_ids=[partition.number])
        wanted = None
        for t, v in self.pages:
            one = _COMPARED[t][0](ds.field(self.key), v)
            wanted = one if wanted is None else wanted & one
        for batch in fragment.to_batches(columns=[self.key, self.column], filter=wanted, batch_size=1024):
            rows = [(i, *r) for i, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in parse(html) if r[0] in self.kinds]
            columns = list(zip(*rows)) or [()] * 6
            types = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string())
            page, kind, pos, block_type, text, error = (pa.array(c, t) for c, t in zip(columns, types))
            confidence = pa.array([CONFIDENCE.get(k) for k in columns[1]], pa.float64())
            yield pa.RecordBatch.from_arrays([page, kind, pos, block_type, text, confidence, error], ["page_id", "kind", "pos", "block_type", "text", "confidence", "error"])


class LayoutPages(DataSource):
    """Options: path; key and column, the names of the pages' number and source text (page_id, html)."""

    @classmethod
    def name(cls) -> str:
        return "layout_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LayoutReader:
        if "path" not in self.options:
            raise ValueError("layout_pages needs a path")
        return LayoutReader(self.options["path"], self.options.get("key", "page_id"), self.options.get("column", "html"))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, and lets it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LayoutPages)
