"""WARC archives of pages: writing them, reading them, and assembling transactions.

A page is captured as three records that share a transaction: the response (or a
revisit, if an earlier page had the same payload), the request and the metadata. The
latter two name the first by WARC-Concurrent-To. Every record is a gzip member of
its own. Reading joins records by that identifier, wherever they are, and emits one
nested row per capture.

Of pages with equal payloads of at least ``least`` bytes, that with the smallest
page_id is the response; the others refer to it. The smallest page_id per payload is
found by an aggregation over digests, so a payload of any frequency is one row per
task before it is shuffled.

A task streams its rows into one file whose name carries the task attempt, and only
files of committed attempts are listed in the manifest. Reading streams as well, one
record in memory at a time.

Defined cases: a null html is an empty payload; a page without page_id is a response
unless its payload belongs to one with an id; rows that repeat the smallest page_id
of a payload are all responses; repeated rows are captures of their own; a null or
odd url is written percent-encoded; empty tables give no file and no row; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import partitions, written

LEAST = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Captures that a reading task hands over at a time.
ROWS = 512


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("WARC-Date", DATE), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 1, mtime=0)


def transaction(capture: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The three records of one capture."""
    target = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")
    own, sha = f"<urn:capture:{capture}>", f"sha1:{digest(payload)}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    shared = [("WARC-Target-URI", target)] if target else []
    named = [("WARC-Page-ID", f"<urn:page:{page_id}>")] if page_id is not None else []
    first = [("WARC-Record-ID", own), *shared, *named, ("WARC-Payload-Digest", sha), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is None:
        out = record("response", first, http + payload)
    else:
        out = record("revisit", [*first, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")], http)
    request = f"GET {target or '/'} HTTP/1.1\r\n\r\n".encode()
    out += record("request", [("WARC-Record-ID", f"<urn:capture:{capture}:request>"), ("WARC-Concurrent-To", own), *shared, ("Content-Type", "application/http;msgtype=request")], request)
    fields = f"payload-bytes: {len(payload)}\r\n".encode()
    out += record("metadata", [("WARC-Record-ID", f"<urn:capture:{capture}:metadata>"), ("WARC-Concurrent-To", own), *shared, ("Content-Type", "application/warc-fields")], fields)
    return out


def originals(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(sha, original): payloads that occur more than once, and their smallest page_id."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("sha"), F.length(payload).alias("n"))
    groups = slim.where(F.col("n") >= least).groupBy("sha").agg(F.min("page_id").alias("original"), F.count("*").alias("copies"))
    return groups.where("copies > 1 and original is not null").select("sha", "original")


def write_archives(pages: DataFrame, path: str, least: int = LEAST) -> DataFrame:
    """Writes the captures of ``pages`` (page_id, url, html); returns the manifest (part, file, captures)."""
    spark = pages.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{path}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        stream, n = None, 0
        for batch in batches:
            for page_id, url, html, original in zip(batch.column(0), batch.column(1), batch.column(2), batch.column(3)):
                if stream is None:
                    store, at = pyarrow.fs.FileSystem.from_uri(name)
                    store.create_dir(at.rpartition("/")[0], recursive=True)
                    stream = store.open_output_stream(at, compression=None)
                page, first = page_id.as_py(), original.as_py()
                refers_to = first if first is not None and first != page else None
                stream.write(transaction(f"{task.partitionId()}-{n}", page, url.as_py(), html.as_py() or b"", refers_to))
                n += 1
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "file": [name], "captures": pa.array([n], pa.int64())})

    first = written(originals(pages, least), "payloads")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")).withColumn("sha", F.sha1("html"))
    schema = "part int, file string, captures long"
    plain.join(first, "sha", "left").select("page_id", "url", "html", "original").mapInArrow(run, schema).write.parquet(f"{path}/manifest")
    return spark.read.schema(schema).parquet(f"{path}/manifest")


def records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record of an archive, streamed."""
    store, at = pyarrow.fs.FileSystem.from_uri(path)
    with store.open_input_stream(at, compression=None) as raw, gzip.GzipFile(fileobj=raw, mode="rb") as file:
        while line := file.readline():
            if not line.startswith(b"WARC/"):
                continue
            headers: dict[str, str] = {}
            while (line := file.readline()) not in (b"\r\n", b""):
                key, _, value = line.decode().partition(":")
                headers[key.strip().lower()] = value.strip()
            yield headers, file.read(int(headers["content-length"]))


RECORD = "record_id string, type string, concurrent_to string, page_id long, uri string, bytes long, digest string, refers_to long, fields string"


def _number(urn: str | None) -> int | None:
    return int(urn.strip("<>").rpartition(":")[2]) if urn else None


def read_records(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the manifest's files; length and digest are those of the payload read."""

    def rows(path: str) -> Iterator[dict]:
        for h, block in records(path):
            kind = h["warc-type"]
            row = {"record_id": h["warc-record-id"], "type": kind, "concurrent_to": h.get("warc-concurrent-to"), "page_id": _number(h.get("warc-page-id")), "uri": h.get("warc-target-uri")}
            if kind == "response":
                payload = block.partition(b"\r\n\r\n")[2]
                row |= {"bytes": len(payload), "digest": digest(payload)}
                if with_payload:
                    row["payload"] = payload
            elif kind == "revisit":
                row |= {"digest": h["warc-payload-digest"].partition(":")[2], "refers_to": _number(h.get("warc-refers-to"))}
            elif kind == "metadata":
                row |= {"fields": block.decode()}
            yield row

    schema = RECORD + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held: list[dict] = []

                def flush() -> pa.RecordBatch:
                    columns = [pa.array([r.get(n) for r in held], k) for n, k in zip(names, kinds)]
                    held.clear()
                    return pa.RecordBatch.from_arrays(columns, names=names)

                for row in rows(path):
                    held.append(row)
                    if len(held) >= ROWS:
                        yield flush()
                if held:
                    yield flush()

    n = partitions(manifest.sparkSession)
    dealt = manifest.withColumn("deal", F.pmod(F.col("part"), F.lit(n))).repartitionById(n, "deal")
    return dealt.select("file").mapInArrow(run, schema)


def captures(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One nested row per capture: page_id, the response or revisit, its request and its metadata."""
    read = read_records(manifest, with_payload)
    key = F.coalesce("concurrent_to", "record_id")

    def part(kinds: tuple[str, ...], columns: list[str]):
        return F.max(F.when(F.col("type").isin(*kinds), F.struct(*columns)))

    response = ["type", "record_id", "page_id", "uri", "bytes", "digest", "refers_to", *(["payload"] if with_payload else [])]
    joined = read.groupBy(key.alias("capture_id")).agg(
        part(("response", "revisit"), response).alias("response"), part(("request",), ["record_id", "uri"]).alias("request"), part(("metadata",), ["record_id", "fields"]).alias("metadata")
    )
    return joined.where("response is not null").select(F.col("response.page_id").alias("page_id"), "capture_id", "response", "request", "metadata")


def payload_bytes() -> Column:
    """A capture's payload length: as read, or for a revisit as its metadata record says."""
    told = F.regexp_extract("metadata.fields", r"payload-bytes: (\d+)", 1)
    return F.coalesce(F.col("response.bytes"), F.nullif(told, F.lit("")).cast("long"))
