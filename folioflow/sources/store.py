"""A keyed store of documents: immutable files, a log of commits, buckets that split by size.

Rows lie in buckets by the leading bits of their document's hash. A bucket's name is its bits, so
buckets of different depth form a tree: one that would grow beyond ``most_bytes`` is split when it
is written, and a document's rows are in one bucket at any size of the store. Replacing documents
rewrites their buckets and no others.

A commit writes new files first and then a manifest of the buckets that it changed, which
becomes visible by one rename. Files are never changed: a writer that dies before the rename
leaves what was there before, a reader keeps the version that it began with, and of two writers
that began with the same version the second is refused. ``compact`` joins small sibling buckets,
``vacuum`` removes the files that no kept version names.

    path/log/<version>      manifests: bucket, live, files, rows, bytes
    path/data/commit=<id>/bucket=<bits>-/...
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioflow.sources.sinks import written

MOST_BYTES = 256 * 2**20
#: Bits of a hash that buckets can tell apart.
DEPTH = 32
_MANIFEST = "bucket string, live boolean, files array<string>, rows long, bytes long"


class Conflict(RuntimeError):
    """Another writer has committed meanwhile."""


def bits(key: str) -> Column:
    return F.lpad(F.bin(F.pmod(F.xxhash64(key), F.lit(2**DEPTH))), DEPTH, "0")


class Store:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "doc_id", most_bytes: int = MOST_BYTES) -> None:
        self.spark, self.path, self.schema, self.key, self.most = spark, path.rstrip("/"), schema, key, most_bytes
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        return [int(n) for n in self._names("log") if n.isdigit()]

    def snapshot(self, version: int | None = None) -> DataFrame:
        """The live buckets (bucket, files, rows, bytes) of a version, by default the latest."""
        known = [v for v in self.versions() if version is None or v <= version]
        if version is not None and version not in known:
            raise ValueError(f"no version {version}")
        if not known:
            return self.spark.createDataFrame([], _MANIFEST).drop("live")
        logs = [self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/log/{v:012d}").withColumn("v", F.lit(v)) for v in known]
        every = logs[0]
        for log in logs[1:]:
            every = every.unionByName(log)
        last = every.groupBy("bucket").agg(F.max_by(F.struct("live", "files", "rows", "bytes"), "v").alias("b"))
        return last.where("b.live").select("bucket", "b.files", "b.rows", "b.bytes")

    def _located(self, ids: DataFrame, buckets: DataFrame) -> DataFrame:
        """(key, bits, bucket) of documents: the bucket whose bits theirs begin with."""
        depths = [r.d for r in buckets.select(F.length("bucket").alias("d")).distinct().collect()]  # at most DEPTH + 1
        prefixes = F.explode(F.array(*[F.substring("bits", 1, d) for d in depths]))
        return ids.withColumn("bits", bits(self.key)).withColumn("bucket", prefixes).join(buckets.select("bucket"), "bucket")

    def _files(self, buckets: DataFrame) -> DataFrame:
        files = [r.f for r in buckets.select(F.explode("files").alias("f")).collect()]
        if not files:
            return self.spark.createDataFrame([], self.schema).withColumn("bucket", F.lit(None).cast("string"))
        whole = StructType(list(self.schema.fields)).add("bucket", "string")
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*files)

    def _commit(self, base: int, gone: DataFrame, made: DataFrame, rows: DataFrame | None) -> int:
        """Writes ``rows`` (with their bucket) and a manifest: buckets in ``gone`` end, those in ``made`` begin."""
        name = uuid.uuid4().hex
        data = f"{self.path}/data/commit={name}"
        entries = None
        if rows is not None:
            # A dash, as names of bits alone would be read as numbers.
            rows.withColumn("bucket", F.concat("bucket", F.lit("-"))).repartition("bucket").write.partitionBy("bucket").parquet(data)
            if self.spark.read.schema(rows.schema).parquet(data).limit(1).count():
                found = self.spark.read.schema(rows.schema).parquet(data).select(F.regexp_replace("bucket", "-$", "").alias("bucket"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
                files = found.groupBy("bucket", "f").agg(F.count("*").alias("n"), F.first("s").alias("s"))
                entries = files.groupBy("bucket").agg(F.collect_list("f").alias("files"), F.sum("n").alias("rows"), F.sum("s").alias("bytes"))
        none = F.array().cast("array<string>")
        made = made.select("bucket").distinct()
        if entries is None:
            entries = made.limit(0).select("bucket", none.alias("files"), F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("bytes"))
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        live = made.join(entries, "bucket", "left").select("bucket", F.lit(True).alias("live"), F.coalesce("files", none).alias("files"), zero("rows"), zero("bytes"))
        dead = gone.select("bucket").distinct().join(made, "bucket", "left_anti").select("bucket", F.lit(False).alias("live"), none.alias("files"), F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("bytes"))
        pending = f"log/_pending-{name}"
        live.unionByName(dead).coalesce(1).write.parquet(f"{self.path}/{pending}")
        self._publish(pending, base + 1)
        return base + 1

    def _publish(self, pending: str, version: int) -> None:
        """The one step that makes a commit visible."""
        to = self._at("log", f"{version:012d}")
        if self._fs.exists(to) or not self._fs.rename(self._at(pending), to):
            self._fs.delete(self._at(pending), True)
            raise Conflict(f"version {version} is there already")

    def replace(self, df: DataFrame, doc_ids: DataFrame | None = None) -> int:
        """Replaces what is stored of the documents in ``df``, and of those in ``doc_ids``, by ``df``; the new version."""
        base = max(self.versions(), default=0)
        buckets = written(self.snapshot(base or None), "store-buckets")
        if not base:
            buckets = self.spark.range(1).select(F.lit("").alias("bucket"), F.array().cast("array<string>").alias("files"), F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("bytes"))
        new = df.select(*self.schema.names)
        ids = new.select(self.key) if doc_ids is None else new.select(self.key).unionByName(doc_ids.select(self.key))
        sizes = new.groupBy(self.key).agg(F.sum(F.octet_length(F.to_json(F.struct(*new.columns)))).alias("more"))
        located = written(self._located(ids.distinct(), buckets).join(sizes, self.key, "left"), "store-documents")
        touched = buckets.join(located.groupBy("bucket").agg(F.sum("more").alias("more")), "bucket")
        size = F.col("bytes") + F.coalesce("more", F.lit(0))
        deeper = F.least(F.lit(DEPTH) - F.length("bucket"), F.greatest(F.lit(0), F.ceil(F.log2(size / F.lit(self.most))).cast("int")))
        touched = written(touched.withColumn("deeper", F.when(size > 0, deeper).otherwise(0)), "store-touched")
        kept = self._files(touched).drop("bucket").join(located.select(F.col(self.key).alias("_key")).distinct(), F.col(self.key).eqNullSafe(F.col("_key")), "left_anti")
        rows = kept.select(*new.columns).unionByName(new).withColumn("bits", bits(self.key))
        target = self._located(rows.select(self.key).distinct(), touched).join(touched.select("bucket", "deeper"), "bucket")
        target = target.select(F.col(self.key).alias("_key"), F.substring("bits", F.lit(1), F.length("bucket") + F.col("deeper")).alias("bucket"))
        rows = rows.drop("bits").join(target, F.col(self.key).eqNullSafe(F.col("_key"))).drop("_key")
        ends = F.transform(F.sequence(F.lit(0).cast("long"), F.pow(F.lit(2), F.col("deeper")).cast("long") - 1), lambda i: F.when(F.col("deeper") > 0, F.concat("bucket", F.lpad(F.bin(i), F.col("deeper"), F.lit("0")))).otherwise(F.col("bucket")))
        made = touched.select(F.explode(ends).alias("bucket"))
        return self._commit(base, touched, made, rows)

    def compact(self) -> int | None:
        """Joins sibling buckets that together are less than half full; None where there are none."""
        base = max(self.versions(), default=0)
        buckets = self.snapshot(base or None).where("bucket <> ''")
        above = F.expr("substring(bucket, 1, length(bucket) - 1)")
        small = buckets.groupBy(above.alias("parent")).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).where((F.col("n") == 2) & (F.col("bytes") < self.most / 2))
        small = written(buckets.withColumn("parent", above).join(small.select("parent"), "parent"), "store-small")
        if small.limit(1).count() == 0:
            return None
        own = F.regexp_replace("bucket", "-$", "")
        rows = self._files(small).withColumn("bucket", F.substring(own, F.lit(1), F.length(own) - 1))
        return self._commit(base, small, small.select(F.col("parent").alias("bucket")), rows)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version; later commits do not change what is read."""
        return self._files(self.snapshot(version)).select(*self.schema.names)

    def load(self, ids: Iterable[object], version: int | None = None) -> DataFrame:
        """The rows of some documents; of all others' buckets no file is opened."""
        kind = self.schema[self.key].dataType.simpleString()
        asked = self.spark.createDataFrame([(i,) for i in ids], f"{self.key} {kind}")
        snapshot = self.snapshot(version)
        found = self._located(asked, snapshot).select("bucket").distinct()
        names = [r.bucket + "-" for r in found.collect()]  # one a document at most
        rows = self._files(snapshot.join(found, "bucket")).where(F.col("bucket").isin(names))
        return rows.join(asked, self.key, "left_semi").select(*self.schema.names)

    def missing(self, ids: DataFrame, error: str, version: int | None = None) -> DataFrame:
        """(key, error) of the documents that are not stored."""
        return ids.select(self.key).distinct().join(self.read(version).select(self.key), self.key, "left_anti").withColumn("error", F.lit(error))

    def vacuum(self, keep: int = 1) -> int:
        """Removes commits' files that none of the last ``keep`` versions names; their number. Older versions go."""
        known = self.versions()
        last = known[-keep:]
        if not last:
            return 0
        needed = {f.split("/commit=")[1].split("/")[0] for v in last for r in self.snapshot(v).select(F.explode("files").alias("f")).collect() for f in [r.f]}
        first = last[0]
        # The oldest version that stays is written in full, and so needs no log before it.
        name = f"log/_full-{uuid.uuid4().hex}"
        self.snapshot(first).withColumn("live", F.lit(True)).select("bucket", "live", "files", "rows", "bytes").coalesce(1).write.parquet(f"{self.path}/{name}")
        self._fs.delete(self._at("log", f"{first:012d}"), True)
        self._fs.rename(self._at(name), self._at("log", f"{first:012d}"))
        for v in known:
            if v < first:
                self._fs.delete(self._at("log", f"{v:012d}"), True)
        gone = [n for n in self._names("data") if n.removeprefix("commit=") not in needed]
        for n in gone:
            self._fs.delete(self._at("data", n), True)
        return len(gone)
