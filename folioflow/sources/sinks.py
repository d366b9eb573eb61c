"""Where results go: scratch tables, document-wise overwrite, ledgers, keyed upsert, nested trees."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Buckets that a store of documents is partitioned into.
BUCKETS = 64


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    A session on one machine may do without; there a temporary folder is set.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="folioflow-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


_recorders: list[list[str]] = []


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    for paths in _recorders:
        paths.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The scratch paths that are made meanwhile, so that they can be removed when nothing reads them any more."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders.remove(paths)


def written(df: DataFrame, what: str, many: bool = False) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    This cuts the lineage: what was written survives the loss of any executor. ``many`` marks
    rows that grow with the documents.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, what)
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    return shuffled(rows) if many else rows


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, which joins shuffle and never broadcast.

    Spark's size check takes the size of files, which is a fortieth of that of rows where columns
    repeat few values: a table of 10 MB would pass through the driver as 400 MB.
    """
    return df.hint("merge")


#: Rows that one task sorts, joins or groups, about.
TASK_ROWS = 250_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many tasks so many rows are dealt to: whole rounds of the session's cores, or 0 if one round does."""
    cores = spark.sparkContext.defaultParallelism
    rounds = -(-rows // (TASK_ROWS * cores))
    return rounds * cores if rounds > 1 else 0


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` in so many tasks by ``keys``, for the window, group or join by them that follows; 0 leaves that to Spark.

    Spark's number of tasks is fixed, or follows the shuffle's bytes; of columns that repeat few
    values a megabyte holds 300,000 rows, so the rows of a task, and its memory, would grow with the input.
    """
    return shuffled(df.repartition(tasks, *keys)) if tasks else df


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What is stored at ``path``; nothing where no table is."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def overwrite_documents(df: DataFrame, path: str, doc_ids: DataFrame | None = None) -> None:
    """Replaces what is stored of the documents in ``df``, and of those in ``doc_ids`` (doc_id), by ``df``.

    The store is partitioned by a bucket of doc_id. Only the buckets of these documents
    are written anew, with the rows of their other documents as they were; where none of them
    is stored yet, ``df`` is put beside what is there.
    """
    spark = df.sparkSession
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")
    new = df.withColumn("bucket", bucket)
    ids = df.select("doc_id") if doc_ids is None else df.select("doc_id").unionByName(doc_ids.select("doc_id"))
    gone = ids.distinct().withColumn("bucket", bucket)
    held = stored(spark, path, new.schema)
    if not held.select("doc_id").distinct().join(gone.select("doc_id"), "doc_id", "left_semi").limit(1).count():
        new.write.mode("append").partitionBy("bucket").parquet(path)
        return
    touched = [r.bucket for r in gone.select("bucket").distinct().collect()]
    before = held.where(F.col("bucket").isin(touched))
    # Partitions are only replaced when all rows are written, so reading them meanwhile is safe.
    rows = before.join(gone.select("doc_id"), "doc_id", "left_anti").select(*new.columns).unionByName(new)
    empty = set(touched) - {r.bucket for r in rows.select("bucket").distinct().collect()} if doc_ids is not None else ()
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    for b in empty:
        removed(spark, f"{path}/bucket={b}")


def append_ledger(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def upserted(existing: DataFrame, new: DataFrame, key: str, order: Column | str | None = None) -> DataFrame:
    """``existing`` with the rows of ``new`` inserted, or put in place by key.

    Of new rows that share a key the last by ``order`` stays, of equal ones the largest.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in new.columns])
    by = row if order is None else F.struct(F.col(order) if isinstance(order, str) else order, row)
    one = new.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, by).alias("_row")).select("_row.*")
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(one.select(*existing.columns))


def nested_json(sections: DataFrame) -> DataFrame:
    """(doc_id, tree): the sections of each document as JSON, children inside their parents in reading order.

    Levels are folded from the deepest up, one group a level, so the number of steps is
    the depth of the deepest tree.
    """
    depths = sections.agg(F.max("depth")).first()[0] or 0
    head = F.regexp_replace(F.to_json(F.struct("section_id", "title", "path")), r"\}$", "")
    below = None
    for depth in range(depths, 0, -1):
        level = sections.where(F.col("depth") == depth).select("doc_id", "section_id", "parent_id", "sort_path", head.alias("head"))
        if below is not None:
            level = level.join(below, ["doc_id", "section_id"], "left")
        else:
            level = level.withColumn("children", F.lit(None).cast("string"))
        node = F.concat("head", F.lit(',"child_sections":['), F.coalesce("children", F.lit("")), F.lit("]}"))
        listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sort_path", node.alias("json")))), lambda x: x["json"]), ",")
        if depth > 1:
            below = level.groupBy("doc_id", F.col("parent_id").alias("section_id")).agg(listed.alias("children"))
        else:
            return level.groupBy("doc_id").agg(F.concat(F.lit("["), listed, F.lit("]")).alias("tree"))
    return sections.groupBy("doc_id").agg(F.lit("[]").alias("tree"))
