"""Structured Streaming over append-only ledgers: an extension of the batch engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from folioflow.sources.sinks import scratch


def ledger_stream(spark: SparkSession, path: str) -> DataFrame:
    """A ledger (event_id, ts, user_id, event_type, value, props) as a stream of its files.

    ``path`` is a folder of files or one file, which is then picked out of its folder.
    """
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name if _is_file(spark, path) else "*.parquet")
    found = stream.parquet(folder if _is_file(spark, path) else path)
    return found.withColumn("ts", F.col("ts").cast("timestamp"))


def _is_file(spark: SparkSession, path: str) -> bool:
    """Whether Spark reads the path as one file of that very name."""
    files = spark.read.parquet(path).inputFiles()
    return len(files) == 1 and files[0].rpartition("/")[2] == path.rstrip("/").rpartition("/")[2]


def windowed(stream: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Entries and values per time window and type; entries later than ``late`` are left out of closed windows."""
    return (
        stream.withWatermark("ts", late)
        .groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count("*").alias("entries"), F.round(F.sum("value"), 2).alias("total"))
        .select(F.col("w.start").alias("window_start"), "event_type", "entries", "total")
    )


def drained(stream: DataFrame, keys: tuple[str, ...] = ("window_start", "event_type")) -> DataFrame:
    """What a stream's result is once all present files are read.

    Batches bring the rows that they changed; each is written once, and of rows that share
    their keys, null ones too, the last batch's counts. The watermark bounds the state: closed
    windows are dropped from it, and rows that come too late for theirs are left out.
    """
    spark = stream.sparkSession
    out, state = scratch(spark, "stream"), scratch(spark, "stream-state")
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        # A batch that is run again takes its own place.
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    spark.createDataFrame([], schema).write.parquet(f"{out}/batch=-1")
    stream.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    every = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(out)
    return every.groupBy(*keys).agg(F.max_by(F.struct(*schema.names), "batch").alias("row")).select("row.*")
