"""Incremental ingest with Structured Streaming: each file is taken once, whatever run it comes in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest_new_files(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, kind: str = "json") -> StreamingQuery:
    """Appends rows of files not seen before to a Parquet table, with the file each came from; stops when all are in."""
    rows = spark.readStream.format(kind).schema(schema).load(source).withColumn("source_file", F.input_file_name())
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)


def windowed_counts(events: DataFrame, time_col: str, key: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts by key and window; rows later than the watermark are left out."""
    stamped = events.withColumn("__t", F.col(time_col).cast("timestamp")).withWatermark("__t", late)
    return stamped.groupBy(F.window("__t", window), key).agg(F.count("*").alias("n"))
