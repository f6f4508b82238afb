"""Session builder with the settings that the operators expect, and the shared folder that cuts lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """AQE with skew handling, UTC, Arrow transfer; size shuffle_partitions to the data (about 128 MB a partition)."""
    b = SparkSession.builder.appName("foliant").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def root_dir(spark: SparkSession) -> str:
    """The folder that the session names. Only a session on one machine may name none: its executors share /tmp."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: a folder that all executors share is needed")
    return root or "/tmp/checkpoints/foliant"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below root_dir, which every executor sees; it goes when the driver ends."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{root_dir(spark)}/work-{uuid.uuid4().hex}")
    path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def checkpoint(df: DataFrame) -> DataFrame:
    """df.checkpoint() in root_dir."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root_dir(df.sparkSession))
    return df.checkpoint()
