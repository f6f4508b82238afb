"""Cache recency as keyed streaming state, and tables kept by micro-batches that change nothing when they come again."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from foliant.operators.relational import evict

#: What is known of a cached key, and what a touched or expired key sends on: whether it was put just now, or has expired.
STATE = "created_at double, access_count long, last_accessed double, size_bytes long"
ENTRY = f"key string, {STATE}, stored boolean, gone boolean"
COLUMNS = ["key", "created_at", "access_count", "last_accessed", "size_bytes", "stored", "gone"]
#: Accesses: a put has the size of what is stored, a get has none.
ACCESS = "key string, at double, size_bytes long"


class Recency(StatefulProcessor):
    """One key's entry in state, and a timer that ends it `keep` seconds of event time after its last access (none: never).
    A put makes an entry anew without accesses; a get of a known key is one access more; of an unknown key, nothing."""

    def __init__(self, keep: float | None = None):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        accesses = pd.concat(list(rows)).sort_values(["at", "size_bytes"], kind="stable", na_position="last")
        known, stored = self.entry.get() if self.entry.exists() else None, False
        for at, size in zip(accesses["at"], accesses["size_bytes"], strict=True):
            if not pd.isna(size):
                known, stored = (at, 0, at, int(size)), True
            elif known is not None:
                known = (known[0], known[1] + 1, max(known[2], at), known[3])
        if known is None:
            return
        self.entry.update(tuple(known))
        if self.keep is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int((known[2] + self.keep) * 1000))
        yield pd.DataFrame([(*key, *known, stored, False)], columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        if self.entry.exists():
            known = self.entry.get()
            self.entry.clear()
            yield pd.DataFrame([(*key, *known, False, True)], columns=COLUMNS)

    def close(self) -> None:
        pass


def recency(accesses: DataFrame, keep: float | None = None, late: str = "1 minute") -> DataFrame:
    """The entries (ENTRY) that a stream of accesses (ACCESS) changes; gone is true where a key has expired. Rows of null key
    or time are left out, and so are, where keys expire, those later than the watermark."""
    rows = accesses.where("key is not null and at is not null").select("key", "at", "size_bytes")
    if keep is not None:
        rows = rows.withColumn("time", F.timestamp_seconds("at")).withWatermark("time", late)
    return rows.groupBy("key").transformWithStateInPandas(statefulProcessor=Recency(keep), outputStructType=ENTRY, outputMode="Update", timeMode="None" if keep is None else "EventTime")


class Committed:
    """A table in a folder, one version of it a micro-batch, and a log that says which batch made which version.

    A version is written first and its log entry last, under a name of its own, which the file system renames in one
    step. A batch that the log has is not applied again; what a batch left behind that died before its log entry is
    written over by its next run. So each batch changes the table once, whatever is run again."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder, schema
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.files = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self) -> list[int]:
        log = self.path(f"{self.folder}/log")
        return sorted(int(f.getPath().getName()) for f in self.files.listStatus(log) if f.getPath().getName().isdigit()) if self.files.exists(log) else []

    def table(self) -> DataFrame:
        done = self.committed()
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/versions/{done[-1]}") if done else self.spark.createDataFrame([], self.schema)

    def apply(self, batch_id: int, change: Callable[[DataFrame], DataFrame]) -> bool:
        """The next version is change(table()); false if this batch is in the log already."""
        if batch_id in self.committed():
            return False
        change(self.table()).write.mode("overwrite").parquet(f"{self.folder}/versions/{batch_id}")
        self.commit(batch_id)
        return True

    def commit(self, batch_id: int) -> None:
        draft, entry = self.path(f"{self.folder}/log/.{batch_id}"), self.path(f"{self.folder}/log/{batch_id}")
        self.files.create(draft, True).close()
        if not self.files.rename(draft, entry):
            raise OSError(f"batch {batch_id} could not be committed")

    def forget(self, keep: int = 2) -> None:
        """Versions but the last few go; the log stays."""
        for batch_id in self.committed()[:-keep]:
            self.files.delete(self.path(f"{self.folder}/versions/{batch_id}"), True)


CACHE = f"key string, {STATE}"


def keep_cache(accesses: DataFrame, folder: str, checkpoint: str, most: float | None = None, keep: float | None = None) -> StreamingQuery:
    """Starts the stream that keeps the cache's table (CACHE) in `folder` by recency(); over `most` bytes, each micro-batch
    ends with the eviction of the oldest entries. Runs until what is there is in; started again, it goes on where it
    stopped. A get of an evicted key brings nothing back: only its next put does."""
    store = Committed(accesses.sparkSession, folder, CACHE)

    def flush(batch: DataFrame, batch_id: int) -> None:
        def change(table: DataFrame) -> DataFrame:
            there = table.select("key").withColumn("there", F.lit(True))
            news = batch.join(there, "key", "left").where(~F.col("gone") & (F.col("stored") | F.col("there"))).select(*table.columns)
            out = table.join(batch.select("key"), "key", "left_anti").unionByName(news)
            return out if most is None else out.join(evict(out, most).select("key"), "key", "left_anti").select(*table.columns)

        store.apply(batch_id, change)

    return recency(accesses, keep).writeStream.outputMode("update").foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
