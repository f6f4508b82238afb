"""Result cache as a table (key, value, created_at, access_count, last_accessed, size_bytes).

A key is prefix:md5 of a text or of a struct's JSON. Reads and writes of many keys are joins; a whole batch misses or
hits at once, so only what is missing is computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.relational import evict, upsert

SCHEMA = "key string, value binary, created_at double, access_count bigint, last_accessed double, size_bytes bigint"


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def seconds_text(micros: Column) -> Column:
    """Seconds since 1970 as Python writes such a number: no zeros at the end but the first place."""
    digits = F.lpad(F.pmod(micros, F.lit(1_000_000)).cast("string"), 6, "0")
    return F.concat(F.floor(micros / 1_000_000).cast("string"), F.lit("."), F.regexp_replace(digits, "(?<=.)0+$", ""))


def json_key(written: dict[str, Column] | None = None, **fields: Column) -> Column:
    """JSON of the fields in the order of their names, blanks as Python writes them; whole numbers and texts, and in
    `written` values that are JSON already."""
    pairs = []
    for k in sorted({*fields, *(written or {})}):
        if written and k in written:
            pairs.append(F.concat(F.lit(f'"{k}": '), written[k]))
            continue
        whole = F.to_json(F.array(fields[k]), {"ignoreNullFields": "false"})
        pairs.append(F.concat(F.lit(f'"{k}": '), F.substring(whole, F.lit(2), F.length(whole) - 2)))
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def key_of(prefix: str, data: Column) -> Column:
    return F.concat(F.lit(f"{prefix}:"), F.md5(data.cast("binary")))


def ocr_key(path: Column, lang: Column, modified: Column) -> Column:
    """Key of an OCR result: path, language and the file's time (0 where it is missing)."""
    return key_of("ocr", json_key(image_path=path, lang=lang, image_mtime=F.coalesce(modified, F.lit(0))))


def vlm_key(path: Column, prompt: Column, model: Column, modified: Column) -> Column:
    return key_of("vlm", json_key(image_path=path, prompt=prompt, model=model, image_mtime=F.coalesce(modified, F.lit(0))))


def file_keys(files: DataFrame, prefix: str, **fields: Column) -> DataFrame:
    """files (path, modified: a timestamp) with key: that of a result made of each file as it is, and of the fields. A file
    that has changed since has another key. A null time is 0."""
    time = F.coalesce(seconds_text(F.unix_micros(F.col("modified").cast("timestamp"))), F.lit("0"))
    return files.withColumn("key", key_of(prefix, json_key({"image_mtime": time}, image_path=F.col("path"), **fields)))


def keys_of_folder(spark: SparkSession, folder: str, prefix: str, pattern: str = "*", **fields: Column) -> DataFrame:
    """file_keys of the files below a folder; Spark tells their times, contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return file_keys(found.select("path", F.col("modificationTime").alias("modified")), prefix, **fields)


def get(cache: DataFrame, wanted: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(hits, cache): wanted (key, any columns) with their values, and the cache, in which each key that was asked for is
    one access richer and last accessed now."""
    asked = wanted.select("key").distinct().withColumn("__hit", F.lit(True))
    hits = wanted.join(cache.select("key", "value"), "key")
    seen = cache.join(asked, "key", "left")
    out = seen.withColumn("access_count", F.when(F.col("__hit"), F.col("access_count") + 1).otherwise(F.col("access_count"))).withColumn("last_accessed", F.when(F.col("__hit"), now).otherwise(F.col("last_accessed")))
    return hits, out.select(*cache.columns)


def put(cache: DataFrame, new: DataFrame, now: Column, most: float | None = None) -> DataFrame:
    """The cache with new (key, value): the largest value of a repeated key; no access yet. Over `most` bytes the oldest
    go until four fifths of it are left."""
    rows = new.groupBy("key").agg(F.max("value").alias("value"))
    rows = rows.select("key", "value", now.cast("double").alias("created_at"), F.lit(0).cast("long").alias("access_count"), now.cast("double").alias("last_accessed"), F.octet_length("value").cast("long").alias("size_bytes"))
    out = upsert(cache, rows, "key")
    return out if most is None else out.join(evict(out, most).select("key"), "key", "left_anti").select(*cache.columns)


def delete(cache: DataFrame, keys: DataFrame) -> DataFrame:
    return cache.join(keys.select("key"), "key", "left_anti")


def clear(cache: DataFrame, prefix: str | None = None) -> DataFrame:
    """The cache without a prefix's keys; without any where none is named."""
    return cache.limit(0) if prefix is None else cache.where(~F.col("key").startswith(f"{prefix}:"))


def missing(cache: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.join(cache.select("key"), "key", "left_anti")


def computed(cache: DataFrame, wanted: DataFrame, compute: Callable[[DataFrame], DataFrame], now: Column) -> tuple[DataFrame, DataFrame]:
    """(wanted with values, cache): hits come from the cache, misses from compute(misses) -> (key, value) and stay in it."""
    filled = put(cache, compute(missing(cache, wanted)).select("key", "value"), now)
    return get(filled, wanted, now)


def prefix_of(key: Column) -> Column:
    """What stands before the first colon; empty without one."""
    at = F.instr(key, ":")
    return F.substring(key, F.lit(1), F.greatest(at - 1, F.lit(0)))


def totals(cache: DataFrame) -> DataFrame:
    """One row: entries, bytes, megabytes, and mean and largest access count and mean last access (0 when empty)."""
    nought = lambda c: F.coalesce(c, F.lit(0))
    g = cache.agg(F.count("*").alias("entries"), nought(F.sum("size_bytes")).alias("bytes"), nought(F.avg("access_count")).alias("mean_access"), nought(F.max("access_count")).alias("most_access"), nought(F.avg("last_accessed")).alias("mean_last_access"))
    return g.withColumn("megabytes", F.col("bytes") / (1024 * 1024))


def by_prefix(cache: DataFrame) -> DataFrame:
    return cache.groupBy(prefix_of(F.col("key")).alias("prefix")).agg(F.count("*").alias("n"), F.sum("size_bytes").alias("size_bytes"))
