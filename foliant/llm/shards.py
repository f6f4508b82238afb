"""Shards: batches of whole rows, packed into one binary value each, and the exchange of hash blocks between them.

A text column of any size is cut into shards of about SHARD_BYTES; a shard keeps every column of its rows, so nothing
has to be joined back by a key that may be null or repeated. Operators that look for repeats send *distinct* hashes of
a shard in blocks, one block for each bucket of the hash space, and get one bit or code back for each hash. A hash that
is in every document therefore costs one entry a shard, and no task gathers the rows of a key.
"""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.hashing import bucket_of, runs

SHARD_BYTES = 2 << 20
BLOCKS = "pid long, bucket long, data binary"


def root_dir(spark: SparkSession) -> str:
    """The folder that the session names. Only a session on one machine may name none: its executors share /tmp."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: a folder that all executors share is needed")
    return root or "/tmp/checkpoints/foliant"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which every executor sees; it goes when the driver ends."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{root_dir(spark)}/work-{uuid.uuid4().hex}")
    path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def checkpoint(df: DataFrame) -> DataFrame:
    """df.checkpoint() in the folder that the session names."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root_dir(df.sparkSession))
    return df.checkpoint()


_KEPT: list = []


def kept(make: Callable) -> Callable:
    """make, whose results a worker keeps from task to task, until a task of another operator begins."""
    cached = functools.lru_cache(4)(make)
    _KEPT.append(cached)
    return cached


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *keep: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, before which the worker forgets what other operators kept (all but `keep`), and after which it gives the
    memory it has freed back: workers outlive their tasks."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = [c for c in _KEPT if c not in keep and c.cache_info().currsize]
        for c in others:
            c.cache_clear()
        if others:
            give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def n_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def free_names(df: DataFrame, *names: str) -> DataFrame:
    """Input columns whose names an operator is about to add get the suffix _in."""
    taken = {c.lower() for c in df.columns}
    for name in names:
        if name.lower() in taken:
            new = f"{name}_in"
            while new.lower() in taken:
                new += "_in"
            taken.add(new.lower())
            df = df.withColumnRenamed(name, new)
    return df


def own_columns(df: DataFrame, *names: str) -> dict[str, Column]:
    """Name -> where an operator that adds these names leaves the input's column."""
    return {old: F.col(f"`{new}`").alias(old) for old, new in zip(df.columns, free_names(df, *names).columns, strict=True)}


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of any types in one value; empty ones too."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        parts += [np.array([len(a)], np.int64).tobytes(), a.dtype.str.ljust(8).encode(), np.ascontiguousarray(a).tobytes()]
    return b"".join(parts)


def unpack(data: bytes) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for _ in range(n):
        size = int(np.frombuffer(data, np.int64, 1, at)[0])
        kind = np.dtype(data[at + 8 : at + 16].decode().strip())
        out.append(np.frombuffer(data, kind, size, at + 16))
        at += 16 + size * kind.itemsize
    return out


def write_blob(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_blob(blob: bytes | np.ndarray) -> pa.RecordBatch:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_next_batch()


def text_bytes(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one text after another, and the n + 1 offsets; null is empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) else b"")
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offsets = np.frombuffer(col.buffers()[1], wide, len(col) + 1, col.offset * np.dtype(wide).itemsize).astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(col) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def order_keys(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """Document ids for comparing places; null comes last."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.int64())
    return pc.fill_null(col, np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def cut(batches: Iterator[pa.RecordBatch], id_col: str, text_col: str, most: int = SHARD_BYTES) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Numbered shards of one partition, each in ascending id order."""
    part, k, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

    def shard() -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        batch = t.to_batches()[0]
        return batch.take(pc.sort_indices(batch.column(batch.schema.get_field_index(id_col)).cast(pa.int64())))

    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch, text_col)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most - size, side="right")) - 1
            to = min(max(to, at + (not held)), batch.num_rows)
            if to > at:
                held.append(batch.slice(at, to - at))
                size += int(offsets[to] - offsets[at])
            if to < batch.num_rows or size >= most:
                yield part | k, shard()
                k, held, size = k + 1, [], 0
            at = to
    if held:
        yield part | k, shard()


def to_blocks(pid: int, hashes: np.ndarray, n: int, *more: np.ndarray) -> tuple[np.ndarray, list[dict]]:
    """Order that deals hashes into n buckets, keeping their order in each, and the blocks (hashes, more...)."""
    b = bucket_of(hashes, n)
    order = np.argsort(b.astype(np.uint16) if n < 65536 else b, kind="stable")
    b = b[order]
    at, size = runs(b)
    rows = []
    for i, m in zip(at.tolist(), size.tolist(), strict=True):
        o = order[i : i + m]
        rows.append({"pid": pid, "bucket": int(b[i]), "data": pack(hashes[o], *(x[o] for x in more))})
    return order, rows


def answers(reply, order: np.ndarray, kind: type = np.uint8) -> np.ndarray:
    """The codes sent back for the hashes of a shard, in the shard's own order. reply: list of {bucket, data}."""
    out = np.zeros(len(order), kind)
    if len(order):
        out[order] = np.concatenate([np.frombuffer(r["data"], kind) for r in sorted(reply, key=lambda r: r["bucket"])])
    return out


def table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


BLOCK_SCHEMA = pa.schema([("pid", pa.int64()), ("bucket", pa.int64()), ("data", pa.binary())])


def judged(blocks: DataFrame, judge: Callable[[np.ndarray, list[np.ndarray]], np.ndarray], n: int) -> DataFrame:
    """Bring the blocks of each bucket together and send each shard its codes: rows (pid, reply).

    judge(pid of each entry, columns of entries) gives a code (uint8 or uint16) for each entry; the entries of one bucket, at most one
    for each distinct hash and shard, are judged together.
    """

    def reduce(batches):
        by: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                by.setdefault(row["bucket"], []).append((row["pid"], unpack(row["data"])))
        for bucket, got in by.items():
            sizes = [len(x[1][0]) for x in got]
            codes = judge(np.repeat([x[0] for x in got], sizes), [np.concatenate(c) for c in zip(*(x[1] for x in got), strict=True)])
            ends = np.cumsum(sizes)
            yield table([{"pid": p, "bucket": bucket, "data": codes[e - s : e].tobytes()} for (p, _), e, s in zip(got, ends.tolist(), sizes, strict=True)], BLOCK_SCHEMA)

    replies = blocks.repartition(n, "bucket").mapInArrow(lean(reduce), BLOCKS)
    return replies.groupBy("pid").agg(F.collect_list(F.struct("bucket", "data")).alias("reply"))


def seen_elsewhere(pids: np.ndarray, cols: list[np.ndarray]) -> np.ndarray:
    """1 for a hash that more than one shard sent, or that one sent with a local count above one."""
    hashes, many = cols
    order = np.argsort(hashes, kind="stable")
    at, size = runs(hashes[order])
    hit = (size > 1) | (np.maximum.reduceat(many[order], at) > 0 if len(at) else np.zeros(0, bool))
    out = np.zeros(len(hashes), np.uint8)
    out[order] = np.repeat(hit, size)
    return out


def shard_and_seed(docs: DataFrame, id_col: str, text_col: str, seeds: Callable[[pa.RecordBatch], np.ndarray | tuple[np.ndarray, list[np.ndarray]]], n: int, most: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """One pass over docs writes its shards (pid, blob) and the distinct seed hashes of each; returns the shards and,
    for each, which seeds occur anywhere else (pid, reply). Where seeds() gives arrays with the hashes, a shard's blob
    is packed with them."""
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession)

    def first(batches):
        for pid, batch in cut(batches, id_col, text_col, most):
            got, blob = seeds(batch), write_blob(batch)
            if isinstance(got, tuple):
                got, arrays = got
                blob = pack(np.frombuffer(blob, np.uint8), *arrays)
            rows = [{"pid": pid, "bucket": -1, "data": blob}]
            h, c = np.unique(got, return_counts=True)
            rows += to_blocks(pid, h, n, (c > 1).astype(np.uint8))[1]
            for row in rows:
                yield table([row], BLOCK_SCHEMA) if row["bucket"] < 0 else row
            del rows

    def flat(batches):
        held = []
        for x in first(batches):
            if isinstance(x, dict):
                held.append(x)
            else:
                if held:
                    yield table(held, BLOCK_SCHEMA)
                held = []
                yield x
        if held:
            yield table(held, BLOCK_SCHEMA)

    docs.mapInArrow(lean(flat), BLOCKS).withColumn("kind", F.when(F.col("bucket") < 0, "shard").otherwise("seed")).write.partitionBy("kind").option("compression", "none").parquet(path)
    schema = "pid long, bucket long, data binary, kind string"
    read = spark.read.schema(schema).parquet(path)
    seeds_df = read.where("kind = 'seed'").select("pid", "bucket", "data")
    shards = read.where("kind = 'shard'").select("pid", F.col("data").alias("blob"))
    return shards, checkpoint(judged(seeds_df, seen_elsewhere, n))
