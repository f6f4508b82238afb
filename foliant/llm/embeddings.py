"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised; each table quantises several random projections, (a.v + b) / width rounded down, and vectors
whose quantised values all agree share a bucket. Pairs of a bucket are checked by cosine in double precision. With
the default tables a pair at the threshold shares no bucket with probability below 1e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm import hashing as H
from foliant.llm.blocks import in_blocks
from foliant.llm.components import components
from foliant.llm.shards import checkpoint, free_names, n_parts


def quantised(vectors: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """One 31-bit key for each vector and table."""
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((vectors.shape[1], tables * projections))
    b = rng.uniform(0, width, tables * projections)
    cells = np.floor((vectors @ a + b) / width).astype(np.int64).astype(np.uint64).reshape(len(vectors), tables, projections)
    key = np.zeros(cells.shape[:2], np.uint64)
    for p in range(projections):
        key = H.mix(key * H.BASES[0] + cells[:, :, p])
    return (key >> np.uint64(33)).astype(np.int32)


def dedup_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", threshold: float = 0.98, tables: int = 40, projections: int = 14, width: float = 2.0, seed: int = 11) -> DataFrame:
    """Every column of vectors, with n_links, component_id and kept.

    Only rows of equal, non-null labels are compared (label_col None: all). A vector that is null, empty, zero or holds
    a null or non-finite component links with nothing; vectors of different lengths don't link. n_links counts the
    other rows at cosine >= threshold, component_id is the smallest id that links reach (itself included). Equal
    vectors are judged once and counted as often as they occur. Rows of equal ids are one node of the components. Null
    ids get a null component. Input columns named as a result get the suffix _in.
    """
    named = dict(zip(vectors.columns, free_names(vectors, "n_links", "component_id", "kept").columns, strict=True))
    vectors = free_names(vectors, "n_links", "component_id", "kept")
    id_col, vector_col, label_col = named[id_col], named[vector_col], label_col and named[label_col]
    n = n_parts(vectors)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_pylist()
            got: list = [(None, None, None)] * len(rows)
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(rows):
                if v:
                    by_length.setdefault(len(v), []).append(i)
            for length, which in by_length.items():
                m = np.array([[np.nan if x is None else x for x in rows[i]] for i in which], np.float64) + 0.0
                big = np.abs(m).max(axis=1, keepdims=True)
                ok = np.isfinite(m).all(axis=1) & (big[:, 0] > 0)
                m, which = m[ok] / big[ok], [i for i, o in zip(which, ok.tolist(), strict=True) if o]
                if not which:
                    continue
                m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
                code = H.mix(m.view(np.uint64) + np.uint64(1))
                powers = H.POWERS[0].low[0][np.arange(length) & 65535], H.POWERS[1].low[0][np.arange(length) & 65535]
                h = [H.mix((code * p).sum(axis=1, dtype=np.uint64) + np.uint64(length)).view(np.int64) for p in powers]
                k = quantised(m, tables, projections, width, seed + length)
                for i, x, y, z in zip(which, h[0].tolist(), h[1].tolist(), range(len(which)), strict=True):
                    got[i] = (x, y, (k[z].tobytes(), m[z].tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()), *(pa.array([g[2] and g[2][p] for g in got], pa.binary()) for p in (0, 1))], names=[*batch.schema.names[1:], "__h1", "__h2", "__keys", "__unit"])

    label = F.xxhash64(F.col(label_col)) if label_col else F.lit(0).cast("long")
    usable = F.col(label_col).isNotNull() if label_col else F.lit(True)
    slim = vectors.select(F.when(usable, F.col(vector_col)).alias("__v"), F.col(id_col).cast("long").alias("__id"), label.alias("__label"))
    fields = [T.StructField("__id", T.LongType()), T.StructField("__label", T.LongType()), T.StructField("__h1", T.LongType()), T.StructField("__h2", T.LongType()), T.StructField("__keys", T.BinaryType()), T.StructField("__unit", T.BinaryType())]
    hashed = checkpoint(slim.mapInArrow(keys, T.StructType(fields)).where("__h1 is not null and __id is not null"))
    one = hashed.groupBy("__label", "__h1", "__h2").agg(F.min(F.struct("__id", "__keys", "__unit")).alias("r"), F.count("*").alias("__w"))
    reps = checkpoint(one.select("__label", "__h1", "__h2", F.col("r.__id").alias("__rep"), F.col("r.__keys").alias("__keys"), F.col("r.__unit").alias("__unit"), "__w"))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int32).reshape(batch.num_rows, tables).astype(np.uint64)
            label = batch.column(1).to_numpy().view(np.uint64)
            key = H.mix(H.mix(label)[:, None] + k * H.BASES[0] + np.arange(tables, dtype=np.uint64) * H.BASES[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), tables)), pa.array(key.view(np.int64).ravel()), pa.array(np.tile(np.arange(tables, dtype=np.int32), batch.num_rows))], names=["__rep", "__key", "__t"])

    narrow = reps.select("__rep", "__label", "__keys").mapInArrow(buckets, "__rep long, __key long, __t int")
    shared = narrow.groupBy("__key").agg(F.count("*").alias("__n")).where("__n > 1")
    rows = narrow.join(shared, "__key").join(reps.select("__rep", "__keys", "__unit", "__w"), "__rep")

    def compare(t: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Cosine; a pair counts in the first of its common tables only."""
        k = np.frombuffer(b"".join(t.column("__keys").to_pylist()), np.int32).reshape(t.num_rows, tables)
        m = np.frombuffer(b"".join(t.column("__unit").to_pylist()), np.float64).reshape(t.num_rows, -1)
        near = np.einsum("ij,ij->i", m[i], m[j]) >= threshold
        first = np.zeros(len(i), bool)
        at = np.flatnonzero(near)
        first[at] = (k[i[at]] == k[j[at]]).argmax(axis=1) == t.column("__t")[0].as_py()
        return first

    found = checkpoint(in_blocks(rows, "__key", "__n", "__rep", compare, "__w", n))
    roots = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("__rep")).agg(F.sum("links").alias("__links"))
    classes = reps.select("__label", "__h1", "__h2", "__rep", "__w").join(links, "__rep", "left").join(roots.withColumnRenamed("node", "__rep"), "__rep", "left")
    members = hashed.select("__id", "__label", "__h1", "__h2").join(classes, ["__label", "__h1", "__h2"]).select("__id", (F.col("__w") - 1 + F.coalesce("__links", F.lit(0))).alias("n_links"), F.coalesce("root", "__rep").alias("component_id"))
    members = members.groupBy("__id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = vectors.join(members, F.col(id_col) == F.col("__id"), "left").drop("__id")
    own = F.coalesce("component_id", F.col(id_col).cast("long"))
    return out.withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long")).withColumn("component_id", own).withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))
