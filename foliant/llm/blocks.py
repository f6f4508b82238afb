"""All pairs within groups, in blocks of bounded size, without a row for each pair.

Groups beyond a block's rows are dealt into chunks, and every pair of chunks becomes a task of its own; a row goes to as
many tasks as its group has chunks. What comes out of a block is a row or two for each of its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.shards import lean

BLOCK = 2048
FOUND = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("links", T.LongType())])


def in_blocks(rows: DataFrame, group: str, size: str, id_col: str, compare: Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray], weight: str, n: int, block: int = BLOCK) -> DataFrame:
    """(a, b, links): links is the weight that row a is linked to in one block; b is the smallest row it reaches there.

    compare(block, i, j) says for pairs of rows of a block which are links. The column `size` holds a group's rows.
    Rows of equal ids count once.
    """
    many = F.ceil(F.col(size) / block)
    chunk = F.pmod(F.xxhash64(id_col, F.lit(7)), many)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), many - 1))
    rows = rows.withColumn("__c", chunk).withColumn("__d", other)
    rows = rows.withColumn("__lo", F.least("__c", "__d")).withColumn("__hi", F.greatest("__c", "__d")).drop("__d", size)
    rows = rows.repartition(n, group, "__lo", "__hi").sortWithinPartitions(group, "__lo", "__hi")

    def judge(t: pa.Table) -> pa.RecordBatch | None:
        if t.num_rows < 2:
            return None
        _, once = np.unique(t.column(id_col).to_numpy(), return_index=True)
        t = t.take(once) if len(once) < t.num_rows else t
        ids, w, c = (t.column(x).to_numpy() for x in (id_col, weight, "__c"))
        cross = t.column("__lo")[0].as_py() != t.column("__hi")[0].as_py()
        links, root = np.zeros(len(ids), np.int64), ids.copy()
        small = np.min_scalar_type(len(ids))
        got = []
        for at in range(0, len(ids), 256):
            i, j = np.nonzero(np.arange(at, min(at + 256, len(ids)))[:, None] < np.arange(len(ids)))
            i += at
            if cross:
                keep = c[i] != c[j]
                i, j = i[keep], j[keep]
            if len(i):
                hit = compare(t, i, j)
                i, j = i[hit], j[hit]
                np.add.at(links, i, w[j])
                np.add.at(links, j, w[i])
                got.append((i.astype(small), j.astype(small)))
        while True:
            before = root.copy()
            for i, j in got:
                np.minimum.at(root, i, root[j])
                np.minimum.at(root, j, root[i])
            if (root == before).all():
                break
        k = np.flatnonzero(links)
        if not len(k):
            return None
        return pa.RecordBatch.from_arrays([pa.array(ids[k]), pa.array(root[k]), pa.array(links[k])], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(batch.schema.get_field_index(x)).to_numpy(zero_copy_only=False) for x in (group, "__lo", "__hi")]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            cuts = [0, *new.tolist(), batch.num_rows]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(s, e - s)
                if held and any(held[0].column(held[0].schema.get_field_index(x))[0] != part.column(part.schema.get_field_index(x))[0] for x in (group, "__lo", "__hi")):
                    if (out := judge(pa.Table.from_batches(held).combine_chunks())) is not None:
                        yield out
                    held = []
                held.append(part)
        if held and (out := judge(pa.Table.from_batches(held).combine_chunks())) is not None:
            yield out

    return rows.mapInArrow(lean(run), FOUND)
