"""Near pairs of 64-bit hashes: an index of band combinations, met in blocks of numbers."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a key that one task compares at once, rows of whole keys that are held, and rows that are compared one by one.
BLOCK, HELD, SMALL, ALL = 1 << 18, 200_000, 64, 512
BITS = 64


def bands_for(n: int, most: int) -> int:
    """How many bands a key is made of, for n hashes: what makes the fewest copies. Of most + k bands, hashes that differ in
    at most `most` bits have k alike; a hash is copied for each k of them, and for each chunk of a key's hashes."""
    copies = lambda k: math.comb(most + k, k) * max(1, n / 2 ** (BITS * k / (most + k)) / BLOCK)
    return min(range(1, 7), key=copies)


class Bands:
    """most + k bands of the given bits, dealt in turn so that bits that never change are spread."""

    def __init__(self, most: int, k: int, places: tuple[int, ...] = tuple(range(BITS))):
        self.bits = [places[i :: most + k] for i in range(most + k)]
        self.masks = np.array([sum(1 << b for b in p) for p in self.bits], np.uint64)
        self.keys = list(combinations(range(most + k), k))
        self.chosen = np.array([sum(1 << b for b in c) for c in self.keys], np.int64)
        self.width = max(sum(len(self.bits[b]) for b in c) for c in self.keys)
        self.k = k

    def values(self, h: np.ndarray) -> list[np.ndarray]:
        """Each band's bits as a number."""
        out = []
        for places in self.bits:
            v = np.zeros(len(h), np.uint64)
            for b in places:
                v = v << np.uint64(1) | (h >> np.uint64(b)) & np.uint64(1)
            out.append(v)
        return out

    def joined(self, values: list[np.ndarray], c: tuple[int, ...]) -> np.ndarray:
        """A combination's bits as a number."""
        v = np.zeros(len(values[0]), np.uint64)
        for b in c:
            v = v << np.uint64(len(self.bits[b])) | values[b]
        return v

    def keys_of(self, h: np.ndarray) -> np.ndarray:
        """One number for each hash and combination: the combination's place and its bands' bits."""
        one = self.values(h)
        return np.stack([self.joined(one, c).view(np.int64) | i << self.width for i, c in enumerate(self.keys)], axis=1)

    def first(self, x: np.ndarray) -> np.ndarray:
        """The first combination of bands that pairs of hashes with these differences have alike, as a set of bits."""
        alike = (x[:, None] & self.masks) == 0
        alike &= np.cumsum(alike, axis=1) <= self.k
        return (alike.astype(np.int64) << np.arange(len(self.masks))).sum(axis=1)


def near_within(h: np.ndarray, places: tuple[int, ...], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, difference) of the pairs of hashes, which differ in the given bits only, within `most` bits, each once. Hashes
    are sorted by each combination of bands of those bits, and those with equal ones compared; a sort costs about as much
    as five comparisons."""
    n = len(h)
    k = min(range(1, 5), key=lambda k: math.comb(most + k, k) * (5 + n / 2 ** (len(places) * k / (most + k))))
    inner, bits = Bands(most, k, places), np.uint64(n.bit_length())
    one, at = inner.values(h), np.arange(n, dtype=np.uint64)
    for c, chosen in zip(inner.keys, inner.chosen, strict=True):
        both = np.sort(inner.joined(one, c) << bits | at)
        order, key = (both & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64), both >> bits
        hs, live, step = h[order], np.arange(n), 1
        while True:
            live = live[live + step < n]
            live = live[key[live] == key[live + step]]
            if not len(live):
                break
            x = hs[live] ^ hs[live + step]
            near = np.flatnonzero(np.bitwise_count(x) <= most)
            near = near[inner.first(x[near]) == chosen]
            if len(near):
                yield order[live[near]], order[live[near] + step], x[near]
            step += 1


def near_hashes(rows: DataFrame, id_col: str, hash_col: str, most: int = 8) -> DataFrame:
    """(a, b, distance) of the smallest ids of different 64-bit hashes within a Hamming distance of `most`.

    Equal hashes are one class first, so copies don't multiply. Hashes are split into most + k bands; a pair has k of them
    alike and counts in the first such combination only. A key of many rows is dealt into chunks, every two of which are
    compared by themselves, by combinations of the other bits within the task. Null hashes pair with nothing; ids are
    whole numbers."""
    reps = rows.where(F.col(hash_col).isNotNull()).groupBy(F.col(hash_col).cast("long").alias("h")).agg(F.min(id_col).cast("long").alias("id"))
    total = reps.count()
    bands = Bands(most, bands_for(total, most))
    each = len(bands.keys)
    tasks = max(int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")), total * each // BLOCK)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, HELD // each)):
                part = batch.slice(at, max(1, HELD // each))
                h = part.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(bands.keys_of(h.view(np.uint64)).ravel()), pa.array(np.repeat(h, each)), pa.array(np.repeat(part.column(1).to_numpy(), each))], names=["key", "h", "id"])

    keyed = reps.mapInArrow(spread, "key long, h long, id long")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    dealt = keyed.join(shared, "key").withColumn("chunks", F.ceil(F.col("n") / BLOCK)).withColumn("c", F.pmod(F.xxhash64("id"), F.col("chunks")))
    dealt = dealt.withColumn("d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = dealt.select("key", F.least("c", "d").alias("lo"), F.greatest("c", "d").alias("hi"), "c", "h", "id").repartition(tasks, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "distance")])

    def pairs(t: list[np.ndarray], i: np.ndarray, j: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, lo, hi, c, _, ids = t
        good = (lo[i] == hi[i]) | (c[i] != c[j])
        i, j, x = i[good], j[good], x[good]
        good = bands.first(x) == bands.chosen[key[i] >> bands.width]
        i, j, x = i[good], j[good], x[good]
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j])), pa.array(np.bitwise_count(x).astype(np.int64))], names=["a", "b", "distance"])

    def judge(t: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """t: key, lo, hi, c, h, id of whole groups."""
        h = t[4].view(np.uint64)
        new = np.concatenate(([True], np.any([a[1:] != a[:-1] for a in t[:3]], axis=0)))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(h)))
        end = np.repeat(starts + sizes, sizes)
        live = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
        for step in range(1, SMALL):
            live = live[live + step < end[live]]
            if not len(live):
                break
            x = h[live] ^ h[live + step]
            near = np.bitwise_count(x) <= most
            yield from pairs(t, live[near], live[near] + step, x[near])
        for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
            if n > ALL:
                alike = int(np.bitwise_or.reduce([bands.masks[b] for b in bands.keys[t[0][s] >> bands.width]]))
                for i, j, x in near_within(h[s : s + n], tuple(b for b in range(BITS) if not alike >> b & 1), most):
                    yield from pairs(t, i + s, j + s, x)
                continue
            for at in range(0, n, 256):
                x = h[s + at : min(s + at + 256, s + n), None] ^ h[s : s + n]
                i, j = np.nonzero(np.bitwise_count(x) <= most)
                later = j > i + at
                i, j = i[later], j[later]
                yield from pairs(t, i + s + at, j + s, x[i, j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
            if size > HELD:
                t = [np.concatenate(c) for c in zip(*held, strict=True)]
                last = np.flatnonzero(np.any([a[1:] != a[:-1] for a in t[:3]], axis=0))
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield from judge([a[:cut] for a in t])
                held, size = [[a[cut:] for a in t]], size - cut
        if size:
            yield from judge([np.concatenate(c) for c in zip(*held, strict=True)])

    return dealt.mapInArrow(run, schema)
