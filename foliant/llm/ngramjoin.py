"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word 5-grams. Copies (equal word sequences) are one class. Classes that agree in a band of
MinHash values form candidate groups, found as components of links to each bucket's smallest class, so no bucket is
expanded into pairs. Within a group, in blocks, MinHash values are compared a few at a time, and a pair is dropped as
soon as the posterior probability that its similarity reaches the threshold falls below the tolerance; the other pairs
are verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm import hashing as H
from foliant.llm import shards as S
from foliant.llm.blocks import in_blocks
from foliant.llm.components import components

WORDS = 5
BANDS, ROWS = 24, 4
STEP = 16
#: Pairs, and grams, that are compared at once.
PAIRS, COLUMNS = 1 << 16, 1024
_RNG = np.random.default_rng(5)
FACTORS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
TERMS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def least_matches(threshold: float, tolerance: float, n: int) -> int:
    """Fewest of n equal MinHash values with which a pair stays. With a uniform prior, the posterior probability of a
    similarity of at least t after m matches is the chance of at most m successes in n + 1 trials of probability t."""
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


class Shingles:
    """Shingle hashes of a batch of texts, document by document; texts without words have none."""

    def __init__(self, batch: pa.RecordBatch, text_col: str):
        data, offsets = S.text_bytes(batch, text_col)
        starts, ends, owner = H.words_of(data, offsets)
        self.codes = H.word_hashes(data, starts, ends)
        self.first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        n = np.diff(self.first)
        grams = np.maximum(n - WORDS + 1, np.minimum(n, 1))
        self.bounds = np.concatenate(([0], np.cumsum(grams)))
        at = np.repeat(self.first[:-1] - self.bounds[:-1], grams) + np.arange(self.bounds[-1])
        sums = H.POWERS[0].prefix(self.codes)
        stop = np.minimum(at + WORDS, np.repeat(self.first[1:], grams))
        self.hashes = H.mix(H.POWERS[0].between(sums, at, stop)) if len(at) else np.zeros(0, np.uint64)
        self.whole = [H.mix(p.between(p.prefix(self.codes), self.first[:-1], self.first[1:]) + n.astype(np.uint64)) for p in H.POWERS] if len(self.codes) else [np.zeros(batch.num_rows, np.uint64)] * 2

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents with words, and their MinHash values."""
        which = np.flatnonzero(np.diff(self.bounds))
        out = np.zeros((len(which), len(FACTORS)), np.uint32)
        if len(which):
            for k, (a, b) in enumerate(zip(FACTORS, TERMS, strict=True)):
                out[:, k] = np.minimum.reduceat((self.hashes * a + b) >> np.uint64(32), self.bounds[which])
        return which, out

    def sets(self) -> list[bytes]:
        return [np.unique(self.hashes[a:b]).tobytes() for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)]


def shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    if len(i) < 64:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    left, at = np.unique(i, return_inverse=True)
    right, to = np.unique(j, return_inverse=True)
    out = np.zeros(len(i), np.int64)
    vocabulary = np.unique(np.concatenate([sets[a] for a in left]))
    columns = [np.searchsorted(vocabulary, sets[a]) for a in left]
    others = []
    for b in right:
        p = np.searchsorted(vocabulary, sets[b])
        p = p[p < len(vocabulary)] if len(p) else p
        s = sets[b][: len(p)]
        others.append(p[vocabulary[p] == s])
    for lo in range(0, len(vocabulary), COLUMNS):
        m = [np.zeros((len(x), COLUMNS), np.float32) for x in (left, right)]
        for dense, each in zip(m, (columns, others), strict=True):
            for r, p in enumerate(each):
                a, b = np.searchsorted(p, (lo, lo + COLUMNS))
                dense[r, p[a:b] - lo] = 1
        out += np.rint((m[0] @ m[1].T)[at, to]).astype(np.int64)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, tolerance: float = 1e-6) -> DataFrame:
    """(id_col, class_id, n_links, kept) for each row of docs.

    Two rows link if the Jaccard similarity of their sets of 5-grams of words (runs of anything but ASCII white space)
    is at least the threshold; a text of fewer words is one gram. n_links counts the other rows that a row links to,
    class_id is the smallest id that links reach, itself included. Null and empty texts link with nothing. Rows that
    repeat an id are one node; rows of null id get a null class. A key that is called as a result gets the suffix _in. A pair at 0.8 is missed with probability 4e-6 in the
    bands, and about the tolerance for each step of the comparison.
    """
    n = S.n_parts(docs)
    steps = [(m, least_matches(threshold, tolerance, m)) for m in range(STEP, BANDS * ROWS + 1, STEP)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "__text"):
                s = Shingles(part, "__text")
                which, values = s.signatures()
                ids = part.column(part.schema.get_field_index("__key")).cast(pa.int64()).take(pa.array(which))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(w[which].view(np.int64)) for w in s.whole), pa.array([v.tobytes() for v in values], pa.binary())], names=["id", "f1", "f2", "sig"])

    slim = docs.select(F.col(id_col).alias("__key"), F.col(text_col).alias("__text"))
    signed = slim.mapInArrow(S.lean(sign), "id long, f1 long, f2 long, sig binary").where("id is not null")
    one = signed.groupBy("f1", "f2").agg(F.min(F.struct("id", "sig")).alias("r"), F.count("*").alias("w"))
    classes = S.checkpoint(one.select("f1", "f2", F.col("r.id").alias("rep"), F.col("r.sig").alias("sig"), "w"))

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, BANDS, ROWS).astype(np.uint64)
                key = np.zeros(sig.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    key = H.mix(key * H.BASES[0] + sig[:, :, r])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)), pa.array(key.view(np.int64).ravel())], names=["rep", "key"])

    narrow = classes.select("rep", "sig").mapInArrow(S.lean(bands), "rep long, key long")
    firsts = narrow.groupBy("key").agg(F.min("rep").alias("m"), F.max("rep").alias("x")).where("m < x").select("key", "m")
    groups = components(narrow.join(firsts, "key").where("rep <> m").select(F.col("rep").alias("a"), F.col("m").alias("b")))
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    groups = groups.join(groups.groupBy("root").agg(F.count("*").alias("size")), "root")
    seen = classes.select("rep", "f1", "f2", "sig", "w").join(groups, F.col("rep") == F.col("node")).drop("node")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rep", "root", "size", "w", "sig"]
        for batch in batches:
            for part in pieces(batch, "__text"):
                s = Shingles(part, "__text")
                same = [part.column(part.schema.get_field_index(c)).to_numpy() == w.view(np.int64) for c, w in zip(("f1", "f2"), s.whole, strict=True)]
                out = pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names), pa.array(s.sets(), pa.binary())], names=[*names, "grams"])
                yield out.filter(pa.array(same[0] & same[1]))

    rows = slim.join(seen, F.col("__key").cast("long") == F.col("rep")).select("rep", "root", "size", "w", "sig", "f1", "f2", "__text").mapInArrow(S.lean(to_sets), "rep long, root long, size long, w long, sig binary, grams binary")

    def compare(t: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(t.num_rows, BANDS * ROWS)
        alive = []
        for at in range(0, len(i), PAIRS):
            live = np.arange(at, min(at + PAIRS, len(i)))
            matches = np.zeros(len(live), np.int64)
            for m, least in steps:
                matches = matches + (sig[i[live], m - STEP : m] == sig[j[live], m - STEP : m]).sum(axis=1)
                stay = matches >= least
                live, matches = live[stay], matches[stay]
            alive.append(live)
        live = np.concatenate(alive)
        hit = np.zeros(len(i), bool)
        if len(live):
            need = np.unique(np.concatenate((i[live], j[live])))
            sets: list = [None] * t.num_rows
            for r in need.tolist():
                sets[r] = np.frombuffer(t.column("grams")[r].as_py(), np.uint64)
            sizes = np.array([0 if s is None else len(s) for s in sets])
            both = shared(sets, i[live], j[live])
            hit[live] = both >= threshold * (sizes[i[live]] + sizes[j[live]] - both) - 1e-9
        return hit

    found = S.checkpoint(in_blocks(rows, "root", "size", "rep", compare, "w", n, 1024))
    roots = components(found.select("a", "b")).withColumnRenamed("node", "rep")
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    known = classes.select("f1", "f2", "rep", "w").join(links, "rep", "left").join(roots, "rep", "left")
    members = signed.select("id", "f1", "f2").join(known, ["f1", "f2"]).groupBy("id").agg(F.max(F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.min(F.coalesce("root", "rep")).alias("class_id"))
    out = slim.select("__key").join(members, F.col("__key").cast("long") == F.col("id"), "left")
    own = F.coalesce("class_id", F.col("__key").cast("long"))
    name = S.free_names(docs.select(id_col), "class_id", "n_links", "kept").columns[0]
    return out.select(F.col("__key").alias(name), own.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(own == F.col("__key"), F.lit(True)).alias("kept"))


def pieces(batch: pa.RecordBatch, text_col: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `most` bytes of text."""
    _, offsets = S.text_bytes(batch, text_col)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
