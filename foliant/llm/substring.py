"""Substring dedup by seed and extend: winnowed anchors are the seeds, repeats are extended to whole windows of words.

Every window of `window` words holds at least one winnowed anchor (the smallest hash of its word k-grams), picked by
the window's own words, so equal windows share their anchor. Anchors that occur once in the corpus cannot be in a
repeat and go first, with all their windows. Around the others the match is extended both ways, to each window the
anchor stands for; of equal windows the earliest (smaller id, then earlier start) stays, all words under any later
one go, and neighbouring windows join to maximal repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from foliant.llm import hashing as H
from foliant.llm import shards as S

ANCHOR_WORDS = 8


class Words:
    """Words, windows and anchors of a shard."""

    def __init__(self, batch: pa.RecordBatch, text_col: str, window: int):
        k = min(ANCHOR_WORDS, window)
        self.data, self.offsets = S.text_bytes(batch, text_col)
        self.starts, self.ends, self.owner = H.words_of(self.data, self.offsets)
        self.codes = H.word_hashes(self.data, self.starts, self.ends)
        n = len(self.codes)
        self.windows = np.flatnonzero(self.owner[window - 1 :] == self.owner[: n - window + 1]) if n >= window else np.zeros(0, np.int64)
        grams = H.window_hashes(self.codes, np.arange(max(0, n - k + 1)), k, both=False)[0]
        at = H.winnow(grams, window - k + 1)[self.windows]
        first, self.run = H.runs(at)
        self.anchors = H.mix(grams[at[first]])  # smallest hashes are alike; mixed, they spread over the buckets

    def candidates(self, bits: np.ndarray) -> np.ndarray:
        """Windows whose anchor occurs anywhere else. bits: one for each distinct anchor, ascending."""
        distinct, place = np.unique(self.anchors, return_inverse=True)
        return self.windows[np.repeat(bits[place].astype(bool), self.run)] if len(distinct) else self.windows[:0]


def first_of_equals(h1: np.ndarray, h2: np.ndarray, *then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, whether it is the first of its hash by `then`; and the order that groups them."""
    order = np.lexsort((*then[::-1], h2, h1))
    a, b = h1[order], h2[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, bool)
    first = np.zeros(len(h1), bool)
    first[order] = new
    return first, order


def later_copy(pids: np.ndarray, cols: list[np.ndarray]) -> np.ndarray:
    h1, h2, keys = cols
    return (~first_of_equals(h1, h2, keys, pids)[0]).astype(np.uint8)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the n places under any [s, s + width)."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.subtract.at(steps, np.minimum(starts + width, n), 1)
    return np.cumsum(steps[:-1]) > 0


def rejoin(w: Words, keep: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one space."""
    out = w.data.copy()
    s, e, owner = w.starts[keep], w.ends[keep], w.owner[keep]
    steps = np.zeros(len(out) + 1, np.int8)
    joined = np.concatenate((owner[1:] == owner[:-1], [False])) if len(s) else np.zeros(0, bool)
    out[e[joined]] = 32  # the byte after a word that isn't its text's last is white space
    steps[s] = 1
    steps[e + joined] -= 1
    mask = np.cumsum(steps[:-1], dtype=np.int8) > 0
    total = np.concatenate(([0], np.cumsum(mask)))
    return pa.Array.from_buffers(pa.string(), len(w.offsets) - 1, [None, pa.py_buffer(total[w.offsets].astype(np.int32).tobytes()), pa.py_buffer(out[mask].tobytes())])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Every column of docs, with kept_text, n_words and n_removed.

    Words are runs of anything but ASCII white space, unchanged. A word goes if a window of `window` words over it
    has the same words as one that starts earlier: in a row of smaller id, or earlier in the same row. Rows with equal
    ids come in the order in which they are read, null ids last; a null text is empty; an empty text, or one of less
    than a window, keeps all its words. Input columns named as a result get the suffix _in. Windows are compared by
    two independent 64-bit hashes, and only where 64-bit hashes of their anchors agree.
    """
    docs = S.free_names(docs, "kept_text", "n_words", "n_removed")
    n = S.n_parts(docs)
    shards, seeds = S.shard_and_seed(docs, id_col, text_col, lambda b: Words(b, text_col, window).anchors, n)

    def local(blob, seed_reply):
        """The shard's candidate windows, their hashes, and which of them to send."""
        batch = S.read_blob(blob)
        w = Words(batch, text_col, window)
        distinct = np.unique(w.anchors)
        order = np.argsort(H.bucket_of(distinct, n), kind="stable")
        cand = w.candidates(S.answers(seed_reply or [], order))
        h1, h2 = H.window_hashes(w.codes, cand, window)
        first, order = first_of_equals(h1, h2, cand)
        return batch, w, cand, h1, h2, first, order

    def extend(batches):
        for b in batches:
            for row in b.to_pylist():
                batch, w, cand, h1, h2, first, _ = local(row["blob"], row["seeds"])
                keys = S.order_keys(batch, id_col)[w.owner[cand[first]]] if len(cand) else np.zeros(0, np.int64)
                rows = S.to_blocks(row["pid"], h1[first], n, h2[first], keys)[1]
                if rows:
                    yield S.table(rows, S.BLOCK_SCHEMA)

    schema = T.StructType([*docs.schema.fields, T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def finish(batches):
        for b in batches:
            for row in b.to_pylist():
                batch, w, cand, h1, h2, first, order = local(row["blob"], row["seeds"])
                sent = np.argsort(H.bucket_of(h1[first], n), kind="stable")
                gone = ~first
                gone[np.flatnonzero(first)] = S.answers(row["reply"] or [], sent).astype(bool)
                lost = covered(cand[gone], window, len(w.codes))
                count = lambda owner: pa.array(np.bincount(owner, minlength=batch.num_rows).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, rejoin(w, ~lost), count(w.owner), count(w.owner[lost])], names=[*batch.schema.names, "kept_text", "n_words", "n_removed"])

    seeded = shards.join(seeds.withColumnRenamed("reply", "seeds"), "pid", "left")
    replies = S.judged(seeded.mapInArrow(S.lean(extend), S.BLOCKS), later_copy, n)
    return seeded.join(replies, "pid", "left").select("pid", "blob", "seeds", "reply").mapInArrow(S.lean(finish), schema)
