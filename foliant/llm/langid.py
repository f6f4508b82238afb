"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, runs of anything but letters and marks become one blank, and every run of one to four of the
characters left is hashed into a bucket. Counts of buckets by language, over all rows to learn from, are summed in
Spark; their log-probabilities, a matrix of languages and buckets, are broadcast. A batch of texts is a sparse matrix of
texts and buckets, multiplied with it in numpy.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm import hashing as H
from foliant.llm.shards import free_names, give_back, kept, lean

BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
#: Languages that a model takes; each is BUCKETS numbers of four bytes in what is broadcast, 32 MB at most.
MOST_LANGUAGES = 256
#: Added to every count.
SMOOTHING = 0.5
#: What is predicted of texts without a letter.
UNKNOWN = "und"
#: Characters that are looked at together.
STEP = 1 << 19


def held_out(id_col: str, parts: int = 4, part: int = 2) -> Column:
    """Rows that are not learnt from; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


@kept
def kinds() -> np.ndarray:
    """For every code point: 2 a letter, 1 a mark, 0 anything else."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)], np.uint8)


@dataclass
class Grams:
    """Buckets of the n-grams of some texts, one array an order; `buckets` stands for none. Runs of n-grams that begin at
    `starts` are of the texts `owner`. letters: which texts from `first` on have had a letter."""

    buckets: list[np.ndarray]
    starts: np.ndarray
    owner: np.ndarray
    first: int
    letters: np.ndarray


def grams(texts: pa.Array, orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS, step: int = STEP) -> Iterator[Grams]:
    """n-grams of a column of texts, of at most `step` characters at a time; null is empty."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    sizes = pc.utf8_length(low).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    ends = np.cumsum(sizes)
    table, shift, most = kinds(), np.uint64(64 - (buckets - 1).bit_length()), max(orders)
    at = 0
    while at < len(low):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, side="right")))
        whole = " " + "  ".join(low.slice(at, to - at).to_pylist()) + " "
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.arange(at, to, dtype=np.int32), sizes[at:to])
        letters = np.zeros(to - at, bool)
        codes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        blank = False
        for lo in range(0, len(points), step):  # a text may be longer than step
            p, o = points[lo : lo + step], owner[lo : lo + step]
            kind = table[p]
            letters[o[kind == 2] - at] = True
            empty = kind == 0
            again = empty.copy()
            again[1:] &= empty[:-1] & (o[1:] == o[:-1])
            again[0] &= blank and o[0] == owner[lo - 1]
            blank = bool(empty[-1])
            known, stay = len(codes), ~again
            codes = np.concatenate((codes, H.mix(np.where(empty, np.uint32(32), p)[stay].astype(np.uint64) + np.uint64(1))))
            owners = np.concatenate((owners, o[stay]))
            starts, _ = H.runs(owners)
            edges = np.append(starts[1:], len(owners))
            got, h = [], np.zeros(len(codes), np.uint64)
            for n in range(1, most + 1):
                h = h[: max(0, len(codes) - n + 1)] * H.BASES[0] + codes[n - 1 :]
                if n in orders:
                    b = np.full(len(codes), buckets, np.int64)
                    b[: len(h)] = (h * H.BASES[1]) >> shift
                    for back in range(1, n):  # those that reach into the next text
                        b[np.maximum(edges - back, starts)] = buckets
                    b[: max(0, known - n + 1)] = buckets  # given before
                    got.append(b)
            yield Grams(got, starts, owners[starts], at, letters)
            keep = max(0, len(codes) - most + 1)
            codes, owners = codes[keep:], owners[keep:]
        at = to


@dataclass
class Model:
    languages: list[str]
    #: Log-probabilities, buckets by languages, and of the languages themselves.
    matrix: np.ndarray
    prior: np.ndarray


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_languages: int = MOST_LANGUAGES) -> Model:
    """Counts of all rows of docs with a text and a language. The driver gets at most BUCKETS numbers a language; more
    languages than most_languages are an error. No such rows give a model without languages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (n, texts) in held.items():
                i = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(i) + 1), pa.string()), pa.array([-1, *i.tolist()], pa.int64()), pa.array([texts, *n[i].tolist()], pa.int64())], names=["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for lang in pc.unique(batch.column(1)).to_pylist():
                if len(held) >= most_languages and lang not in held:
                    yield from out()
                texts = batch.column(0).filter(pc.equal(batch.column(1), lang))
                n, _ = held.setdefault(lang, [np.zeros(BUCKETS, np.int64), 0])
                held[lang][1] += len(texts)
                for g in grams(texts):
                    for b in g.buckets:
                        n += np.bincount(b, minlength=BUCKETS + 1)[:BUCKETS]
        yield from out()

    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(text_col, lang_col)
    summed = rows.mapInArrow(lean(count, kinds), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = summed.limit((most_languages + 1) * (BUCKETS + 1)).toArrow()
    languages = sorted(set(got.column("lang").to_pylist()))
    if len(languages) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    counts = np.zeros((len(languages), BUCKETS + 1))
    counts[np.searchsorted(np.array(languages, object), np.array(got.column("lang").to_pylist(), object)) if languages else [], got.column("bucket").to_numpy() + 1] = got.column("n").to_numpy()
    del got
    give_back()
    texts, counts = counts[:, 0], counts[:, 1:] + SMOOTHING
    matrix = np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)
    return Model(languages, np.ascontiguousarray(matrix), np.log(texts / max(texts.sum(), 1)))


def score_texts(texts: pa.Array, model: Model) -> tuple[pa.Array, pa.Array]:
    """The likeliest language of each text and its posterior probability; UNKNOWN and 0 for texts without a letter."""
    n, k = len(texts), len(model.languages)
    total, letters = np.tile(model.prior, (n, 1)), np.zeros(n, bool)
    matrix = np.concatenate((model.matrix, np.zeros((1, k), np.float32)))
    for g in grams(texts, step=max(1 << 12, min(STEP, (1 << 22) // max(k, 1)))):
        letters[g.first : g.first + len(g.letters)] |= g.letters
        for b in g.buckets if k else []:
            total[g.owner] += np.add.reduceat(matrix.take(b, axis=0), g.starts, axis=0, dtype=np.float64)
    if not k:
        return pa.array([UNKNOWN] * n, pa.string()), pa.array(np.zeros(n))
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    names = pa.array(model.languages, pa.string()).take(pa.array(best))
    return pc.if_else(pa.array(letters), names, UNKNOWN), pa.array(np.where(letters, share, 0.0))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every column of docs, with lang_pred and score (0 to 1: the posterior probability).

    Whole texts count. A text that is null or has no letter is `und` with score 0, and so is every text if nothing was
    learnt; ties go to the first language by code point. Repeated rows are scored alike, an empty table gives no rows.
    Input columns named as a result get the suffix _in.
    """
    docs = free_names(docs, "lang_pred", "score")
    spread = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MOST_LANGUAGES
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, share = score_texts(batch.column(place), spread.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, lang, share], names=[*batch.schema.names, "lang_pred", "score"])

    fields = [T.StructField(f.name, f.dataType) for f in docs.schema.fields]
    return docs.mapInArrow(lean(run, kinds), T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
