"""Exact nearest vectors by cosine: blocks of near vectors, left out where no angle within them is small enough."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliant.session import shared_dir

#: Rows of a block of vectors and of queries, rows a pivot has, and most pivots.
BLOCK, ASKED, A_PIVOT, MOST_PIVOTS = 2048, 256, 512, 64
#: Blocks of vectors and of queries that meet in one group.
HELD_TOGETHER, ASKED_TOGETHER = 32, 128
#: Angles and products of vectors of length one are rounded by less.
SLACK = 1e-6


def _matrices(vectors: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length -> (places, matrix) of the vectors that are not empty and hold no null."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    values, gone = flat.cast(pa.float64()).to_numpy(zero_copy_only=False), flat.is_null().to_numpy(zero_copy_only=False)
    starts, out = np.cumsum(lengths) - lengths, {}
    for n in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == n)
        at = starts[rows][:, None] + np.arange(n)
        good = ~gone[at].any(axis=1)
        out[n] = rows[good], values[at[good]]
    return out


def _scores(queries: pa.ListArray, vectors: pa.ListArray) -> np.ndarray:
    """Cosines, added up in the order of the dimensions so that equal vectors score alike; 0 where there is none."""
    out, q, v = np.zeros((len(queries), len(vectors))), _matrices(queries), _matrices(vectors)
    with np.errstate(all="ignore"):
        for n in q.keys() & v.keys():
            (qi, a), (vi, b) = q[n], v[n]
            dot, na, nb = np.zeros((len(qi), len(vi))), np.zeros(len(qi)), np.zeros(len(vi))
            for d in range(n):
                dot += a[:, d, None] * b[:, d]
                na += a[:, d] * a[:, d]
                nb += b[:, d] * b[:, d]
            norms = np.sqrt(na)[:, None] * np.sqrt(nb)
            out[np.ix_(qi, vi)] = np.where(norms == 0, 0.0, dot / norms)
    return out


def _angles(vectors: pa.ListArray, pivots: np.ndarray) -> np.ndarray:
    """Angles to the pivots; nan for vectors of no direction or of another length."""
    out = np.full((len(vectors), len(pivots)), np.nan)
    with np.errstate(all="ignore"):
        for n, (rows, m) in _matrices(vectors).items():
            if len(pivots) and n == pivots.shape[1]:
                m = m / np.sqrt((m * m).sum(axis=1, keepdims=True))
                out[rows] = np.arccos(np.clip(m @ pivots.T, -1, 1))
    return out


def _near(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """rows (id, e) with the nearest pivot (-1: none) and the angle to it."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = _angles(batch.column(1), pivots)
            none = np.isnan(a).any(axis=1) if len(pivots) else np.ones(len(a), bool)
            best = np.where(none, -1, np.where(none[:, None], 0, a).argmin(axis=1) if len(pivots) else -1)
            angle = np.where(none, 0.0, a[np.arange(len(a)), best] if len(pivots) else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.astype(np.int32)), pa.array(angle)], names=[*names, "pivot", "angle"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("angle", T.DoubleType())]))


def _in_blocks(near: DataFrame, most: int, name: str) -> DataFrame:
    """(name, pivot, lo, hi, ids, es): rows of a pivot in blocks of about `most`, with their least and largest angle."""
    i, e = near.columns[:2]
    sizes = {r.pivot: -(-r.n // most) for r in near.groupBy("pivot").agg(F.count("*").alias("n")).collect()}  # one row a pivot
    many = F.element_at(F.create_map(*(F.lit(x) for p, n in (sizes or {-1: 1}).items() for x in (p, n))), F.col("pivot"))
    chunk = F.pmod(F.xxhash64(i, F.lit(5)), many)
    g = near.groupBy("pivot", chunk.alias("chunk")).agg(F.min("angle").alias("lo"), F.max("angle").alias("hi"), F.collect_list(F.struct(i, e)).alias("rows"))
    return g.select(F.struct("pivot", "chunk").alias(name), "pivot", "lo", "hi", F.col(f"rows.{i}").alias(f"{name}_ids"), F.col(f"rows.{e}").alias(f"{name}_es"))


class _Block:
    """Vectors by length, at length one and as they are, with norms added up in the order of the dimensions. `plain` says
    that every product and sum of them is far from overflow and underflow."""

    def __init__(self, vectors: pa.ListArray) -> None:
        self.vectors, self.n, self.plain, self.of = vectors, len(vectors), True, {}
        with np.errstate(all="ignore"):
            for n, (rows, m) in _matrices(vectors).items():
                square = np.zeros(len(m))
                for d in range(n):
                    square += m[:, d] * m[:, d]
                some = (square > 1e-200) & (square < 1e200)
                self.plain = self.plain and bool((some | ~m.any(axis=1)).all())
                at = np.full(self.n, -1)
                at[rows] = np.arange(len(rows))
                self.of[n] = rows, at, m, np.sqrt(square), m / np.where(some, np.sqrt(square), 1)[:, None]


def _about(q: _Block, v: _Block) -> np.ndarray:
    """Cosines of plain blocks, give or take SLACK: one product of matrices."""
    out = np.zeros((q.n, v.n))
    for n in q.of.keys() & v.of.keys():
        (qi, *_, a), (vi, *_, b) = q.of[n], v.of[n]
        out[np.ix_(qi, vi)] = a @ b.T
    return out


def _exact(q: _Block, v: _Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The cosines of _scores for the pairs i, j alone."""
    out = np.zeros(len(i))
    for n in q.of.keys() & v.of.keys():
        (_, qa, a, na, _), (_, va, b, nb, _) = q.of[n], v.of[n]
        both = np.flatnonzero((qa[i] >= 0) & (va[j] >= 0))
        for lo in range(0, len(both), 1 << 14):
            some = both[lo : lo + (1 << 14)]
            x, y = qa[i[some]], va[j[some]]
            left, right, dot, norms = a[x].T.copy(), b[y].T.copy(), np.zeros(len(some)), na[x] * nb[y]
            for d in range(n):
                dot += left[d] * right[d]
            out[some] = np.where(norms == 0, 0.0, dot / np.where(norms == 0, 1, norms))
    return out


def _top(q: _Block, v: _Block, place: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of each query's k best of a block, none of them below its floor (nan: none known). Those that
    can be among them by the product of matrices are scored in the order of the dimensions."""
    most = min(k, v.n)
    kth = lambda s: np.partition(s, v.n - most, axis=1)[:, v.n - most]
    if q.plain and v.plain:
        about, least = _about(q, v), np.where(np.isnan(floors), -np.inf, floors) - SLACK
        may = about >= least[:, None]
        if np.count_nonzero(may) > 2 * most * q.n:
            may = about >= np.maximum(least, kth(about) - SLACK)[:, None]
        i, j = np.nonzero(may)
        score = _exact(q, v, i, j)
    else:
        all_ = _scores(q.vectors, v.vectors)
        keys = np.where(np.isnan(all_), np.inf, all_)
        i, j = np.nonzero(keys >= kth(keys)[:, None])
        score = all_[i, j]
    nan = np.isnan(score)
    order = np.lexsort((place[j], -np.where(nan, np.inf, score), ~nan, i))
    i, j, score = i[order], j[order], score[order]
    good = (np.arange(len(i)) - np.searchsorted(i, i) < most) & ~(score < floors[i])
    return i[good], j[good], score[good]


def _best(pairs: DataFrame, asked: DataFrame, held: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    """The k best vectors of each block pair's queries. pairs: (q, v); asked: (q, q_ids, q_es, floors); held: (v, v_ids,
    v_es). Blocks meet by groups of both, so that a block travels once to a group and not to each of its pairs."""
    grid = [F.pmod(F.xxhash64(c, F.lit(7)), F.lit(max(1, -(-t.count() // most)))).alias(g) for c, t, most, g in (("v", held, HELD_TOGETHER, "gv"), ("q", asked, ASKED_TOGETHER, "gq"))]
    placed = pairs.select(*grid, "q", "v")
    wanted = placed.groupBy("gv", "gq", "q").agg(F.collect_list("v").alias("vs")).join(asked.select("q", "q_ids", "q_es", "floors"), "q").select("gv", "gq", "q_ids", "q_es", "floors", "vs")
    there = placed.select("gv", "gq", "v").distinct().join(held.select("v", "v_ids", "v_es"), "v").select(F.col("gv").alias("hv"), F.col("gq").alias("hq"), "v", "v_ids", "v_es")

    def run(want: pa.Table, have: pa.Table) -> pa.Table:
        key, out = lambda v: (v["pivot"], v["chunk"]), [schema_arrow.empty_table()]
        flat = lambda c: c.as_py() if not isinstance(c, pa.ListScalar) else c.values
        queries = [(ids, _Block(es), pc.fill_null(floors, np.nan).to_numpy(zero_copy_only=False), {key(v) for v in vs.to_pylist()}) for ids, es, floors, vs in (tuple(flat(c[r]) for c in want.columns[2:]) for r in range(want.num_rows))]
        for r in range(have.num_rows):
            v, ids = key(have.column(2)[r].as_py()), have.column(3)[r].values
            block, place = _Block(have.column(4)[r].values), np.empty(len(ids), np.int64)
            place[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
            for query, asking, floors, vs in queries:
                if v in vs:
                    i, j, score = _top(asking, block, place, floors, k)
                    out.append(pa.Table.from_arrays([query.take(pa.array(i)), ids.take(pa.array(j)), pa.array(score)], schema=schema_arrow))
        return pa.concat_tables(out)

    schema_arrow = to_arrow_schema(schema)
    return wanted.groupBy("gv", "gq").cogroup(there.groupBy("hv", "hq")).applyInArrow(run, schema)


def _reach(asked: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(q, pivot, a, b): the angles to each pivot within which a block of queries (q_ids, q_es, floors) can still find
    something: a query whose k-th best so far has the cosine `floor` needs nothing beyond that angle of itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                q, es, floors = batch.column(0).slice(r, 1), batch.column(1)[r].values, batch.column(2)[r].values
                floor = pc.fill_null(floors, -1.0).to_numpy(zero_copy_only=False)
                room = np.arccos(np.clip(floor, -1, 1))[:, None] + SLACK
                a = _angles(es, pivots)
                lost = np.isnan(a) | np.isnan(room)
                lo, hi = np.where(lost, -np.inf, a - room).min(axis=0), np.where(lost, np.inf, a + room).max(axis=0)
                n = len(pivots) + 1
                yield pa.RecordBatch.from_arrays([q.take(pa.array([0] * n)), pa.array(np.arange(-1, n - 1, dtype=np.int32)), pa.array([-np.inf, *lo]), pa.array([np.inf, *hi])], names=["q", "pivot", "a", "b"])

    return asked.mapInArrow(run, T.StructType([asked.schema["q"], T.StructField("pivot", T.IntegerType()), T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType())]))


def top_similar(vectors: DataFrame, queries: DataFrame, k: int, dims: int | None = None, block: int = ASKED, report: Callable[[int, int], None] | None = None) -> DataFrame:
    """(query_id, vec_id, score, rank): cosines of vectors cut to the first dims, best first, ties by vec_id.

    Vectors are dealt to pivots, a bounded sample of them, and held in blocks with the range of their angles to their
    pivot. A block of queries meets one block of its own pivot first; by the triangle inequality of angles, others can
    hold something better only if their range comes within a query's angle to the pivot, give or take the angle of its
    k-th best so far. The rest are left out; results are exact. Vectors without a direction are in blocks of their own,
    which every query meets. report(met, all) is told the pairs of blocks.
    """
    cut = lambda c: F.slice(c, 1, dims) if dims else F.col(c)
    q, v = (t.select(F.col(t.columns[0]).alias(n), cut(t.columns[1]).alias(f"{n}_e")) for t, n in ((queries, "query_id"), (vectors, "vec_id")))
    schema = T.StructType([q.schema["query_id"], v.schema["vec_id"], T.StructField("score", T.DoubleType())])
    spark, path = vectors.sparkSession, shared_dir(vectors.sparkSession)
    plain = v.where(F.size("vec_id_e") > 0)
    n = min(MOST_PIVOTS, plain.count() // A_PIVOT)
    sample = plain.orderBy(F.xxhash64("vec_id", "vec_id_e"), "vec_id").limit(n).select("vec_id_e").collect() if n else []
    chosen = [np.array(r[0], float) for r in sample if None not in r[0]]
    chosen = [p / np.sqrt(p @ p) for p in chosen if len(p) == len(chosen[0]) and np.isfinite(p).all() and p @ p > 0]
    pivots = np.array(chosen) if chosen else np.zeros((0, 1))
    for rows, most, name in ((v, BLOCK, "v"), (q, block, "q")):
        _near(rows, pivots).write.parquet(f"{path}/{name}_near")
        _in_blocks(spark.read.parquet(f"{path}/{name}_near"), most, name).write.parquet(f"{path}/{name}")
    held, asked = (spark.read.parquet(f"{path}/{name}") for name in "vq")
    home = asked.join(held.where("v.chunk = 0 and pivot >= 0").select("pivot", "v"), "pivot").select("q", "v")
    floors = _best(home, asked.withColumn("floors", F.transform("q_ids", lambda _: F.lit(None).cast("double"))), held, k, schema).groupBy("query_id").agg(F.when(F.count_if(~F.isnan("score")) >= k, F.min(F.when(~F.isnan("score"), F.col("score")))).alias("floor"))
    each = asked.select("q", F.explode(F.arrays_zip("q_ids", "q_es")).alias("x")).select("q", F.col("x.q_ids").alias("query_id"), F.col("x.q_es").alias("e"))
    known = each.join(floors, "query_id", "left").groupBy("q").agg(F.collect_list(F.struct("query_id", "e", "floor")).alias("r"))
    known.select("q", F.col("r.query_id").alias("q_ids"), F.col("r.e").alias("q_es"), F.col("r.floor").alias("floors")).write.parquet(f"{path}/known")
    known = spark.read.parquet(f"{path}/known")
    ranges = held.select("v", "pivot", "lo", "hi")
    pairs = _reach(known.select("q", "q_es", "floors"), pivots).join(ranges, "pivot").where("hi >= a and lo <= b").select("q", "v")
    if report:
        report(pairs.count(), held.count() * asked.count())
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return _best(pairs, known, held, k, schema).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
