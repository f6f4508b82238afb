"""Hard negatives against all pairs, with trees of few rows; what the tree leaves unvisited."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import vptree

OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchors, positives=5, negatives=10):
    usable = [(i, y, np.floor(np.array(v, float) * 256)) for i, v, y in rows if i is not None and y is not None and v is not None and None not in v and np.isfinite(v).all()]
    size = max((len(v) for *_, v in usable), default=0)
    usable = [(i, y, np.pad(v, (0, size - len(v))).astype(int)) for i, y, v in usable]
    out = []
    for a, y, q in usable:
        if a in anchors:
            scored = sorted((-int(q @ v), i, z) for i, z, v in usable if i != a)
            for p, i, _ in [s for s in scored if s[2] == y][:positives]:
                fits = [s for s in scored if s[2] != y and 30 * -p <= 100 * -s[0] <= 90 * -p]
                out += [(a, i, k, j, -p, -s) for k, (s, j, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def clustered(seed, n, size=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, size))
    v = centres[rng.integers(0, 9, n)] + 0.2 * rng.normal(size=(n, size))
    v[: n // 3] = v[0]  # a third of the rows are one vector
    return [(int(i), [float(x) for x in v[i]], int(rng.integers(0, 3))) for i in rng.permutation(n)]


@pytest.mark.parametrize(("chunk", "leaf"), [(40, 4), (200, 16), (4096, 128)])
def test_against_all_pairs(spark, chunk, leaf):
    rows = clustered(chunk, 600)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = vptree.hard_negatives(df, F.col("vec_id") % 20 == 0, chunk=chunk, leaf=leaf)
    assert got.columns == OUT
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, set(range(0, 600, 20)))


def test_hard_rows(spark):
    schema = "vec_id long, embedding array<float>, label string, rank int, anchor long"
    nan = float("nan")
    rows = [(0, [1.0, 0.5], "a"), (1, [1.0, 0.4], "a"), (2, [0.9], "a"), (3, [0.5, 0.5], "b"), (4, [0.5, 0.5], "c"), (5, None, "a"), (6, [1.0, None], "a"), (7, [nan, 1.0], "b"), (8, [], "b"), (9, [0.0, 0.0], "a"), (10, [1.0, 1.0], None), (None, [1.0, 1.0], "b"), (20, [-1.0, -1.0], "b")]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], schema)
    got = vptree.hard_negatives(df, F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, {0, 20}) != []
    assert vptree.hard_negatives(df.limit(0), F.col("vec_id") == 0).collect() == []
    assert vptree.hard_negatives(df, F.lit(False)).collect() == []


def test_leaves_are_left_out():
    """A question whose annulus is thin visits few leaves of well separated rows, and finds all it asks for."""
    rng = np.random.default_rng(1)
    v = np.floor(256 * (np.repeat(rng.normal(size=(32, 4)) * 9, 64, axis=0) + 0.05 * rng.normal(size=(2048, 4))))
    ids, labels, norm = np.arange(2048), rng.integers(0, 2, 2048), float((v * v).sum(axis=1).max())
    chunk = vptree.build(ids, labels, v, norm, 64)
    asked = np.arange(0, 2048, 64)
    one, none, all_ = labels[asked], np.full(32, vptree.LEAST + 1), np.full(32, vptree.MOST)
    score, found, visits = vptree.search(chunk, norm, asked, one, none, all_, v[asked], True, 5)
    assert visits < 0.5 * 32 * (len(chunk.leaves) - 1)
    exact = (v[asked] @ v.T).astype(int)
    for k, q in enumerate(asked):
        order = sorted((-exact[k, i], i) for i in ids if i != q and labels[i] == labels[q])[:5]
        assert [(-s, i) for s, i in order] == list(zip(score[k].tolist(), found[k].tolist(), strict=True))
