"""Edit distances and grams against the plain matrix and plain counting."""

import random
import time

import pytest
from pyspark.sql import functions as F

from foliant.functions import edits as E
from foliant.functions import text as X


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edits_equal_the_matrix():
    rng = random.Random(4)
    for _ in range(600):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(0, 70))] for _ in range(2))
        assert E.edits(a, b) == plain(a, b)
        assert E.edits(a, a[: len(a) // 2] + ["z"] + a[len(a) // 2 :]) == 1


def test_long_pairs_are_quick(spark):
    rng = random.Random(5)
    a, b = ([rng.choice(["the", "a", *map(str, range(400))]) for _ in range(3000)] for _ in range(2))
    at = time.time()
    d = E.edits(a, b)
    assert time.time() - at < 0.5 and 1500 < d <= 3000
    got = spark.createDataFrame([(a, b)], "a array<string>, b array<string>").select(X.word_error_rate(F.col("a"), F.col("b")).alias("w"), X.bleu(F.col("a"), F.col("b")).alias("b")).first()
    assert got.w == pytest.approx(d / 3000) and 0 < got.b < 1


def test_empty_and_null_lists(spark):
    rows = [([], []), ([], ["a"]), (["a"], []), (["a"], ["a"]), (None, ["a"]), (["a", "b"], ["b", "a"])]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    assert [r.w for r in df.select(X.word_error_rate(F.col("a"), F.col("b")).alias("w")).collect()] == [0.0, 1.0, 1.0, 0.0, None, 1.0]
    assert [r.h for r in df.select(E.gram_hits(F.col("a"), F.col("b")).alias("h")).collect()] == [[0] * 4, [0] * 4, [0] * 4, [1, 0, 0, 0], None, [2, 0, 0, 0]]


def test_top_words(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "a"],), ([],), (["x"],), (None,)], "w array<string>")
    assert [r.t if r.t is None else [tuple(x) for x in r.t] for r in df.select(X.top_words(F.col("w"), 2).alias("t")).collect()] == [[("b", 2), ("a", 2)], [], [("x", 1)], []]


def test_chunks(spark):
    df = spark.createDataFrame([("a b  c d e",), ("a  b",), ("",), (None,)], "t string")
    assert [r.c for r in df.select(X.chunks(F.col("t"), 3, 1).alias("c")).collect()] == [["a b c", "c d e", "e"], ["a  b"], [""], []]
