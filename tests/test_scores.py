"""Calibration, error rates and document checks against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import calibration as C
from foliant.operators import matching as M


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


PAIRS = [("", ""), ("", "a"), ("a b", ""), ("the cat sat", "the cat sat"), ("a b c d e", "a x c e f"), ("é 汉 é", "汉 é"), ("a a a", "a")]


def test_word_error_rate(spark):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PAIRS)], "i int, a string, b string")
    got = {r.i: r.e for r in df.select("i", X.word_error_rate(X.words(F.col("a")), X.words(F.col("b"))).alias("e")).collect()}
    for i, (a, b) in enumerate(PAIRS):
        a, b = a.split(), b.split()
        assert got[i] == pytest.approx(edits(a, b) / len(a) if a else float(bool(b)))


def test_bleu(spark):
    df = spark.createDataFrame([("a b c d", "a b c d"), ("a b", "c d"), ("", "a"), ("a b c", "a b")], "a string, b string")
    got = [r[0] for r in df.select(X.bleu(X.words(F.col("a")), X.words(F.col("b")))).collect()]
    assert got == pytest.approx([1.0, 0.0, 0.0, math.exp(-0.5 + 0.5 * math.log(0.1))])


def test_valid_document(spark):
    e = '{"class":"T","bbox":%s,"content":null,"language":"en","page":0}'
    good = ['{"document_id":1,"elements":[]}', '{"document_id":null,"elements":[%s]}' % (e % "[0,1,2,3]")]
    bad = [None, "", "[]", "{", '{"elements":[]}', '{"document_id":1,"elements":{}}', '{"document_id":1,"elements":[3]}', '{"document_id":1,"elements":[{"class":"T"}]}']
    bad += ['{"document_id":1,"elements":[%s]}' % (e % b) for b in ('"x"', "[1,2,3]", "[1,2,3,4,5]", "[1.5,2,3,4]", '["1",2,3,4]', "[-1,2,3,4]", "[null,1,2,3]")]
    df = spark.createDataFrame([(p, p in good) for p in good + bad], "p string, ok boolean")
    assert [r.p for r in df.where(X.valid_document(F.col("p")) != F.col("ok")).collect()] == []


def test_calibration(spark):
    rng = np.random.default_rng(1)
    c = np.round(rng.random(400), 2)
    y = rng.random(400) < c**2
    df = spark.createDataFrame([(float(a), bool(b)) for a, b in zip(c, y, strict=True)], "c double, y boolean")
    w = np.zeros(2)
    x = np.stack([c, np.ones(400)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag([1, 0]), x.T @ (p - y) + [w[0], 0])
    assert C.platt(df, "c", "y") == pytest.approx(tuple(w), abs=1e-3)
    pools = []
    for v in sorted(set(c.tolist())):
        pools.append([[v], int(y[c == v].sum()), int((c == v).sum())])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            b = pools.pop()
            pools[-1] = [pools[-1][0] + b[0], pools[-1][1] + b[1], pools[-1][2] + b[2]]
    want = {v: s / n for vs, s, n in pools for v in vs}
    assert {r.c: r.calibrated for r in C.isotonic(df, "c", "y").collect()} == pytest.approx(want)


def test_precision_at(spark):
    cols = "page_id long, ann_no long, x long, y long, w long, h long, class_id int"
    gt = spark.createDataFrame([(1, 1, 0, 0, 100, 100, 0), (1, 2, 300, 0, 100, 100, 0)], cols)
    pred = spark.createDataFrame([(1, 1, 0, 0, 100, 80, 0, 0.9), (1, 2, 0, 500, 9, 9, 0, 0.8), (1, 3, 300, 0, 100, 100, 0, 0.7)], cols + ", score double")
    got = {r.percent: r.ap for r in M.precision_at(gt, pred, (50, 85)).collect()}
    assert got == pytest.approx({50: (51 + 50 * 2 / 3) / 101, 85: 51 / 3 / 101})


def test_languages_are_told_and_counted_once(spark):
    from foliant.operators import evaluation as E
    from foliant.operators.models import COMMON, language_of

    texts = [None, "", "of", "The. end, of: the?! story", "the.x la. la  de de, y", "le la les;des", "der the", "a" * 9, "the\nthe\tof", "und die, nicht ein.", "…the (the) the…"]
    want = []
    for t in texts:
        ws = [w.rstrip(".,;:!?") for w in (t or "").lower().split()]
        n = {k: sum(w in v for w in ws) for k, v in sorted(COMMON.items())}
        best = max(n, key=lambda k: (n[k], [-ord(c) for c in k]))
        sure = n[best] / sum(n.values()) if any(n.values()) else 0.0
        want.append((None if len((t or "").strip()) < 3 else "unknown" if sure < 0.55 else best, sure))
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(1)
    guess, sure = language_of(F.col("text"))
    told = rows.select("id", guess.alias("guess"), sure.alias("sure"))
    assert [(r.guess, r.sure) for r in told.orderBy("id").collect()] == want
    assert told.select("guess")._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def marked(x):
        seen.add(1)
        return x

    square = E.square_confusion(spark.range(40).select((F.col("id") % 2).cast("string").alias("t"), marked((F.col("id") % 3).cast("string")).alias("g")), "t", "g")
    assert sorted(map(tuple, square.collect()))[:3] == [("0", "0", 7), ("0", "1", 6), ("0", "2", 7)] and seen.value == 40


def test_a_document_is_parsed_once(spark):
    """Text, its fields and each element's are read once, whatever is asked of them."""
    docs = ['{"document_id":"d","elements":[{"class":"T","bbox":[1,2,3,4],"content":null,"language":null,"page":0}]}', '{"document_id":"d","elements":[]}', "[1]", "nul", None, '{"elements":null}', '{"document_id":1,"elements":{"a":1}}', '{"document_id":1,"elements":[3]}', '{"document_id":1,"elements":[{"class":1,"bbox":null,"content":1,"language":1,"page":1}]}']
    rows = spark.createDataFrame(list(enumerate(docs)), "id int, p string").select("id", X.document_error(F.col("p")).alias("e"))
    assert [r.e for r in rows.orderBy("id").collect()] == [None, None, *["Not a JSON object"] * 3, "Missing required field: document_id", "'elements' must be a list", "Element 0 is not a dictionary", "Element 0 bbox must be a list of 4 integers"]
    assert str(X.document_error(F.col("p"))).count("parse_json(") == 1


def test_a_norm_is_made_once_a_vector(spark):
    """Not once for each of its numbers; and flags look at a text's words once."""
    from foliant.operators import vectors as V

    rows = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, None), (3, [])], "i int, e array<double>")
    assert [r.u for r in rows.select("i", V.unit(F.col("e")).alias("u")).orderBy("i").collect()] == [[0.6, 0.8], [0.0, 0.0], None, []]
    plan = rows.select(V.unit(F.col("e")).alias("u"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
    turns = spark.createDataFrame([(0, "One two. ... 　. three"), (1, " .!? "), (2, "a " * 31 + "."), (3, ""), (4, None)], "i int, t string")
    flags = X.qa_flags(F.col("t"), F.lit("Text"), F.lit("fr"))
    got = {r.i: {f.issue for f in r.f} for r in turns.select("i", flags.alias("f")).collect()}
    assert got == {0: set(), 1: {"length_insufficient", "no_sentences"}, 2: {"long_sentences", "excessive_repetition"}, 3: set(), 4: set()}
    assert turns.select(flags.alias("f"))._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") <= 3
