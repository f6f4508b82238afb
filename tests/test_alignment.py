"""Token alignment against all pairs of words; lookups of names by parts against asking every name."""

import math
import random

import numpy as np
import pytest

from foliant.operators import alignment, evaluation, lookup


def plain(pairs):
    refs = [set((r or "").lower().split()) for r, _ in pairs]
    idf = lambda w: 1 + math.log((len(pairs) + 1) / (sum(w in r for r in refs) + 1))
    vec = lambda w: alignment.letters([w])[0]
    cos = lambda a, b: float(vec(a) @ vec(b) / np.linalg.norm(vec(a)) / np.linalg.norm(vec(b)))
    out = []
    for r, p in pairs:
        r, p = (r or "").lower().split(), (p or "").lower().split()
        one = lambda a, b: sum(idf(x) * max(cos(x, y) for y in b) for x in a) / sum(map(idf, a)) if a and b else 0.0
        precision, recall = one(p, r), one(r, p)
        out.append((precision, recall, 2 * precision * recall / (precision + recall) if precision + recall else 0.0))
    return out


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_alignment_equals_all_pairs(spark, block):
    rng = random.Random(2)
    text = lambda: " ".join(rng.choice(["The", "figure", "shows", "sales", "of", "12%", "tables", "é"]) for _ in range(rng.randrange(0, 9)))
    pairs = [(text(), text()) for _ in range(30)] + [("same words here", "same words here")] * 3 + [(None, "a"), ("", ""), ("a", None)]
    got = alignment.bert_scores(spark.createDataFrame([(i, r, p) for i, (r, p) in enumerate(pairs)], "i int, r string, p string"), "r", "p", block=block)
    assert got.columns == ["i", "r", "p", "precision", "recall", "f1"]
    for row, want in zip(sorted(got.collect()), plain(pairs), strict=True):
        assert tuple(row[3:]) == pytest.approx(want)
    assert got.where("i between 30 and 32 and f1 > 0.999999").count() == 3


def test_other_encoders_plug_in(spark):
    pairs = spark.createDataFrame([("k", "Table", "b a", "a b")], "key string, class string, prediction string, reference string")
    one = lambda tokens: np.eye(2)[[ord(t[0]) % 2 for t in tokens]]
    assert evaluation.description_scores(pairs, one).first().bertscore == pytest.approx(1.0)
    assert alignment.bert_scores(pairs.limit(0), "reference", "prediction").count() == 0


@pytest.mark.parametrize("a_task", [2, 4096])
def test_holders_equal_asking_every_name(spark, monkeypatch, a_task):
    monkeypatch.setattr(lookup, "A_TASK", a_task)
    rng = random.Random(6)
    names = [f"img_{rng.randrange(3000)}_{rng.choice(['left', 'right'])}.png" for _ in range(300)] + ["img_1", "é漢字zoo", None, "x"]
    parts = [str(rng.randrange(3000)) for _ in range(80)] + ["img_", "right.png", "left.pngx", "", "é漢", "漢字zoo", "x", "%", "_1", "nothing here", None, "img_1"]
    got = lookup.holders(spark.createDataFrame([(p,) for p in parts], "part string"), spark.createDataFrame([(n,) for n in names], "file string"))
    want = {p: min((n for n in names if n is not None and p in n), default=None) for p in parts if p is not None}
    rows = got.collect()
    assert len(rows) == len(want) and {r.part: r.name for r in rows} == want
    none = lookup.holders(spark.createDataFrame([("a",), ("abcdef",), ("",)], "part string"), spark.createDataFrame([], "file string"))
    assert {r.part: r.name for r in none.collect()} == {"a": None, "abcdef": None, "": None}
