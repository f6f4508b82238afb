"""Language identification against plain Python, held-out accuracy, and rows that are hard in some way."""

import math
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from foliant.llm import hashing as H
from foliant.llm import langid, queries

MASK = (1 << 64) - 1


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def brute_buckets(text):
    kinds = [(c, unicodedata.category(c)[0]) for c in pc.utf8_lower(text or "").as_py()]
    words = "".join(c if k in "LM" else " " for c, k in kinds)
    padded = f" {' '.join(words.split(' '))} "
    while "  " in padded:
        padded = padded.replace("  ", " ")
    codes, out = [mix(ord(c) + 1) for c in padded], Counter()
    for n in langid.ORDERS:
        for i in range(len(codes) - n + 1):
            h = 0
            for c in codes[i : i + n]:
                h = (h * int(H.BASES[0]) + c) & MASK
            out[(h * int(H.BASES[1]) & MASK) >> 49] += 1
    return out


TEXTS = ["Der Hund schläft, weil es regnet.", "the dog sleeps because it rains", "", "   ", "123 -- !", "é" * 50, "a", "x y" * 400, "été", "İstanbul", "漢字 かな"]


@pytest.mark.parametrize("step", [1 << 19, 64, 7])
def test_buckets_equal_plain_python(step):
    got = defaultdict(Counter)
    letters = np.zeros(len(TEXTS), bool)
    for g in langid.grams(pa.array([*TEXTS, None]), step=step):
        ends = np.append(g.starts[1:], len(g.buckets[0]))
        letters[g.first : g.first + len(g.letters)] |= g.letters[: len(TEXTS) - g.first]
        for b in g.buckets:
            for o, s, e in zip(g.owner, g.starts, ends, strict=True):
                got[o] += Counter(x for x in b[s:e].tolist() if x < langid.BUCKETS)
    for i, t in enumerate(TEXTS):
        assert got[i] == brute_buckets(t), t
        assert letters[i] == any(unicodedata.category(c)[0] == "L" for c in t.lower())


def test_predictions_equal_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    got = {r.doc_id: r for r in queries.op11_language_id(spark, sf).collect()}
    assert set(got) == set(rows)
    counts, texts = defaultdict(Counter), Counter()
    for i, r in rows.items():
        if not got[i].held_out and r.lang is not None and r.text is not None:
            counts[r.lang] += brute_buckets(r.text)
            texts[r.lang] += 1
    total = {x: sum(c.values()) + langid.SMOOTHING * langid.BUCKETS for x, c in counts.items()}
    for i, r in list(rows.items())[::7]:
        own = brute_buckets(r.text)
        score = {x: math.log(texts[x] / sum(texts.values())) + sum(n * math.log((counts[x][b] + langid.SMOOTHING) / total[x]) for b, n in own.items()) for x in counts}
        best = max(sorted(score), key=score.get)
        assert got[i].lang_pred == best
        assert got[i].score == pytest.approx(1 / sum(math.exp(s - score[best]) for s in score.values()), abs=1e-3)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in queries.op11_language_id(spark, sf).collect() if r.held_out]
    assert len(held) > 200 and sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) >= 0.99


def test_hard_rows(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    docs = spark.createDataFrame([(1, "der hund und die katze", "de", "s", 1), (1, "der hund und die katze", "de", "s", 1), (2, "the dog and the cat", "en", None, 2), (None, "le chien et le chat", "fr", "", 3), (4, None, "de", "", 4), (5, "", None, "", 5), (6, "1 2 3", "en", "", 6), (7, "das ist der hund " * 40_000, None, "", 7)], schema)
    model = langid.learn(docs)
    assert model.languages == ["de", "en", "fr"]
    out = langid.predict(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "score_in", "lang_pred_in", "lang_pred", "score"]
    assert sorted(((r.doc_id or 0, r.lang_pred) for r in out.collect())) == [(0, "fr"), (1, "de"), (1, "de"), (2, "en"), (4, "und"), (5, "und"), (6, "und"), (7, "de")]
    assert langid.predict(docs.limit(0), model).count() == 0
    blank = langid.learn(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, blank).collect()} == {("und", 0.0)}
    with pytest.raises(ValueError):
        langid.learn(docs, most_languages=2)
