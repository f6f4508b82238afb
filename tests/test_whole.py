"""Queries without SQL over whole tables, against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from foliant.functions import text as X
from foliant.operators import nearest
from foliant.operators.nearest import top_similar
from foliant.plans.every import QUERIES

PERSONAL = [
    (1, "fr", "écrivez à jean@exemple.fr, né le 01/02/1990 à Orléans"), (2, "de", "Grüße +49 (123) 456-7890 und 4111111111111111"), (3, "en", "ABCDE1234F 1234 5678 9012 123-45-6789 naïve"),
    (4, "en", "DE89370400440532013000 é DEUTDEFF"), (5, "es", "é4111111111111111 123-45-6789é"), (6, "en", "a@b.org a@b.org"), (7, "en", None), (8, "en", ""),
]
TURNS = [
    (1, 0, "Où est la gare ?"), (1, 1, "La gare est là-bas"), (1, 2, ""), (1, 3, "ÉTÉ été"), (1, 4, None), (1, 5, "plain words here"), (1, 6, "plain words there"), (2, 0, "漢字 é"), (2, 1, "漢字 e"), (2, 3, "alone"),
]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("small"))
    spark.createDataFrame(PERSONAL, "doc_id long, lang string, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(TURNS, "conv_id long, turn long, text string").write.parquet(f"{path}/conversations.parquet")
    return path


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def rate(a, b):
    return edits(a, b) / len(a) if a else float(bool(b))


def bleu(a, b):
    if not set(a) & set(b):
        return 0.0
    log_p = 0.0
    for n in range(1, 5):
        grams = [Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) for w in (a, b)]
        log_p += 0.25 * math.log(max((grams[0] & grams[1]).total(), 0.1) / max(1, len(b) - n + 1))
    return math.exp(log_p + min(0.0, 1 - len(a) / len(b)))


def words(text):
    return text.lower().split()


@pytest.mark.parametrize("where", ["small", "sf"])
def test_pii_findings(spark, where, request):
    path = request.getfixturevalue(where)
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    want = Counter((r.doc_id, k, m.group()) for r in docs for k, p in X.PII.items() for m in re.finditer(p, r.text or ""))
    got = QUERIES["q_pii_findings"](spark, path).collect()
    assert len(got) == len(want) and {(r.doc_id, r.type, r.original): r.n for r in got} == want
    if where == "small":
        assert {k for _, k, _ in want} == set(X.PII)


@pytest.mark.parametrize("where", ["small", "sf"])
def test_adjacent_turns(spark, where, request):
    path = request.getfixturevalue(where)
    text = {(r.conv_id, r.turn): r.text or "" for r in spark.read.parquet(f"{path}/conversations.parquet").collect()}
    pairs = {k: (t, text[k[0], k[1] + 1]) for k, t in text.items() if (k[0], k[1] + 1) in text}
    each = {"cer": lambda a, b: rate(a, b), "wer": lambda a, b: rate(words(a), words(b)), "bleu": lambda a, b: bleu(words(a), words(b))}
    for name, f in each.items():
        got = QUERIES[f"q_{name}_pairs"](spark, path).collect()
        assert len(got) == len(pairs)
        assert {(r.conv_id, r.turn): r[name] for r in got} == pytest.approx({k: f(*p) for k, p in pairs.items()}, abs=2e-6)


def brute_similar(data, queries, k, dims):
    def cosine(a, b):
        if not a or not b or None in a or None in b or len(a[:dims]) != len(b[:dims]):
            return 0.0
        a, b = np.array(a[:dims], np.float64), np.array(b[:dims], np.float64)
        norms = math.sqrt(a @ a) * math.sqrt(b @ b)
        return float(a @ b) / norms if norms else 0.0

    return {(q, n + 1): (i, s) for q, e in queries for n, (s, i) in enumerate(sorted(((round(cosine(e, f), 9), i) for i, f in data), key=lambda x: (-x[0], x[1]))[:k])}


@pytest.mark.parametrize(("name", "dims"), [("q_vector_topk", 64), ("q_vector_topk_truncated", 32)])
def test_vector_search(spark, sf, name, dims):
    data = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_similar(data, [d for d in data if d[0] % 100 == 0], 5, dims)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in QUERIES[name](spark, sf).collect()}
    assert len({q for q, _ in got}) == sum(i % 100 == 0 for i, _ in data) and got.keys() == want.keys()
    assert all(got[x][0] == i and abs(got[x][1] - s) < 2e-6 for x, (i, s) in want.items())


def test_search_in_blocks(spark):
    """Ties, nulls, zeros and odd lengths, with queries and vectors in many blocks."""
    rng = np.random.default_rng(7)
    data = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    data += [(300 + i, data[i][1]) for i in range(20)] + [(400, None), (401, []), (402, [0.0] * 8), (403, [None] + [1.0] * 7), (404, [1.0, 2.0]), (405, [2.0, 4.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    for k in (1, 5, 1000):
        got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_similar(df, df, k, None, 7).collect()}
        want = brute_similar(data, data, k, None)
        assert got.keys() == want.keys() and all(got[x][0] == i and abs(got[x][1] - s) < 1e-6 for x, (i, s) in want.items())


def test_search_leaves_blocks_out(spark, monkeypatch):
    """Clustered vectors: the same rows as from all pairs, from few of the pairs of blocks."""
    monkeypatch.setattr(nearest, "BLOCK", 40)
    monkeypatch.setattr(nearest, "A_PIVOT", 40)
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((16, 12))
    data = [(i, [float(x) for x in centres[i % 16] + 0.1 * rng.standard_normal(12)]) for i in range(800)] + [(900 + i, [0.0] * 12) for i in range(3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    told = []
    queries = df.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in nearest.top_similar(df, queries, 4, block=8, report=lambda *x: told.append(x)).collect()}
    want = brute_similar(data, [d for d in data if d[0] % 10 == 0], 4, None)
    assert got.keys() == want.keys() and all(got[x][0] == i and abs(got[x][1] - s) < 1e-6 for x, (i, s) in want.items())
    met, all_ = told[0]
    assert met < 0.5 * all_
    assert nearest.top_similar(df.limit(0), queries, 3).count() == 0 and nearest.top_similar(df, queries.limit(0), 3).count() == 0


def test_search_scores_few_pairs_one_by_one(spark, monkeypatch):
    """Only what can be among the best is scored pair by pair, and only what is not below a query's floor goes on."""
    rng = np.random.default_rng(5)
    block = lambda rows: nearest._Block(pa.array(rows, pa.list_(pa.float64())))
    a, b = rng.standard_normal((20, 16)), rng.standard_normal((500, 16))
    rows = [*map(list, b), [0.0] * 16, None, [1.0], list(b[3])]
    q, v, scored = block([*map(list, a), list(b[3])]), block(rows), []
    real = nearest._exact
    monkeypatch.setattr(nearest, "_exact", lambda *x: (scored.append(len(x[2])), real(*x))[1])
    want = nearest._scores(q.vectors, v.vectors)
    for floors in (np.full(21, np.nan), np.sort(want, axis=1)[:, -3]):
        i, j, score = nearest._top(q, v, np.arange(len(rows)), floors, 5)
        for x in range(21):
            best = sorted(range(len(rows)), key=lambda y: (-want[x, y], y))[:5]
            assert j[i == x].tolist() == [y for y in best if not want[x, y] < floors[x]] and score[i == x].tolist() == want[x, j[i == x]].tolist()
    assert max(scored) < 21 * 10 and q.plain and not block([[1e200] * 16]).plain and not block([[float("inf")]]).plain
    odd = block([[float("nan")] * 16, [1e200] * 16, list(b[0])])
    i, j, score = nearest._top(q, odd, np.arange(3), np.full(21, np.nan), 2)
    assert len(i) == 42 and all(np.isnan(score[(j == 0)])) and (j[::2] == 0).all()
