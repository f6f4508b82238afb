"""Detection metrics, matching, hashes, ranks, models and reports against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators import active as A
from foliant.operators import evaluation as E
from foliant.operators import matching as M
from foliant.operators import models
from foliant.operators import quality as Q
from foliant.operators import hashes
from foliant.operators import vectors as V
from foliant.operators.ranks import ordered
from foliant.plans import reports
from foliant.plans.every import QUERIES
from foliant.plans.scores import text_boxes
from tests.test_whole import edits


def overlap(a, b):
    w, h = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]), min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    return w * h / (a[2] * a[3] + b[2] * b[3] - w * h) if w > 0 and h > 0 else 0.0


RANGES = ((0, 1e10), (0, 1024), (1024, 9216), (9216, 1e10))


def plain_table(gt, pred):
    """(class, percent, size, most) -> (ap, recall); boxes are (page, class, number, x, y, w, h[, score]). Detections of
    equal score count together."""
    out = {}
    for c in sorted({g[1] for g in gt}):
        for size, (low, high) in enumerate(RANGES):
            inside = lambda b, low=low, high=high: low <= b[5] * b[6] <= high
            total = sum(inside(g) for g in gt if g[1] == c)
            if not total:
                continue
            for percent in E.OVERLAPS:
                for most in E.MOST_DETECTIONS:
                    marks = []
                    for page in sorted({p[0] for p in pred}):
                        ps = sorted((p for p in pred if p[0] == page and p[1] == c), key=lambda p: (-p[7], p[2]))[:100]
                        gs, taken = sorted((g for g in gt if g[0] == page and g[1] == c), key=lambda g: (not inside(g), g[2])), set()
                        for n, p in enumerate(ps):
                            best, mine = percent / 100 - 1e-10, None
                            for g in gs:
                                if g[2] in taken:
                                    continue
                                if mine is not None and inside(mine) and not inside(g):
                                    break
                                if overlap(p[3:7], g[3:7]) >= best:
                                    best, mine = overlap(p[3:7], g[3:7]), g
                            if mine is not None:
                                taken.add(mine[2])
                            if n < most and (inside(mine) if mine is not None else inside(p)):
                                marks.append((p[7], mine is not None))
                    tp = n = 0
                    curve = []
                    for s in sorted({m[0] for m in marks}, reverse=True):
                        tp, n = tp + sum(m[1] for m in marks if m[0] == s), n + sum(m[0] == s for m in marks)
                        curve.append((tp / total, tp / n))
                    ap = sum(max((p for r, p in curve if r >= k / 100 - 1e-9), default=0.0) for k in range(101)) / 101
                    out[c, percent, size, most] = (ap, max((r for r, _ in curve), default=0.0))
    return out


def test_detection_table(spark):
    rng = random.Random(5)
    gt, pred = [], []
    for page in range(6):
        for n in range(rng.randint(0, 14)):
            side = rng.choice([12, 40, 120])
            box = (rng.randrange(300), rng.randrange(300), side, side + rng.randrange(9))
            c = rng.randrange(2)
            gt.append((page, c, n, *box))
            for k in range(rng.randint(0, 2)):
                near = tuple(max(1, v + rng.randrange(-5, 6)) for v in box)
                pred.append((page, c if rng.random() < 0.9 else 1 - c, 100 * n + k, *near, round(rng.random(), 1)))
        pred.append((page, 0, 9000, 500, 500, 30, 30, 0.95))
    names = "page_id long, class_id int, ann_no long, x long, y long, w long, h long"
    table = E.detection_table(spark.createDataFrame(gt, names), spark.createDataFrame(pred, names + ", score double")).cache()
    got = {(r.class_id, r.percent, r["size"], r.most): (r.ap, r.recall) for r in table.collect()}
    want = plain_table(gt, pred)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    metrics = {r.metric: r.value for r in E.detection_metrics(table).collect()}
    mean = lambda part, cond: np.mean([v[part] for k, v in want.items() if cond(*k)])
    assert len(metrics) == 12 and metrics["mAP_0.5"] == pytest.approx(mean(0, lambda c, p, s, m: p == 50 and s == 0 and m == 100)) and metrics["AR_10"] == pytest.approx(mean(1, lambda c, p, s, m: s == 0 and m == 10)) and metrics["AR_small"] == pytest.approx(mean(1, lambda c, p, s, m: s == 1 and m == 100))
    assert {r.class_id: r.ap50 for r in E.class_metrics(table).collect()} == pytest.approx({c: want[c, 50, 0, 100][0] for c in (0, 1)})
    assert "mAP_0.5" in reports.detection_report(E.detection_metrics(table), E.class_metrics(table))
    overlaps = {(r.class_id, r.percent): r.ap for r in M.precision_at(spark.createDataFrame(gt, names), spark.createDataFrame(pred, names + ", score double"), (50, 75)).collect()}
    assert overlaps == pytest.approx({(c, p): want[c, p, 0, 100][0] for c in (0, 1) for p in (50, 75)})


@pytest.mark.parametrize("step", ["by_group", "greedy"])
def test_lone_pairs_are_told_at_once(spark, monkeypatch, step):
    """Pairs whose boxes are in no other pair meet neither the overlaps nor Python one by one."""
    met, real = [], getattr(M, step)
    monkeypatch.setattr(M, step, lambda rows, *how: (met.append(rows.count()), real(rows, *how))[1])
    gt = spark.createDataFrame([(p, 0, 1, 10, 10, 20, 20) for p in range(9)], "page_id long, class_id int, ann_no long, x long, y long, w long, h long")
    pred = gt.withColumn("w", F.lit(18).cast("long")).withColumn("score", F.lit(0.5))
    if step == "by_group":
        assert {(r.percent, r.ap) for r in E.detection_table(gt, pred).where("size = 1 and most = 1").collect()} == {(p, 1.0 if p <= 90 else 0.0) for p in E.OVERLAPS}
    else:
        assert {(r.percent, r.ap) for r in M.precision_at(gt, pred, E.OVERLAPS).collect()} == {(p, 1.0 if p <= 90 else 0.0) for p in E.OVERLAPS}
    assert met == [0]


def test_text_errors(spark, sf):
    gt, pred = (t.where("page_id < 60") for t in text_boxes(spark, sf))
    names = ("Text", "Title", "List")
    want = {}
    pages = {r.page_id for r in gt.collect()}
    true, guess = ([r for r in t.collect() if r["class"] in names] for t in (gt, pred))
    for page in pages:
        taken = set()
        for g in sorted((g for g in true if g.page_id == page), key=lambda g: g.ann_no):
            near = [(overlap((g.x, g.y, g.w, g.h), (p.x, p.y, p.w, p.h)), -p.ann_no, p) for p in guess if p.page_id == page and p.ann_no not in taken]
            v, _, p = max(near, default=(0, 0, None), key=lambda x: x[:2])
            if v > 0.5:
                taken.add(p.ann_no)
                if g.text and p.text:
                    want[page, g.ann_no] = (edits(g.text, p.text) / len(g.text), edits(g.text.split(), p.text.split()) / len(g.text.split()))
    got = {(r.page_id, r.gt_no): (r.cer, r.wer) for r in E.text_errors(gt, pred).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want) and want


@pytest.mark.parametrize(("k", "block"), [(1, 2048), (2, 16), (3, 70), (None, 2048)])
def test_near_hashes(spark, monkeypatch, k, block):
    """With keys of few and of more bands, small groups, and groups dealt into chunks."""
    monkeypatch.setattr(hashes, "BLOCK", block)
    monkeypatch.setattr(hashes, "HELD", 500)
    if k:
        monkeypatch.setattr(hashes, "bands_for", lambda n, most: k)
    rng = random.Random(1)
    base = [rng.getrandbits(64) - (1 << 63) for _ in range(40)]
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    rows = [(i, h) for i, h in enumerate(base)]
    for i in range(200):
        h = rng.choice(base) & ((1 << 64) - 1)
        for b in rng.sample(range(64), rng.randint(0, 11)):
            h ^= 1 << b
        rows.append((100 + i, signed(h)))
    rows += [(1000 + i, base[0] ^ i << 40) for i in range(150)]
    rows += [(900, None), (901, 0), (902, -1), (903, 255), (904, 511)]
    least = {}
    for i, h in rows:
        if h is not None:
            least[h] = min(least.get(h, i), i)
    ids = sorted((i, h) for h, i in least.items())
    want = {(a, b, d) for a, x in ids for b, y in ids if a < b and (d := ((x ^ y) & ((1 << 64) - 1)).bit_count()) <= 8}
    got = [tuple(r) for r in hashes.near_hashes(spark.createDataFrame(rows, "id long, h long"), "id", "h").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_near_within_and_copies():
    """All pairs of hashes that keep some bits; and a hash is copied few times, however many there are."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 50, 600, dtype=np.uint64) << np.uint64(7)
    flips = [sum(1 << int(b) for b in rng.choice(50, rng.integers(0, 10), replace=False)) << 7 for _ in range(900)]
    h = np.concatenate([base, np.array([int(base[i % 600]) ^ f for i, f in enumerate(flips)], np.uint64)])
    h = np.unique(h)
    got = [(min(a, b), max(a, b)) for i, j, _ in hashes.near_within(h, tuple(range(7, 57)), 8) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
    i, j = np.nonzero(np.triu(np.bitwise_count(h[:, None] ^ h) <= 8, 1))
    assert len(got) == len(set(got)) and set(got) == set(zip(i.tolist(), j.tolist(), strict=True)) and len(got) > 300
    assert all(len(hashes.Bands(8, hashes.bands_for(n, 8)).keys) <= 9 for n in (10**5, 10**6, 10**7, 3 * 10**7))


def test_ordered(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["x", "y", None, "page_00001", "page_00002"]), rng.choice([None, 1, 5])) for i in range(300)]
    got = {r.i: (r["rank"], r.before_v) for r in ordered(spark.createDataFrame(rows, "i int, s string, v long").repartition(5), ["s", "i"], ("v",)).collect()}
    total = 0
    for k, (i, _, v) in enumerate(sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[0])), 1):
        assert got[i] == (k, total)
        total += v or 0
    assert ordered(spark.createDataFrame([], "i int"), ["i"]).count() == 0


def test_errors_are_rows(spark):
    def work(row, model):
        return {"y": model / row["x"]}

    df = spark.createDataFrame([(1, 2), (2, 0), (3, 4)], "k long, x long")
    got = {r.k: (r.success, r.error, r.y) for r in models.map_rows(df, work, "k", "y double", 2, lambda: 8.0).collect()}
    assert got[1] == (True, None, 4.0) and got[3] == (True, None, 2.0) and not got[2][0] and "ZeroDivisionError" in got[2][1] and got[2][2] is None

    def crops(pdf):
        if pdf["k"].iloc[0] == 2:
            raise RuntimeError("no model")
        return [{"text": str(x)} for x in pdf["x"]]

    out = sorted(((r.k, r.success, r.error, r.text) for r in models.map_groups(df.unionByName(df), crops, "k", "text string").collect()), key=str)
    assert out == [(1, True, None, "2"), (1, True, None, "2"), (2, False, "RuntimeError: no model", None), (3, True, None, "4"), (3, True, None, "4")]


def test_descriptions(spark):
    rows = [("d", 0, "Table", 0, 0, 1, 1, None, None, {"a": "b"}, 0), ("d", 0, "Figure", 0, 5, 1, 1, None, None, {}, 1), ("d", 0, "Text", 0, 9, 1, 1, "own", None, {}, 2)]
    e = spark.createDataFrame(rows, "document_id string, page int, class string, x int, y int, w int, h int, content string, language string, meta map<string,string>, elem_pos int")
    from foliant.operators import documents as D

    said = models.described(D.to_describe(e), lambda prompts, ids: prompts + " about " + ids)
    out = {r.elem_pos: (r.content, r.meta) for r in D.merge_descriptions(e, said).collect()}
    assert out == {0: ("about 0", {"a": "b", "source": "vlm_description"}), 1: ("about 1", {"source": "vlm_description"}), 2: ("own", {})}


def test_perceptual_hash(spark):
    rng = np.random.default_rng(3)
    image = np.kron(rng.integers(0, 255, (8, 8)), np.ones((4, 4))).astype(int)
    noisy = np.clip(image + rng.integers(-3, 4, image.shape), 0, 255)
    df = spark.createDataFrame([(0, image.ravel().tolist()), (1, noisy.ravel().tolist()), (2, rng.integers(0, 255, 1024).tolist()), (3, [1, 2]), (4, None)], "i int, p array<long>")
    got = {r.i: r.h for r in df.select("i", models.image_hash("p").alias("h")).collect()}
    apart = lambda a, b: ((got[a] ^ got[b]) & ((1 << 64) - 1)).bit_count()
    assert got[3] is None and got[4] is None and apart(0, 1) <= 8 < apart(0, 2) and got[0] == models.perceptual_hash(image)


def test_index_search(spark):
    texts = ["green apples grow on trees", "red apples fall", "the sea is blue and deep", "", None]
    rows = [("d", 0, "Text", 0, 0, 1, 1, t, i) for i, t in enumerate(texts)]
    e = spark.createDataFrame(rows, "document_id string, page int, class string, x int, y int, w int, h int, content string, elem_pos int")
    index = V.build_index(e, 128).cache()
    assert index.count() == 4
    encode = V.hashed_vectors(128)
    import pandas as pd

    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1.0)
    q = unit(encode(pd.Series(["apples on trees"]))[0])
    want = sorted(((round(float(unit(encode(pd.Series([t]))[0]) @ q), 4), t) for t in texts[:4]), reverse=True)
    got = [(r.score, r.content) for r in V.search(index, spark.createDataFrame([(1, "apples on trees")], "query_id int, text string"), 2, dims=128).orderBy("rank").collect()]
    assert [c for _, c in got] == [t for _, t in want[:2]] and [s for s, _ in got] == pytest.approx([s for s, _ in want[:2]], abs=2e-4)
    with pytest.raises(ValueError, match="dimensions"):
        V.encoder(V.hashed_vectors, 100)


def test_process_pages(spark, sf):
    from foliant.operators import documents as D
    from foliant.plans import pipelines

    pages = spark.createDataFrame([(0, '<h1>The title of it</h1><p>the cat and the dog is in the house</p><table><tr><td>1</td></tr></table><script>x</script>'), (1, "<p> </p>"), (2, None)], "page_id long, html string")
    say = lambda prompts, ids: prompts + " numbers"
    e = pipelines.process(pages, F.lit("doc"), describe=say, stop=2)
    got = [(r.page, r["class"], r.content, r.language) for r in e.orderBy("page", "y").collect()]
    assert got == [(0, "Title", "The title of it", "en"), (0, "Text", "the cat and the dog is in the house", "en"), (0, "Table", "numbers", None), (1, "Text", None, None)]
    (doc,) = D.to_documents(e).collect()
    assert doc.n == 4 and '"content":null' in doc.payload
    assert all(r.valid for r in QUERIES["q_process_pages"](spark, sf).collect())


def test_gate_and_reports(spark):
    from foliant.plans import pipelines

    make = spark.createDataFrame
    labels = make([("a", 1, 0, 0.5, 0.5, 0.1, 0.1), ("a", 2, 9, -0.1, 0.5, 0.1, 0.1), ("b", 1, 1, 0.2, 0.2, 0.0, 0.2)], "file string, line_no int, class_id int, x double, y double, w double, h double")
    files = make([("a",), ("b",), ("c",)], "file string")
    images = make([("i.png", 500, 500, 0), ("j.png", None, None, 0)], "path string, width int, height int, exif_bytes int")
    texts, licenses = make([("x", "mail a@b.org")], "id string, text string"), make([("f", "MIT License by the author")], "folder string, text string")
    pages = make([("p", "plain text", 3.0), ("p", "more", 2.0)], "page string, text string, angle double")
    t = pipelines.gate(labels, files, images, texts, licenses, pages, fix=True)
    assert {r.issue: r.n for r in t["findings"].collect()} == {"unknown_class": 1, "invalid_coords": 2, "empty_labels": 1, "unreadable": 1}
    row = t["status"].first()
    assert (row.critical_issues, row.skewed_percentage, row.licensed, row.status) == (4, 100.0, True, "NEEDS ATTENTION")
    assert {r.file: r["action"] for r in t["actions"].collect()} == {"a": "fix", "b": "quarantine", "c": "quarantine"}
    text = reports.gate_report(t)
    assert text.startswith("# Pre-upload Report") and "NEEDS ATTENTION" in text and "High percentage of skewed pages" in text and "| invalid_coords | 2 | 2 |" in text
    from foliant.operators import quality as Q

    pii = Q.scan_pii(texts, "id", "text")
    assert "a*****g" in reports.pii_report(pii, Q.pii_totals(pii, "id", texts))
    board = E.dashboard(make([("bleu", 0.5)], "metric string, value double"))
    assert "<td>bleu</td><td>0.500</td><td>good</td>" in reports.dashboard_html(board)
    assert reports.table([]) == "None." and "a \\| b" in reports.table([{"x": "a | b"}])


def test_autopilot(spark):
    names = "page_id long, ann_no long, x long, y long, w long, h long, class_id int"
    gt = spark.createDataFrame([(1, 1, 0, 0, 10, 10, 0), (2, 1, 0, 0, 10, 10, 0)], names)
    images = spark.createDataFrame([(1, "1.png", 50, 50), (2, "2.png", 50, 50)], "page_id long, file_name string, width int, height int")
    classes = spark.createDataFrame([(0, "Text")], "class_id int, name string")
    seen = []

    def predict(cycle, labels):
        seen.append(labels is None or labels.count())
        return spark.createDataFrame([(1, 1, 0, 0, 10, 10, 0, 0.9), (2, 1, 0, 0 if cycle == 2 else 30, 10, 10, 0, 0.5 + cycle / 10)], names + ", score double")

    rounds = A.autopilot(gt, images, classes, predict, 2)
    rows = [r["summary"].first() for r in rounds]
    assert [(r.cycle, r.false_positives, r.false_negatives, r.selected_samples, r.total_labels) for r in rows] == [(1, 1, 1, 2, 2), (2, 0, 0, 2, 2)] and seen == [True, 2]


def test_license_report_counts_all_folders(spark, monkeypatch):
    monkeypatch.setattr(reports, "MOST_ROWS", 5)
    monkeypatch.setattr(reports.rows_of, "__defaults__", (5,))
    texts = [(f"f{i:02}", "MIT License, give credit" if i % 3 else None) for i in range(17)]
    out = reports.license_report(Q.folder_licenses(spark.createDataFrame(texts, "folder string, t string"), "folder", "t"))
    assert "**Total folders:** 17" in out and "**Licensed folders:** 11" in out and "**Unknown license folders:** 6" in out
    assert out.count("| f0") == 5 and "12 more are not shown." in out and "- No license files found in dataset" in out


def test_swift_codes_in_any_case(spark):
    df = spark.createDataFrame([("by deutdeff500 or DEUTDEFF",)], "t string")
    hits = lambda **how: [r.original for r in df.select(F.explode(X.pii_hits(F.col("t"), ("swift",), **how))).select("col.*").collect()]
    assert hits() == ["DEUTDEFF"] and hits(swift_any_case=True) == ["deutdeff500", "DEUTDEFF"]
