"""Annotation files, images, streams, and operators on a few rows."""

import json
import struct

from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import text as X
from foliant.operators import matching as M
from foliant.operators import relational as R
from foliant.sources import annotations as A
from foliant.streaming.ingest import ingest_new_files


def test_coco_and_yolo(spark, tmp_path):
    doc = {
        "images": [{"id": 7, "file_name": "leaf.one.png", "width": 400, "height": 250}],
        "annotations": [{"id": 31, "image_id": 7, "category_id": 4, "bbox": [20, 50, 80, 25], "area": 2000, "iscrowd": 0}, {"id": 32, "image_id": 7, "category_id": 4, "bbox": [1, 2, 3]}, {"id": 33, "image_id": 8, "category_id": 4, "bbox": [1, 2, 3, 4]}],
        "categories": [{"id": 4, "name": "Caption"}],
    }
    (tmp_path / "c.json").write_text(json.dumps(doc))
    t = A.read_coco(spark, str(tmp_path / "c.json"))
    boxes = A.coco_to_boxes(t, spark.createDataFrame([("Caption", 2)], "name string, class_id int"))
    assert boxes.count() == 1
    A.write_yolo(boxes, str(tmp_path / "y"), F.col("width"), F.col("height"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "y")).collect()]
    assert lines == ["2 0.150000 0.250000 0.200000 0.100000"]
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "leaf.one.txt").write_text("1 2 3\n" + lines[0] + "\nx 1 1 1 1\n0 0.5 0.5 0.1 0.2\n")
    labels = A.read_yolo(spark, str(tmp_path / "l"))
    assert sorted((r.stem, r.line_no, r.class_id) for r in labels.collect()) == [("leaf.one", 2, 2), ("leaf.one", 4, 0)]
    back = A.yolo_to_coco(labels, spark.createDataFrame([("zero", 9, 9), ("leaf.one", 400, 250), ("none", 5, 5)], "stem string, width int, height int"))
    assert {r.stem: r.image_id for r in back["images"].collect()} == {"leaf.one": 0, "none": 1, "zero": 2}
    first, second = back["annotations"].orderBy("ann_id").collect()
    assert (first.ann_id, first.image_id, second.ann_id, second.class_id) == (0, 0, 1, 0)
    assert all(abs(a - b) < 1e-6 for a, b in zip((first.x, first.y, first.w, first.h), (20, 50, 80, 25), strict=True))
    A.write_coco(t["images"], t["annotations"], t["categories"], str(tmp_path / "out"))
    assert sorted(r.bbox for r in spark.read.json(str(tmp_path / "out/annotations")).collect()) == [[1.0, 2.0, 3.0, 4.0], [20.0, 50.0, 80.0, 25.0]]


def test_image_sizes(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 320, 17))
    (tmp_path / "b.jpg").write_bytes(b"\xff\xd8\xff\xe0\0\4\0\0\xff\xc0\0\x11\x08" + struct.pack(">HH", 30, 40) + b"\0" * 9)
    (tmp_path / "c.png").write_bytes(b"junk")
    got = {r.path[-5:]: (r.width, r.height) for r in A.image_sizes(spark, str(tmp_path)).collect()}
    assert got == {"a.png": (320, 17), "b.jpg": (40, 30), "c.png": (None, None)}


def test_streaming_ingest_takes_each_file_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    run = lambda: ingest_new_files(spark, str(src), "a int", str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    (src / "1.json").write_text('{"a": 1}\n')
    run()
    (src / "2.json").write_text('{"a": 2}\n')
    run()
    run()
    assert sorted(r.a for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 2]


def test_windowed_counts_of_a_stream(spark, sf, tmp_path):
    """Counts by hour of a stream of files, as of the whole table."""
    from foliant.streaming.ingest import windowed_counts

    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    run = windowed_counts(stream, "ts", "event_type", "1 hour", "60 days").writeStream.format("memory").queryName("hours").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination()
    got = {(r.window.start, r.event_type): r.n for r in spark.table("hours").collect()}
    want = {(r.h, r.event_type): r["count"] for r in events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h"), "event_type").count().collect()}
    assert got == want


def test_boxes_moved_into_the_page(spark):
    rows = [(5, 6, 30, 20), (90, 70, 40, 30), (-12, 3, 10, 10), (3, 4, -7, 8), (0, 0, 500, 500)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x int, y int, w int, h int").orderBy("i")
    box = tuple(F.col(c) for c in "xywh")
    assert [tuple(r) for r in df.select(*G.clip_keeping_size(box, 100, 80)).collect()] == [(5, 6, 30, 20), (60, 50, 40, 30), (0, 3, 10, 10), (3, 4, 0, 8), (0, 0, 100, 80)]
    assert [tuple(r) for r in df.select(*G.clamp_origin(box, 100, 80)).collect()] == [(5, 6, 30, 20), (90, 70, 10, 10), (0, 3, 10, 10), (3, 4, 1, 8), (0, 0, 100, 80)]
    assert [r[0] for r in df.select(G.iou(box, box)).collect()] == [1.0, 1.0, 1.0, 0.0, 1.0]


def test_direction_redaction_licence(spark):
    df = spark.createDataFrame([("شكرا",), ("שלום abcd",), ("plain",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(X.direction(F.col("t"))[1]).collect()] == ["rtl", "mixed", "ltr", "ltr", "ltr"]
    hits = spark.createDataFrame([("anna@example.org", "email"), ("123-45-6789", "ssn"), ("1/2/1990", "dob"), ("1990-02-01", "dob"), ("abcd", "pan"), ("x@", "email"), ("secret", "other")], "o string, k string")
    assert [r[0] for r in hits.select(X.redact(F.col("o"), F.col("k"))).collect()] == ["a**************g", "12*******89", "1/2/****", "****-02-01", "****", "**", "******"]
    lic = spark.createDataFrame([("MIT License and Apache License",), ("nothing",), (None,), ("No copyright here. Credit is due. To Ann\n\nmore",)], "t string")
    assert [r[0] for r in lic.select(X.license_type(F.col("t"))).collect()] == ["MIT", "Unknown", "Unknown", "Public Domain"]
    assert [r[0] for r in lic.select(X.attribution_text(F.col("t"))).collect()] == ["", "", "", "To Ann"]


def test_greedy_ties_and_thresholds(spark):
    gt = spark.createDataFrame([(1, 1, 0, 0, 10, 10, 0), (1, 2, 100, 0, 10, 10, 1), (2, 1, 0, 0, 4, 4, 0)], "page_id long, ann_no int, x long, y long, w long, h long, class_id int")
    pred = spark.createDataFrame([(1, 1, 0, 0, 10, 20, 0, 0.5), (1, 2, 0, 0, 10, 10, 0, 0.9), (1, 3, 100, 0, 10, 10, 0, 0.8), (3, 1, 0, 0, 1, 1, 0, 0.1)], "page_id long, ann_no int, x long, y long, w long, h long, class_id int, score double")
    assert {tuple(r) for r in M.match_confusion(gt, pred).collect()} == {(0, 0, 1), (1, 0, 1)}
    assert {(r.page_id, r.pred_no): r.correct for r in M.match_calibration(gt, pred).collect()} == {(1, 1): True, (1, 2): False, (1, 3): False}
    assert {tuple(r) for r in M.mine_errors(gt, pred).collect()} == {(1, "fn", 2), (2, "fn", 1), (1, "fp", 1), (1, "fp", 3)}
    assert {(r.page_id, r.ann_no) for r in M.suppress(pred).collect()} == {(1, 2), (1, 3), (3, 1)}
    assert M.mine_errors(gt.limit(0), pred).count() == 0 and M.match_confusion(gt, pred.limit(0)).count() == 0


def test_split_sizes_and_eviction(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    assert {r.split: r["count"] for r in R.split_rows(rows, ["k"]).groupBy("split").count().collect()} == {"train": 800, "val": 100, "test": 100}
    strata = rows.withColumn("s", F.when(F.col("k") < 2, "two").when(F.col("k") < 12, None).otherwise("rest"))
    got = {(r.s, r.split): r["count"] for r in R.split_rows(strata, ["k"], ["s"]).groupBy("s", "split").count().collect()}
    assert got == {("two", "train"): 2, (None, "train"): 8, (None, "val"): 1, (None, "test"): 1, ("rest", "train"): 790, ("rest", "val"): 98, ("rest", "test"): 100}
    cache = spark.createDataFrame([(f"a:{i}", 10, i, 1) for i in range(10)], "key string, size_bytes long, last_accessed long, access_count long")
    assert R.evict(cache, 100).count() == 0 and [r.key for r in R.evict(cache, 90).orderBy("key").collect()] == ["a:0", "a:1", "a:2"]


def test_documents_in_parts_equal_whole_documents(spark, tmp_path):
    import json

    from foliant.operators.documents import to_documents
    from foliant.sources import files

    k = F.col("id")
    e = spark.range(4000).select(
        F.when(k % 3 > 0, F.concat(F.lit('d "'), (k % 3).cast("string"))).alias("document_id"), (k % 5).cast("int").alias("page"), F.when(k % 4 > 0, "Text").otherwise("Figure").alias("class"), (k % 11).alias("x"), (k % 13).alias("y"),
        F.lit(4).alias("w"), F.lit(5).alias("h"), F.when(k % 4 > 0, F.concat(F.lit('"a": [\n,{é'), k.cast("string"))).alias("content"), F.lit(None).cast("string").alias("language"), F.create_map(F.lit("k"), k.cast("string")).alias("meta"), k.alias("elem_pos"),
    ).repartition(6)
    want = {r.document_id: json.loads(r.payload) for r in to_documents(e).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files.write_documents(e, str(tmp_path / "out"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [sorted(d.glob("part-*")) for d in (tmp_path / "out").iterdir() if d.is_dir()]
    assert max(map(len, parts)) > 1
    whole = [json.loads("".join(p.read_text() for p in ps)) for ps in parts]
    assert {d["document_id"]: d for d in whole} == want
    got = sorted((r.document_id, r.elem_pos, r.e.content, r.e.meta["k"]) for r in files.read_documents(spark, str(tmp_path / "out")).collect())
    assert got == sorted((d, i, x["content"], x["meta"]["k"]) for d, t in want.items() for i, x in enumerate(t["elements"]))


def test_boxes_are_not_dealt_by_class(spark):
    """Classes meet boxes without a shuffle by class, whose few keys would be as few tasks; what misses a label goes."""
    ann = spark.range(20).selectExpr("id ann_id", "id % 3 image_id", "cast(id % 4 as int) category_id", "1.0 x", "1.0 y", "2.0 w", "2.0 h")
    images = spark.range(2).selectExpr("id image_id", "concat('a.', id, '.png') file_name")
    names = spark.createDataFrame([(0, "Text"), (1, "Title"), (2, "Other"), (2, "Text")], "category_id int, name string")
    boxes = A.coco_to_boxes({"annotations": ann, "images": images, "categories": names}, spark.createDataFrame([("Title", 0), ("Text", 7), ("None", 8)], "name string, class_id int"))
    plan = boxes._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(name" not in plan and "hashpartitioning(category_id" not in plan
    want = [(i, f"a.{i % 3}", k) for i in range(20) if i % 3 < 2 for k in {0: [7], 1: [0], 2: [7], 3: []}[i % 4]]
    assert sorted((r.ann_id, r.stem, r.class_id) for r in boxes.collect()) == want
