"""Documents read in byte ranges of any size against the JSON module, and documents written without a row for all."""

import json
import random

import pytest
from pyspark.sql import functions as F

from foliant.sources import annotations, largejson


def document(seed, n=60):
    rng = random.Random(seed)
    words = ["plain", 'quote " and }', "back\\slash", "{[", "\\\"}", "é漢", "", "]}", '"', '": [']
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(4)))
    anns = [{"id": i, "image_id": rng.randrange(9), "category_id": rng.choice([1, 2, None]), "bbox": [rng.randrange(9) / 2 for _ in range(rng.choice([4, 4, 4, 3]))], "note": text(), "segmentation": rng.choice([[[1, 2]], {"counts": "a}b", "size": [1, {"x": {"y": "}"}}]}, []])} for i in range(n)]
    return {"info": {"annotations": [{"id": -1}], "by": "{ \" }"}, "images": [{"id": i, "file_name": f"{text()}{i}.png", "width": 9, "height": 8} for i in range(9)], "annotations": anns, "categories": [{"id": 1, "name": text()}, {"id": 2, "name": "b"}], "tags": ["}", 1, [{"id": 5}]], "empty": []}


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [97, 700, 1 << 20])
def test_elements_equal_the_json_module(spark, tmp_path, small_ranges, size):
    small_ranges(size)
    docs = {}
    for k, indent in enumerate((None, 1)):
        docs[f"{k}.json"] = document(k, 25 if size < 100 else 60)
        (tmp_path / f"{k}.json").write_text(json.dumps(docs[f"{k}.json"], indent=indent, ensure_ascii=bool(k)) + "\n \n", encoding="utf-8")
    got = largejson.elements(spark, str(tmp_path)).collect()
    for name, doc in docs.items():
        for section in ("images", "annotations", "categories", "empty"):
            found = sorted((r.place, r.text) for r in got if r.file.endswith(name) and r.section == section)
            assert [json.loads(t) for _, t in found] == doc[section], (name, section)
            assert len({p for p, _ in found}) == len(found)


def test_large_coco_equals_the_small_reader(spark, tmp_path, small_ranges):
    (tmp_path / "c.json").write_text(json.dumps(document(5)), encoding="utf-8")
    want = annotations.read_coco(spark, str(tmp_path / "c.json"))
    small = {k: sorted(tuple(r) for r in (v.orderBy("ann_pos").drop("ann_pos") if k == "annotations" else v).collect()) for k, v in want.items()}
    small_ranges(300)
    got = annotations.read_large_coco(spark, str(tmp_path / "c.json"))
    assert {k: sorted(tuple(r) for r in v.drop("ann_pos").collect()) for k, v in got.items()} == small
    places = [r.ann_id for r in got["annotations"].orderBy("ann_pos").collect()]
    assert places == sorted(places)


def test_written_documents_read_back(spark, tmp_path):
    rows = spark.range(500).select(F.col("id").alias("ann_id"), (F.col("id") % 7).alias("image_id"), F.lit(1).alias("category_id"), *(F.lit(float(i + 1)).alias(c) for i, c in enumerate("xywh")))
    images = spark.range(7).select(F.col("id").alias("image_id"), F.concat(F.lit('a"}'), F.col("id").cast("string")).alias("file_name"), F.lit(5).alias("width"), F.lit(6).alias("height"))
    names = spark.createDataFrame([], "category_id int, name string")
    annotations.write_large_coco(images, rows.repartition(5), names, str(tmp_path / "out"))
    files = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    doc = json.loads(files[0].read_text())
    assert len(files) == 1 and [a["id"] for a in doc["annotations"]] == list(range(500)) and doc["categories"] == []
    assert doc["images"][3] == {"id": 3, "file_name": 'a"}3', "width": 5, "height": 6} and doc["annotations"][0]["area"] == 12.0
    assert annotations.read_large_coco(spark, str(tmp_path / "out"))["annotations"].count() == 500


def test_documents_in_parts_read_back(spark, tmp_path, small_ranges):
    """Every task writes and reads a part; no row and no task holds the document."""
    rows = spark.range(3000).select(F.col("id").alias("ann_id"), (F.col("id") % 7).alias("image_id"), F.lit(1).alias("category_id"), *(F.lit(float(i + 1)).alias(c) for i, c in enumerate("xywh")))
    images = spark.range(7).select(F.col("id").alias("image_id"), F.concat(F.lit('a"}[\n": ['), F.col("id").cast("string")).alias("file_name"), F.lit(5).alias("width"), F.lit(6).alias("height"))
    names = spark.createDataFrame([(1, ',"x": [')], "category_id int, name string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    annotations.write_coco_parts(images, rows.repartition(5), names, str(tmp_path / "out"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "out").glob("*/part-*"))
    doc = json.loads("".join(p.read_text() for p in files))
    assert len(files) > 3 and [a["id"] for a in doc["annotations"]] == list(range(3000)) and doc["images"][3]["file_name"] == 'a"}[\n": [3'
    small_ranges(4000)
    back = annotations.read_coco_parts(spark, str(tmp_path / "out"))
    assert [(r.ann_pos, r.ann_id) for r in back["annotations"].orderBy("ann_pos").collect()] == [(i, i) for i in range(3000)]
    assert [r.name for r in back["categories"].collect()] == [',"x": ['] and back["images"].count() == 7
