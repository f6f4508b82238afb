"""Readers and writers of annotation files: COCO documents, YOLO label folders, image headers, label CSVs."""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.operators.ranks import ordered

COCO = """
images array<struct<id:bigint,file_name:string,width:int,height:int>>,
annotations array<struct<id:bigint,image_id:bigint,category_id:int,bbox:array<double>,area:double,iscrowd:int,score:double>>,
categories array<struct<id:int,name:string>>"""


def read_coco(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """images, annotations (with ann_pos, the order in the file) and categories of COCO JSON documents. Annotations
    without four box numbers or a category go."""
    doc = spark.read.schema(COCO.replace("\n", "")).option("multiLine", True).json(path)
    ann = doc.select(F.posexplode("annotations").alias("ann_pos", "a")).where("size(a.bbox) = 4 and a.category_id is not null")
    box = [F.col("a.bbox")[i].alias(c) for i, c in enumerate("xywh")]
    return {
        "images": doc.select(F.explode("images").alias("i")).select(F.col("i.id").alias("image_id"), "i.file_name", "i.width", "i.height"),
        "annotations": ann.select("ann_pos", F.col("a.id").alias("ann_id"), "a.image_id", "a.category_id", *box, "a.area", "a.iscrowd", "a.score"),
        "categories": doc.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"), "c.name"),
    }


def read_large_coco(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """What read_coco gives, of documents of any size: they are read in byte ranges and never held whole. ann_pos grows
    along the file, with gaps."""
    from foliant.sources.largejson import elements

    found = elements(spark, path)
    return _coco_of(lambda section, kind: found.where(F.col("section") == section).select("place", F.from_json("text", kind).alias("a")))


def read_coco_parts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """What read_coco gives, of the document that write_coco_parts wrote below path: ann_pos is the id, by which it is
    ordered."""
    from foliant.sources.largejson import read_part

    return _coco_of(lambda section, kind: read_part(spark, path, section, kind).withColumn("place", F.col("a.id")))


def _coco_of(of: Callable[[str, str], DataFrame]) -> dict[str, DataFrame]:
    """The tables of a COCO document's elements, of(section, kind) being its (place, a)."""
    kinds = dict(re.findall(r"(\w+) array<(struct<.*>)>", COCO))
    ann = of("annotations", kinds["annotations"]).where("size(a.bbox) = 4 and a.category_id is not null")
    box = [F.col("a.bbox")[i].alias(c) for i, c in enumerate("xywh")]
    return {
        "images": of("images", kinds["images"]).select(F.col("a.id").alias("image_id"), "a.file_name", "a.width", "a.height"),
        "annotations": ann.select(F.col("place").alias("ann_pos"), F.col("a.id").alias("ann_id"), "a.image_id", "a.category_id", *box, "a.area", "a.iscrowd", "a.score"),
        "categories": of("categories", kinds["categories"]).select(F.col("a.id").alias("category_id"), "a.name"),
    }


def _coco_sections(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> dict:
    ann = annotations.select(F.col("ann_id").alias("id"), "image_id", "category_id", F.array(*"xywh").alias("bbox"), (F.col("w") * F.col("h")).alias("area"), F.lit(0).alias("iscrowd"))
    pictures = images.select(F.col("image_id").alias("id"), "file_name", "width", "height")
    names = categories.select(F.col("category_id").alias("id"), "name")
    return {"images": (pictures, F.col("id")), "annotations": (ann, F.col("id")), "categories": (names, F.col("id"))}


def write_large_coco(images: DataFrame, annotations: DataFrame, categories: DataFrame, path: str) -> None:
    """One COCO document in one file below path, annotations in the order of ann_id; no row holds more than one of them."""
    from foliant.sources.largejson import write_document

    write_document(_coco_sections(images, annotations, categories), path)


def write_coco_parts(images: DataFrame, annotations: DataFrame, categories: DataFrame, path: str) -> None:
    """write_large_coco in many files, which put one after another by name are the document; every task writes its own."""
    from foliant.sources.largejson import write_parts

    write_parts(_coco_sections(images, annotations, categories), path)


def write_coco(images: DataFrame, annotations: DataFrame, categories: DataFrame, path: str) -> None:
    """Annotations as JSON lines (image by image), images and categories beside them: three tables below path. One
    nested document would hold the whole set in one row."""
    images.write.mode("overwrite").json(f"{path}/images")
    categories.write.mode("overwrite").json(f"{path}/categories")
    out = annotations.select(F.col("ann_id").alias("id"), "image_id", "category_id", F.array(*"xywh").alias("bbox"), (F.col("w") * F.col("h")).alias("area"), F.lit(0).alias("iscrowd"))
    out.repartition("image_id").write.mode("overwrite").json(f"{path}/annotations")


def read_yolo(spark: SparkSession, path: str) -> DataFrame:
    """(file, stem, line_no, class_id, xc, yc, w, h) of label files; lines of other than five tokens, or not numbers, go."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value"))
    lines = whole.select("file", (F.col("line_no") + 1).alias("line_no"), F.split(F.trim("value"), r"\s+").alias("t")).where("size(t) = 5")
    stem = F.regexp_extract("file", r"([^/]+?)(\.[^./]*)?$", 1)
    out = lines.select("file", stem.alias("stem"), "line_no", F.try_to_number(F.col("t")[0], F.lit("999999999")).cast("int").alias("class_id"), *(F.expr(f"try_cast(t[{i}] as double)").alias(c) for i, c in enumerate(("xc", "yc", "w", "h"), 1)))
    return out.dropna()


def write_yolo(boxes: DataFrame, path: str, width, height) -> None:
    """One folder a stem (stem=...), lines `class xc yc w h` in ann_pos order; boxes have stem, class_id, x, y, w, h."""
    y = G.to_yolo(tuple(F.col(c) for c in "xywh"), width, height)
    line = F.concat_ws(" ", F.col("class_id").cast("string"), *(F.format_string("%.6f", c) for c in y))
    boxes.select("stem", "ann_pos", line.alias("value")).repartition("stem").sortWithinPartitions("stem", "ann_pos").select("stem", "value").write.mode("overwrite").partitionBy("stem").text(path)


def coco_to_boxes(tables: dict[str, DataFrame], labels: DataFrame) -> DataFrame:
    """Annotations with their image and the id of their class in labels (name, class_id); what misses either goes.
    Categories and labels are as few as classes and are broadcast: dealt by class, all boxes of one would be one task's."""
    named = tables["categories"].join(F.broadcast(labels), "name")
    ann = tables["annotations"].join(tables["images"], "image_id").join(F.broadcast(named), "category_id")
    return ann.where("w > 0 and h > 0").withColumn("stem", F.regexp_replace("file_name", r"\.[^.]*$", ""))


def yolo_to_coco(labels: DataFrame, images: DataFrame) -> dict[str, DataFrame]:
    """Images and annotations numbered from 0, by stem and by image and line, from YOLO labels; images without labels
    stay, boxes of no area go."""
    numbered = ordered(images, ["stem"]).withColumn("image_id", F.col("rank") - 1).drop("rank")
    x, y, w, h = G.from_yolo(tuple(F.col(c) for c in ("xc", "yc", "w", "h")), F.col("width"), F.col("height"))
    ann = labels.join(numbered, "stem").select("image_id", "line_no", "class_id", x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h")).where("w > 0 and h > 0")
    return {"images": numbered, "annotations": ordered(ann, ["image_id", "line_no"]).withColumn("ann_id", F.col("rank") - 1).drop("rank", "line_no")}


def header_size(data: bytes) -> tuple[int, int] | None:
    """Width and height in a PNG's or JPEG's header; None for anything else."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data) and data[at] == 0xFF:
            kind, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
            at += 2 + size
    return None


def image_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, width, height) of the images below a folder; unreadable ones have null sizes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{jpg,jpeg,png,JPG,JPEG,PNG}").load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes = [header_size(bytes(c)) or (None, None) for c in b["head"]]
            yield pd.DataFrame({"path": b["path"], "length": b["length"], "width": pd.array([s[0] for s in sizes], "Int32"), "height": pd.array([s[1] for s in sizes], "Int32")})

    return files.select("path", "length", F.substring("content", 1, 65536).alias("head")).mapInPandas(run, "path string, length long, width int, height int")


def language_labels(spark: SparkSession, path: str) -> DataFrame:
    """(text, language) of a CSV with a header; blanks trimmed, rows with an empty field gone."""
    rows = spark.read.schema("text string, language string").option("header", True).option("multiLine", True).csv(path)
    return rows.select(*(F.trim(c).alias(c) for c in rows.columns)).where("text <> '' and language <> ''")
