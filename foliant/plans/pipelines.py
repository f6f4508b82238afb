"""Whole runs made of operators: conversion, ingest, splits and subsets, the dataset gate, documents, search."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.operators import documents as D
from foliant.operators import models
from foliant.operators import quality as Q
from foliant.operators import relational as R
from foliant.operators import vectors as V
from foliant.operators.ranks import ordered
from foliant.session import shared_dir
from foliant.sources import annotations as A
from foliant.sources import files as S

ANNOTATED = "annotations array<struct<bbox:array<double>,category_id:int,category_name:string>>, corruption map<string,string>"


def label_map(spark: SparkSession, classes: list[str]) -> DataFrame:
    return spark.createDataFrame([(c, i) for i, c in enumerate(classes)], "name string, class_id int")


def coco_to_yolo(tables: dict[str, DataFrame], classes: list[str]) -> DataFrame:
    """(stem, value): the lines of each label file; boxes moved into their image first, those of no size left out."""
    spark = tables["images"].sparkSession
    boxes = A.coco_to_boxes(tables, label_map(spark, classes))
    clipped = G.clip_keeping_size(tuple(F.col(c) for c in "xywh"), F.col("width"), F.col("height"))
    rows = boxes.select("stem", "ann_pos", "class_id", "width", "height", *(c.alias(n) for c, n in zip(clipped, "xywh", strict=True))).where("w > 0 and h > 0")
    yolo = G.to_yolo(tuple(F.col(c) for c in "xywh"), F.col("width"), F.col("height"))
    return S.label_lines(rows.select("stem", "ann_pos", "class_id", *(c.alias(n) for c, n in zip(yolo, ("xc", "yc", "wn", "hn"), strict=True))))


def class_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n) of annotations by the name of their category, images and categories without any included as 0."""
    return tables["categories"].join(tables["annotations"].groupBy("category_id").agg(F.count("*").alias("n")), "category_id", "left").select("name", F.coalesce("n", F.lit(0)).alias("n"))


def page_number(name: Column) -> Column:
    """The number after `page` in a file name, a blank or underscores between; 0 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"(?i)page[_\s]*(\d+)", 1), F.lit("")).cast("long"), F.lit(0).cast("long"))


def split_images(images: DataFrame, how: str = "uniform", keys: tuple[str, ...] = ("language", "doctype"), seed: int = 42, train: float = 0.8, val: float = 0.1, test: float = 0.1) -> DataFrame:
    """images with split: uniform, stratified (by keys; what an image lacks is unknown) or page (all images of a page
    number, from the column page or else the file name, together)."""
    R.split_proportions(train, val, test)
    if how == "page":
        page = page_number(F.col("file_name"))
        rows = images.withColumn("__page", F.coalesce(F.col("page").cast("long"), page) if "page" in images.columns else page)
        pages = R.split_rows(rows.select("__page").distinct(), ["__page"], [], seed, train, val)
        return rows.join(pages, "__page").drop("__page")
    if how == "uniform":
        return R.split_rows(images, ["image_id"], [], seed, train, val)
    rows = images.withColumns({k: F.lit(None).cast("string") for k in keys if k not in images.columns})
    return R.split_rows(rows, ["image_id"], list(keys), seed, train, val).select(*images.columns, "split")


def split_tables(images: DataFrame, annotations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(annotations with their image's split, sizes of the splits)."""
    rows = annotations.join(images.select("image_id", "split"), "image_id")
    sizes = images.groupBy("split").agg(F.count("*").alias("images")).join(rows.groupBy("split").agg(F.count("*").alias("annotations")), "split", "left")
    return rows, sizes.select("split", "images", F.coalesce("annotations", F.lit(0)).alias("annotations"))


def numbered(images: DataFrame, annotations: DataFrame, first: int = 0) -> tuple[DataFrame, DataFrame]:
    """Images with image_id by file name and annotations with ann_id by image and line, both counted from `first`. Images
    have file_name, annotations file_name and line_no."""
    ids = ordered(images, ["file_name"]).withColumn("image_id", F.col("rank") - 1 + first).drop("rank")
    rows = annotations.join(ids.select("file_name", "image_id"), "file_name")
    return ids, ordered(rows, ["image_id", "line_no"]).withColumn("ann_id", F.col("rank") - 1 + first).drop("rank")


def ingest(spark: SparkSession, folder: str, names: dict[int, str] | None = None, split: tuple[float, float, float] = (0.9, 0.1, 0.0), seed: int = 42, done: DataFrame | None = None) -> dict[str, DataFrame]:
    """A folder of images with a JSON file each, as tables: images (image_id, file_name, width, height, split,
    file_attributes), annotations (ann_id, image_id, category_id, x, y, w, h and the fractions xc, yc, wn, hn), categories
    (category_id, orig_id, name), stats (images, boxes, dropped_boxes), missing (images without JSON).

    Boxes are moved into their image; those of a side up to a pixel are dropped and counted. Ids become 0, 1, ... in
    their order; a category's name is that of `names`, else its commonest, the first seen of equals, else class_<id>.
    With `done` (value), files whose stem is in it are left out.
    """
    pairs, missing = S.pairs_by_image(S.image_documents(spark, folder).select("path", "width", "height"), S.listing(spark, folder, "*.json"))
    if done is not None:
        pairs = S.not_done(pairs, done)
    sizes = S.image_documents(spark, folder).select(F.col("path").alias("image"), "width", "height").where("width is not null")
    docs = S.whole_texts(spark, folder).select(F.regexp_replace("file", "^file:/+", "file:/").alias("document"), F.from_json("value", ANNOTATED).alias("d"))
    whole = pairs.withColumn("document", F.regexp_replace("document", "^file:/+", "file:/")).join(docs, "document").join(sizes, "image")
    images = R.split_rows(whole.select(S.base(F.col("image")).alias("file_name"), "stem", "width", "height", F.col("d.corruption").alias("file_attributes")), ["stem"], [], seed, split[0], split[1])
    raw = whole.select(S.base(F.col("image")).alias("file_name"), "width", "height", F.posexplode("d.annotations").alias("line_no", "a")).where("size(a.bbox) = 4 and a.category_id is not null")
    raw = raw.select("file_name", "line_no", "width", "height", F.col("a.category_id").alias("orig_id"), F.nullif("a.category_name", F.lit("")).alias("name"), *(F.col("a.bbox")[i].alias(c) for i, c in enumerate("xywh")))
    clamped = G.clamp_origin(tuple(F.col(c) for c in "xywh"), F.col("width"), F.col("height"), 0)
    moved = raw.select("file_name", "line_no", "width", "height", "orig_id", "name", *(c.alias(n) for c, n in zip(clamped, "xywh", strict=True))).withColumn("__kept", (F.col("w") > 1) & (F.col("h") > 1))
    kept = moved.where("__kept").drop("__kept")
    ids = R.dense_ids(kept, "orig_id").select(F.col("id").alias("orig_id"), F.col("new_id").cast("int").alias("category_id"))
    commonest = R.majority(kept.where("name is not null").withColumn("__at", F.struct("file_name", "line_no")), "orig_id", "name", "__at").drop("n")
    given = spark.createDataFrame(list((names or {}).items()), "orig_id int, given string")
    categories = ids.join(commonest, "orig_id", "left").join(given, "orig_id", "left").select("category_id", "orig_id", F.coalesce("given", "name", F.concat(F.lit("class_"), F.col("orig_id").cast("string"))).alias("name"))
    images, boxes = numbered(images, kept.join(F.broadcast(ids), "orig_id").drop("name"))
    yolo = [G.clamp(c, 0, 1) for c in G.to_yolo(tuple(F.col(c) for c in "xywh"), F.col("width"), F.col("height"))]
    annotations = boxes.select("ann_id", "image_id", "category_id", *(F.col(c).cast("int").alias(c) for c in "xywh"), *(c.alias(n) for c, n in zip(yolo, ("xc", "yc", "wn", "hn"), strict=True)))
    stats = whole.agg(F.count("*").alias("images")).crossJoin(moved.agg(F.count_if("__kept").alias("boxes"), F.count_if(~F.col("__kept")).alias("dropped_boxes")))  # one row each
    return {"images": images.select("image_id", "file_name", "stem", "width", "height", "split", "file_attributes"), "annotations": annotations, "categories": categories, "stats": stats, "missing": missing}


def write_ingested(tables: dict[str, DataFrame], path: str) -> None:
    """Below path: coco/<split> documents, yolo/labels (a row a file), yolo/data.yaml, cat_map.json and .done."""
    spark = tables["images"].sparkSession
    names = [r.name for r in tables["categories"].orderBy("category_id").collect()]  # as few as classes
    for split in ("train", "val", "test"):
        images = tables["images"].where(F.col("split") == split)
        S.coco_document(images, tables["annotations"].join(images.select("image_id"), "image_id", "left_semi"), tables["categories"]).coalesce(1).write.mode("overwrite").text(f"{path}/coco/{split}")
    labels = tables["annotations"].join(tables["images"].select("image_id", "stem", "split"), "image_id").select("split", "stem", F.col("ann_id").alias("ann_pos"), F.col("category_id").alias("class_id"), "xc", "yc", "wn", "hn")
    S.label_lines(labels).join(tables["images"].select("stem", "split"), "stem").write.mode("overwrite").partitionBy("split").parquet(f"{path}/yolo/labels")
    S.write_text(spark, S.data_yaml(f"{path}/yolo", names), f"{path}/yolo/data.yaml")
    stats = tables["stats"].first().asDict()
    S.write_text(spark, S.category_map({r.orig_id: r.category_id for r in tables["categories"].collect()}, names, stats), f"{path}/cat_map.json")
    tables["images"].select(F.col("stem").alias("value")).write.mode("append").text(f"{path}/.done")


def gate(labels: DataFrame, files: DataFrame, images: DataFrame, texts: DataFrame, licenses: DataFrame, pages: DataFrame, classes: list[str] = list(Q.CLASSES), fix: bool = False) -> dict[str, DataFrame]:  # noqa: B006
    """The dataset gate as tables: findings by issue, personal data, licences, page directions and skew, and one row of
    status; with fix, the repaired labels and what happens to each file.

    labels: file, line_no, class_id, x, y, w, h; files: file; images: path, width, height, exif_bytes; texts: id, text;
    licenses: folder, text; pages: page, text, is_rtl-free angle lines as (page, angle) in column angle (null: none).
    """
    label, image = Q.label_issues(labels, len(classes), files), Q.image_issues(images)
    found, pii = Q.issue_counts(label, image), Q.scan_pii(texts, "id", "text")
    directions = Q.page_directions(pages, "page", "text").join(Q.page_angles(pages, "page", "angle"), "page", "left")
    skew, folders = Q.skew_summary(directions), Q.folder_licenses(licenses, "folder", "text")
    critical = found.where(F.col("issue").isin("unreadable", "invalid_coords")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad"))
    row = critical.crossJoin(pii.agg(F.count("*").alias("pii"))).crossJoin(skew.select("rtl_percentage", "skewed_percentage")).crossJoin(folders.agg(F.coalesce(F.bool_or(F.col("license_files") > 0), F.lit(False)).alias("licensed")))  # one row each
    total = F.col("bad") + F.col("pii")
    out = {"findings": found, "pii": pii, "licenses": folders, "directions": directions, "skew": skew, "status": row.select(total.alias("critical_issues"), "rtl_percentage", "skewed_percentage", "licensed", Q.status(total, F.col("rtl_percentage"), F.col("skewed_percentage"), F.col("licensed")).alias("status"))}
    if fix:
        repaired, lost = Q.repair_labels(labels)
        good = repaired.select(F.col("file").alias("entity")).distinct()
        out |= {"repaired": repaired, "quarantined": lost, "actions": Q.triage(files, "file", label, good), "validated": Q.validate_files(repaired, len(classes))}
    return out


def layout(pages: DataFrame, detect: Callable[[DataFrame], DataFrame] = models.markup_blocks, overlap: float = 0.4, threshold: float = 0.25, start: int = 0, stop: int | None = None) -> DataFrame:
    """Blocks of pages: those that detect finds on pages from `start` up to `stop`, without overlapping and unsure ones.
    What is found is written, as it is read twice and a detector is dear."""
    from foliant.operators.matching import suppress

    path = f"{shared_dir(pages.sparkSession)}/blocks"
    detect(pages.where(D.in_page_range(F.col("page_id"), start, stop))).write.parquet(path)
    blocks = pages.sparkSession.read.parquet(path)
    kept = suppress(blocks.select("page_id", F.col("elem_pos").alias("ann_no"), "x", "y", "w", "h", F.lit(0).alias("class_id"), "score"), overlap, threshold)
    return blocks.join(kept.select("page_id", F.col("ann_no").alias("elem_pos")), ["page_id", "elem_pos"])


def recognised(blocks: DataFrame, pages: DataFrame, document_id: Column) -> DataFrame:
    """Blocks as elements of documents, their texts with language and source. document_id may use the pages' columns."""
    rows = blocks.join(pages.select("page_id", document_id.alias("document_id")), "page_id")
    language, sure = models.language_of(F.col("content"))
    meta = F.map_filter(F.create_map(F.lit("source"), F.lit("markup"), F.lit("lang_confidence"), F.when(F.col("content").isNotNull(), sure.cast("string"))), lambda _, v: v.isNotNull())
    return rows.select("document_id", F.col("page_id").cast("int").alias("page"), "class", "x", "y", "w", "h", "content", F.when(F.col("content").isNotNull(), language).alias("language"), meta.alias("meta"), "elem_pos")


def described(elements: DataFrame, describe: Callable) -> DataFrame:
    """Elements with what a model says of tables and figures without text."""
    return D.merge_descriptions(elements, models.described(D.to_describe(elements), describe))


def process(pages: DataFrame, document_id: Column, detect: Callable[[DataFrame], DataFrame] = models.markup_blocks, describe=None, overlap: float = 0.4, threshold: float = 0.25, start: int = 0, stop: int | None = None) -> DataFrame:
    """Pages to elements: detect blocks, suppress overlapping ones, tell their language, describe tables and figures.
    pages: page_id and whatever detect reads; document_id may use its columns."""
    elements = recognised(layout(pages, detect, overlap, threshold, start, stop), pages, document_id)
    return elements if describe is None else described(elements, describe)


def timed(stages: dict[str, DataFrame]) -> list[dict]:
    """For each stage, a table of its rows: how many there are, the seconds that making them takes, and rows a second."""
    out = []
    for name, rows in stages.items():
        at = time.perf_counter()
        rows.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - at
        n = rows.count()
        out.append({"stage": name, "rows": n, "seconds": round(took, 3), "rows_a_second": round(n / took, 1)})
    return out


def index_documents(elements: DataFrame, path: str, dims: int = 256) -> None:
    V.save_index(V.build_index(elements, dims), path)
