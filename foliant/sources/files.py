"""Readers and writers of files beside annotation sets: listings, pairs, elements, references, PDFs, licences, tables of
results, descriptors, copies.

Listings and readers go through Spark's file sources, so paths may be in any store that Spark reads. Descriptors (a few
lines each) are written by the driver as text tables of one row.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.operators.documents import element_json, text_of_json
from foliant.sources import pdf
from foliant.sources.annotations import header_size
from foliant.sources.largejson import lined_elements

#: Suffixes of images, those that an image for a JSON file is looked up with (in that order), and names of
#: licence files.
IMAGES, ALL_IMAGES = ("jpg", "jpeg", "png"), ("jpg", "jpeg", "png", "bmp", "tiff", "tif")
PRIORITY = (".png", ".jpg", ".jpeg", ".PNG", ".JPG", ".JPEG")
LICENSE_NAMES = ("LICENSE", "LICENCE", "COPYING", "COPYRIGHT", "ATTRIBUTION", "README", "NOTICE", "LEGAL", "TERMS", "CONDITIONS")


def base(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot doesn't begin one."""
    return F.regexp_replace(base(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Last suffix with its dot, empty without one."""
    return F.regexp_extract(base(path), r"(?<=.)(\.[^.]*)$", 1)


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def is_image(path: Column) -> Column:
    return F.lower(suffix(path)).isin(*(f".{s}" for s in ALL_IMAGES))


def is_pdf(path: Column) -> Column:
    return F.lower(suffix(path)) == ".pdf"


def listing(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, modified) of files; contents are not read. modified: seconds since 1970."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(folder)
    return files.select("path", "length", F.unix_micros("modificationTime").cast("double").alias("__m")).select("path", "length", (F.col("__m") / 1e6).alias("modified"))


def list_images(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = IMAGES) -> DataFrame:
    """listing of images; suffixes count in either case."""
    return listing(spark, folder).where(F.lower(suffix(F.col("path"))).isin(*(f".{s}" for s in suffixes)))


def pairs_by_image(images: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, images without one): images and JSON files (path) of the same stem and folder."""
    key = lambda t, name: t.select(F.col("path").alias(name), parent(F.col("path")).alias("folder"), stem(F.col("path")).alias("stem"))
    a, b = key(images, "image"), key(documents, "document")
    return a.join(b, ["folder", "stem"]), a.join(b, ["folder", "stem"], "left_anti")


def pairs_by_document(images: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, JSON files without one): each JSON file with the image of its stem and folder whose suffix comes first."""
    rank = F.array_position(F.array(*(F.lit(p) for p in PRIORITY)), suffix(F.col("path")))
    a = images.select(F.col("path").alias("image"), parent(F.col("path")).alias("folder"), stem(F.col("path")).alias("stem"), rank.alias("rank")).where("rank > 0")
    first = a.groupBy("folder", "stem").agg(F.min_by("image", "rank").alias("image"))
    b = documents.select(F.col("path").alias("document"), parent(F.col("path")).alias("folder"), stem(F.col("path")).alias("stem"))
    return b.join(first, ["folder", "stem"]), b.join(first, ["folder", "stem"], "left_anti")


def not_done(pairs: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs whose stem is not among the lines of `done` (value)."""
    return pairs.join(done.select(F.trim("value").alias("stem")), "stem", "left_anti")


def single_page(files: DataFrame) -> DataFrame:
    """Images as documents of one page: (document_id, page, path)."""
    return files.select(base(F.col("path")).alias("document_id"), F.lit(0).alias("page"), "path")


def pdf_pages(spark: SparkSession, path: str, dpi: int = 220, start: int = 0, stop: int | None = None) -> DataFrame:
    """(path, page, width, height, error) of the pages of PDFs: their size in pixels at dpi, from page `start` up to, not
    including, `stop`, and turned as they are shown. A file without pages, or broken beyond repair, is one row with the
    error and null page. A file is one row, read by Spark from any store; only its pages' sizes go on."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{pdf,PDF}").load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for p, content in zip(b["path"], b["content"], strict=True):
                try:
                    sizes, error = pdf.page_sizes(bytes(content)), "no pages"
                except pdf.Broken as e:
                    sizes, error = [], str(e)
                out += [(p, i, int(w * dpi / 72), int(h * dpi / 72), None) for i, (w, h) in enumerate(sizes)] or [(p, None, None, None, error)]
            yield pd.DataFrame(out, columns=["path", "page", "width", "height", "error"]).astype({"page": "Int32", "width": "Int32", "height": "Int32"})

    rows = files.select("path", "content").mapInPandas(run, "path string, page int, width int, height int, error string")
    keep = F.col("page").isNull() | ((F.col("page") >= start) & (F.lit(True) if stop is None else F.col("page") < stop))
    return rows.where(keep)


ELEMENT = "struct<class:string,bbox:array<bigint>,content:string,language:string,page:int,meta:map<string,string>>"


def _elements(doc: DataFrame) -> DataFrame:
    """Elements of documents that are {"elements": [...]} or a bare list; (file, document_id, elem_pos, e)."""
    whole = F.from_json("value", f"document_id string, elements array<{ELEMENT}>")
    bare = F.from_json("value", f"array<{ELEMENT}>")
    is_list = F.ltrim(F.regexp_replace("value", r"^[\s]+", "")).startswith("[")
    rows = doc.select("file", F.when(~is_list, whole["document_id"]).alias("document_id"), F.when(is_list, bare).otherwise(whole["elements"]).alias("es"))
    return rows.select("file", "document_id", F.posexplode("es").alias("elem_pos", "e"))


def whole_texts(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(file, value): each file's whole text."""
    return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Elements of JSON documents of either shape, with file, document_id (null in a bare list) and elem_pos."""
    box = [F.col("e.bbox")[i].alias(c) for i, c in enumerate("xywh")]
    return _elements(whole_texts(spark, path)).select("file", "document_id", "elem_pos", "e.page", "e.class", *box, "e.content", "e.language", "e.meta")


def write_documents(elements: DataFrame, path: str, missing: str = "merged_document") -> None:
    """The JSON documents of to_documents, a folder document_id=... each, in parts: its files, put one after another by
    name, are the document. Elements are sorted all over Spark, a line each; no row and no task holds a document."""
    keys = ["page", "y", "x", "elem_pos"]
    rows = elements.select(F.coalesce("document_id", F.lit(missing)).alias("document_id"), *keys, element_json("meta" in elements.columns).alias("value")).withColumn("k", F.struct(*keys, "value"))
    first = rows.groupBy("document_id").agg(F.min("k").alias("f"))
    body = rows.join(first, "document_id").select("document_id", F.lit(1).alias("s"), "k", F.concat(F.when(F.col("k") == F.col("f"), "").otherwise(","), "value").alias("value"))
    none = F.lit(None).cast(rows.schema["k"].dataType)
    head = F.concat(F.lit('{"document_id":'), text_of_json(F.col("document_id")), F.lit(',"elements":['))
    lines = body.unionByName(first.select("document_id", F.lit(0).alias("s"), none.alias("k"), head.alias("value"))).unionByName(first.select("document_id", F.lit(2).alias("s"), none.alias("k"), F.lit("]}").alias("value")))
    lines.orderBy("document_id", "s", "k").select("document_id", "value").write.partitionBy("document_id").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(document_id, elem_pos, e) of what write_documents wrote below path, read in ranges."""
    found = lined_elements(spark, path)
    return found.select(F.from_json(F.concat("head", F.lit("]}")), "document_id string")["document_id"].alias("document_id"), F.col("number").alias("elem_pos"), F.from_json("text", ELEMENT).alias("e"))


def read_references(spark: SparkSession, path: str) -> DataFrame:
    """(key, text, pos) of description references of either shape: a list keyed by image_name or else id, and elements
    (tables and figures) keyed by page and box."""
    texts = whole_texts(spark, path)
    is_list = F.ltrim("value").startswith("[")
    listed = texts.where(is_list).select("file", F.posexplode(F.from_json("value", "array<struct<image_name:string,id:string,description:string>>")).alias("pos", "e"))
    one = listed.select(F.coalesce("e.image_name", "e.id", F.lit("")).alias("key"), F.coalesce("e.description", F.lit("")).alias("text"), "file", "pos")
    other = _elements(texts.where(~is_list)).where(F.col("e.class").isin("Table", "Figure"))
    two = other.select(element_key(F.col("e.page"), F.col("e.bbox")).alias("key"), F.coalesce("e.content", F.lit("")).alias("text"), "file", F.col("elem_pos").alias("pos"))
    return one.unionByName(two).select("key", "text", F.struct("file", "pos").alias("pos"))


def element_key(page: Column, box: Column) -> Column:
    """page_[x, y, w, h], a missing page being 0 and a missing box all 0."""
    nums = F.coalesce(box.cast("array<string>"), F.array(*(F.lit("0") for _ in range(4))))
    return F.concat(F.coalesce(page, F.lit(0)).cast("string"), F.lit("_["), F.array_join(nums, ", "), F.lit("]"))


def license_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, folder, size, text) of files with a licence's name, or in a folder named licenses, at any depth; folder is
    the one the licence is for. Names count as they are written."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name, above = base(F.col("path")), parent(F.col("path"))
    named, inside = name.rlike(f"^({'|'.join(LICENSE_NAMES)})"), base(above) == "licenses"
    return files.where(named | inside).select("path", F.when(inside, parent(above)).otherwise(above).alias("folder"), F.col("length").alias("size"), F.try_validate_utf8(F.col("content").cast("string")).alias("text"))


def image_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, width, height, exif_bytes) of images, with the size in the header and the bytes of the EXIF part."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{jpg,jpeg,png,JPG,JPEG,PNG}").load(folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(header_size(bytes(c)) or (None, None), exif_bytes(bytes(c))) for c in b["head"]]
            ints = lambda values, kind: pd.array(values, kind)
            yield pd.DataFrame({"path": b["path"], "length": b["length"], "width": ints([g[0][0] for g in got], "Int32"), "height": ints([g[0][1] for g in got], "Int32"), "exif_bytes": ints([g[1] for g in got], "Int32")})

    return files.select("path", "length", F.substring("content", 1, 1 << 17).alias("head")).mapInPandas(run, "path string, length long, width int, height int, exif_bytes int")


def exif_bytes(data: bytes) -> int:
    """Length of a JPEG's EXIF part; 0 without one."""
    at = 2
    while data[:2] == b"\xff\xd8" and at + 4 <= len(data) and data[at] == 0xFF and data[at + 1] not in (0xD9, 0xDA):
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        if data[at + 1] == 0xE1 and data[at + 4 : at + 8] == b"Exif":
            return size
        at += 2 + size
    return 0


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One text as a one-row table below path."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def data_yaml(folder: str, names: list[str], splits: dict[str, str] | None = None) -> str:
    """Descriptor of a label set: folder, its splits, number and names of classes."""
    where = splits or {"train": "images/train", "val": "images/val", "test": "images/test"}
    return "\n".join([f"path: {folder}", *(f"{k}: {v}" for k, v in where.items()), f"nc: {len(names)}", "names:", *(f"- {n}" for n in names)]) + "\n"


def category_map(ids: dict[int, int], names: list[str], stats: dict[str, int]) -> str:
    """JSON of original to new ids, names by new id, and counts."""
    return json.dumps({"orig_to_train": {str(k): v for k, v in sorted(ids.items())}, "names": {str(i): n for i, n in enumerate(names)}, "stats": stats}, indent=2)


def coco_document(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """(value): one JSON document, its lists in the order of their ids. It is one row; for more than a machine's memory
    write the three tables instead."""
    box = F.array(*(F.col(c) for c in "xywh"))
    by_key = lambda x, y: F.when(x["k"] < y["k"], -1).when(x["k"] > y["k"], 1).otherwise(0)
    rows = lambda t, cols, key: t.select(F.struct(*cols).alias("s"), F.col(key).alias("k")).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "s")), by_key), lambda e: e["s"]).alias("l"))
    extra = [c for c in ("file_attributes",) if c in images.columns]
    a = rows(images, [F.col("image_id").alias("id"), "file_name", "width", "height", *extra], "image_id").withColumnRenamed("l", "images")
    b = rows(annotations, [F.col("ann_id").alias("id"), "image_id", "category_id", box.alias("bbox"), (F.col("w") * F.col("h")).alias("area"), F.lit(0).alias("iscrowd")], "ann_id").withColumnRenamed("l", "annotations")
    c = rows(categories, [F.col("category_id").alias("id"), "name", F.lit("document").alias("supercategory")], "category_id").withColumnRenamed("l", "categories")
    return a.crossJoin(b).crossJoin(c).select(F.to_json(F.struct("images", "annotations", "categories")).alias("value"))  # one row each


def copy_files(plan: DataFrame) -> DataFrame:
    """(src, dst, bytes, error) of copying each src to dst, in the stores that the workers' file system reaches; what
    fails says why. Copying again gives the same."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import shutil
        import uuid

        local = lambda p: re.sub(r"^file:/+", "/", p)
        for b in batches:
            out = []
            for src, dst in zip(b["src"], b["dst"], strict=True):
                try:
                    to = local(dst)
                    os.makedirs(os.path.dirname(to), exist_ok=True)
                    shutil.copyfile(local(src), part := f"{to}.{uuid.uuid4().hex}.part")
                    os.replace(part, to)  # a lost task leaves no half file under the name
                    out.append((src, dst, os.path.getsize(to), None))
                except OSError as e:
                    out.append((src, dst, None, str(e)))
            yield pd.DataFrame(out, columns=["src", "dst", "bytes", "error"]).astype({"bytes": "Int64"})

    return plan.select("src", "dst").mapInPandas(run, "src string, dst string, bytes long, error string")


def write_csv(rows: DataFrame, path: str, separator: str = ",") -> None:
    rows.write.mode("overwrite").option("header", True).option("sep", separator).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON object a line, nulls shown."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def wide_matrix(square: DataFrame, labels: list[str]) -> DataFrame:
    """A square confusion table (truth, guess, n) with one column a label."""
    return square.groupBy("truth").pivot("guess", labels).agg(F.first("n")).orderBy("truth")


def ocr_table(elements: DataFrame) -> DataFrame:
    """(class, bbox, content, language, confidence) as an OCR dump has them: boxes as x,y,w,h, nulls empty, three places."""
    confidence = F.coalesce(F.try_element_at("meta", F.lit("confidence")).cast("double"), F.lit(0.0))
    return elements.select("class", F.concat_ws(",", *(F.col(c).cast("string") for c in "xywh")).alias("bbox"), F.coalesce("content", F.lit("")).alias("content"), F.coalesce("language", F.lit("")).alias("language"), F.format_string("%.3f", confidence).alias("confidence"))


def label_lines(boxes: DataFrame) -> DataFrame:
    """(stem, value): a label file's lines `class xc yc w h`, six places each, in the order of ann_pos. Boxes have stem,
    ann_pos, class_id and the fractions xc, yc, wn, hn."""
    line = F.concat_ws(" ", F.col("class_id").cast("string"), *(F.format_string("%.6f", F.col(c)) for c in ("xc", "yc", "wn", "hn")))
    g = boxes.select("stem", F.struct("ann_pos", line.alias("l")).alias("s")).groupBy("stem").agg(F.array_sort(F.collect_list("s")).alias("s"))
    return g.select("stem", F.array_join(F.transform("s", lambda e: e["l"]), "\n").alias("value"))


def first_files(files: DataFrame, group: str, n: int) -> DataFrame:
    """The first n files of a group by path, as previews."""
    return files.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy("path"))).where(F.col("__r") <= n).drop("__r")
