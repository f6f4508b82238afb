"""Command line: python -m foliant.cli <command> ...; every command is a few calls of operators."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant import config
from foliant.operators import active, cache, calibration, evaluation, matching, quality, relational, vectors
from foliant.operators.documents import to_documents
from foliant.plans import pipelines, reports
from foliant.sources import annotations, files

CLASSES = list(quality.CLASSES)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="foliant", description="Document datasets on Spark")
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, run, *arguments: tuple) -> None:
        p = commands.add_parser(name, help=run.__doc__)
        for a in arguments:
            names, how = (a, {}) if isinstance(a, str) else a
            p.add_argument(*([names] if isinstance(names, str) else names), **how)
        p.set_defaults(run=run)

    need = lambda name, **how: (name, {"required": True, **how})
    may = lambda name, default=None, **how: (name, {"default": default, **how})
    several = {"nargs": "+"}
    add("process", process, "input", need("--out"), may("--pages"), may("--config"))
    add("layout", layout, "input", need("--out"), may("--pages"), may("--config"))
    add("ocr", ocr, "input", need("--out"), may("--pages"), may("--config"))
    add("describe", describe, "input", need("--out"), need("--model"), may("--pages"), may("--config"))
    add("json", compile_json, "input", need("--out"), may("--pages"), may("--config"))
    add("bench", bench, "input", may("--out"), may("--model"), may("--pages"), may("--config"))
    add("coco-to-yolo", coco_to_yolo, need("--coco"), need("--out"), may("--classes", CLASSES, **several))
    add("yolo-to-coco", yolo_to_coco, need("--images"), need("--labels"), need("--out"), may("--classes", CLASSES, **several))
    add("split", split, need("--coco"), need("--out"), may("--how", "uniform", choices=["uniform", "stratified", "page"]), may("--train", 0.8, type=float), may("--val", 0.1, type=float), may("--test", 0.1, type=float), may("--seed", 42, type=int))
    add("subset", subset, need("--coco"), need("--out"), may("--per-class", 200, type=int), may("--seed", 42, type=int))
    add("ingest", ingest, need("--dir"), need("--out"), may("--split", [0.9, 0.1, 0.0], nargs=3, type=float), may("--id-to-name"), may("--seed", 42, type=int), ("--resume", {"action": "store_true"}))
    add("preupload", preupload, need("--images"), need("--labels"), need("--out"), may("--classes", CLASSES, **several), ("--fix", {"action": "store_true"}), ("--no-pii", {"action": "store_true"}), ("--no-license", {"action": "store_true"}))
    add("eval-coco", eval_coco, need("--gt"), need("--pred"), need("--out"))
    add("eval-langid", eval_langid, need("--csv"), need("--out"))
    add("eval-desc", eval_desc, need("--pred"), need("--refs"), need("--out"))
    add("eval-desc-qa", eval_desc_qa, need("--elements"), need("--out"), may("--page-lang"))
    add("calibrate", calibrate, need("--gt"), need("--pred"), need("--out"), may("--method", "temperature", choices=["temperature", "platt", "isotonic"]))
    add("mine-errors", mine_errors, need("--gt"), need("--pred"), need("--out"))
    add("select", select, need("--pred"), need("--out"), may("--strategy", "margin", choices=list(active.STRATEGIES)), may("--top", 500, type=int))
    add("pseudo-labels", pseudo_labels, need("--pred"), need("--out"), may("--thr", 0.6, type=float), may("--model", "unknown"), may("--epoch", 0, type=int))
    add("build-index", build_index, "elements", need("--out"), may("--dim", 256, type=int))
    add("search", search, "index", need("--q"), may("--k", 5, type=int), may("--dim", 256, type=int))
    add("cache", cache_command, need("--dir"), ("--stats", {"action": "store_true"}), may("--clear"))
    return top


def pages_and_blocks(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    """Pages of markup (Parquet: page_id, html), and their blocks."""
    pages, (start, stop) = spark.read.parquet(a.input), config.page_range(a.pages)
    return pages, pipelines.layout(pages, threshold=config.load(a.config)["layout"]["conf_threshold"], start=start, stop=stop)


def elements_of(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    pages, blocks = pages_and_blocks(spark, a)
    return pipelines.recognised(blocks, pages, F.lit(files_name(a.input)))


def model_of(name: str) -> Callable:
    """A function by its name, module:function."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def said(rows: DataFrame, what: str) -> None:
    by = rows.groupBy("class").agg(F.count("*").alias("n")).orderBy("class").collect()  # classes are few
    print(json.dumps({what: sum(r.n for r in by), "by_class": {r["class"]: r.n for r in by}}))


def layout(spark: SparkSession, a: argparse.Namespace) -> int:
    """Blocks of pages of markup, without their texts"""
    _, blocks = pages_and_blocks(spark, a)
    files.write_json(blocks.select("page_id", "elem_pos", "class", *"xywh", "score"), a.out)
    said(spark.read.schema("class string").json(a.out), "blocks")
    return 0


def ocr(spark: SparkSession, a: argparse.Namespace) -> int:
    """Texts and languages of pages' blocks"""
    files.write_json(elements_of(spark, a), a.out)
    said(spark.read.schema("class string").json(a.out), "elements")
    return 0


def describe(spark: SparkSession, a: argparse.Namespace) -> int:
    """Elements of pages, tables and figures described by a model (module:function)"""
    files.write_json(pipelines.described(elements_of(spark, a), model_of(a.model)), a.out)
    said(spark.read.schema("class string, content string").json(a.out).where("class in ('Table', 'Figure') and content is not null"), "described")
    return 0


def compile_json(spark: SparkSession, a: argparse.Namespace) -> int:
    """JSON documents of elements compiled anew; pages of markup are processed first"""
    if not a.input.endswith(".json"):
        return process(spark, a)
    elements = files.read_elements(spark, a.input).withColumn("document_id", F.coalesce("document_id", files.stem(F.col("file"))))
    to_documents(elements).select(F.col("payload").alias("value")).write.mode("overwrite").text(a.out)
    return 0


def bench(spark: SparkSession, a: argparse.Namespace) -> int:
    """Seconds and rows of each stage of processing"""
    pages, blocks = pages_and_blocks(spark, a)
    elements = pipelines.recognised(blocks, pages, F.lit(files_name(a.input)))
    stages = {"pages": pages, "layout": blocks, "ocr": elements}
    if a.model:
        stages["describe"] = pipelines.described(elements, model_of(a.model))
    stages["json"] = to_documents(elements)
    took = pipelines.timed(stages)
    print(json.dumps(took, indent=2))
    if a.out:
        files.write_text(spark, json.dumps(took), a.out)
    return 0


def process(spark: SparkSession, a: argparse.Namespace) -> int:
    """Pages of markup (Parquet: page_id, html) to JSON documents"""
    elements = elements_of(spark, a)
    to_documents(elements).select(F.col("payload").alias("value")).write.mode("overwrite").text(a.out)
    return 0


def files_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def coco_boxes(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """A COCO file's tables, and its annotations as boxes (page_id, ann_no, x, y, w, h, class_id, score)."""
    tables = annotations.read_coco(spark, path)
    boxes = tables["annotations"].select(F.col("image_id").alias("page_id"), F.col("ann_pos").alias("ann_no"), *"xywh", F.col("category_id").alias("class_id"), F.coalesce("score", F.lit(0.0)).alias("score"))
    return tables, boxes


def coco_to_yolo(spark: SparkSession, a: argparse.Namespace) -> int:
    """COCO document to label files (a row a file) and a descriptor"""
    pipelines.coco_to_yolo(annotations.read_coco(spark, a.coco), a.classes).write.mode("overwrite").parquet(f"{a.out}/labels")
    files.write_text(spark, files.data_yaml(a.out, a.classes), f"{a.out}/data.yaml")
    return 0


def yolo_to_coco(spark: SparkSession, a: argparse.Namespace) -> int:
    """Label files and images to a COCO document"""
    images = files.image_documents(spark, a.images).where("width is not null").select(files.stem(F.col("path")).alias("stem"), files.base(F.col("path")).alias("file_name"), "width", "height")
    tables = annotations.yolo_to_coco(annotations.read_yolo(spark, a.labels), images)
    names = pipelines.label_map(spark, a.classes).withColumnRenamed("class_id", "category_id")
    files.coco_document(tables["images"], tables["annotations"].withColumnRenamed("class_id", "category_id"), names).coalesce(1).write.mode("overwrite").text(a.out)
    return 0


def split(spark: SparkSession, a: argparse.Namespace) -> int:
    """Train, val and test documents of a COCO document"""
    tables = annotations.read_coco(spark, a.coco)
    images = pipelines.split_images(tables["images"], a.how, seed=a.seed, train=a.train, val=a.val, test=a.test)
    for name in ("train", "val", "test"):
        some = images.where(F.col("split") == name)
        files.coco_document(some, tables["annotations"].join(some.select("image_id"), "image_id", "left_semi"), tables["categories"]).coalesce(1).write.mode("overwrite").text(f"{a.out}/{name}")
    pipelines.split_tables(images, tables["annotations"])[1].show()
    return 0


def subset(spark: SparkSession, a: argparse.Namespace) -> int:
    """A COCO document of at most so many annotations of each class"""
    tables = annotations.read_coco(spark, a.coco)
    some = relational.first_per_group(tables["annotations"], ["category_id"], ["ann_id"], a.per_class, a.seed)
    files.coco_document(tables["images"].join(some.select("image_id"), "image_id", "left_semi"), some, tables["categories"]).coalesce(1).write.mode("overwrite").text(a.out)
    return 0


def ingest(spark: SparkSession, a: argparse.Namespace) -> int:
    """A folder of images with a JSON file each to COCO documents and label files"""
    done = spark.read.text(f"{a.out}/.done") if a.resume else None
    pipelines.write_ingested(pipelines.ingest(spark, a.dir, config.id_names(a.id_to_name) if a.id_to_name else None, tuple(a.split), a.seed, done), a.out)
    return 0


def preupload(spark: SparkSession, a: argparse.Namespace) -> int:
    """Dataset gate: findings, personal data, licences, status; exit code 1 where it needs attention"""
    labels = annotations.read_yolo(spark, a.labels).select("file", F.col("line_no"), "class_id", F.col("xc").alias("x"), F.col("yc").alias("y"), "w", "h")
    names = files.listing(spark, a.labels, "*.txt").select(F.col("path").alias("file"))
    images = files.image_documents(spark, a.images)
    texts = images.select(F.col("path").alias("id"), files.base(F.col("path")).alias("text")).where(F.lit(not a.no_pii))
    licenses = files.license_files(spark, a.images).select("folder", "text").where(F.lit(not a.no_license))
    pages = spark.createDataFrame([], "page string, text string, angle double")
    tables = pipelines.gate(labels, names, images, texts, licenses, pages, a.classes, a.fix)
    for name, t in tables.items():
        files.write_json(t, f"{a.out}/{name}")
    files.write_text(spark, reports.gate_report(tables), f"{a.out}/report")
    return int(tables["status"].first().status != "READY")


def eval_coco(spark: SparkSession, a: argparse.Namespace) -> int:
    """Average precision and recall, confusion and their report"""
    (_, gt), (_, pred) = coco_boxes(spark, a.gt), coco_boxes(spark, a.pred)
    table = evaluation.detection_table(gt, pred).cache()
    metrics = evaluation.detection_metrics(table)
    files.write_json(metrics, f"{a.out}/coco_metrics")
    files.write_json(matching.match_confusion(gt, pred), f"{a.out}/confusion_matrix")
    files.write_text(spark, reports.detection_report(metrics, evaluation.class_metrics(table)), f"{a.out}/coco_report")
    table.unpersist()
    return 0


def eval_langid(spark: SparkSession, a: argparse.Namespace) -> int:
    """Language identification against a CSV of labels"""
    from foliant.operators.models import language_of

    language, sure = language_of(F.col("text"))
    rows = annotations.language_labels(spark, a.csv).select("language", F.coalesce(language, F.lit("unknown")).alias("guess"), sure.alias("confidence"))
    summary, labels = evaluation.language_summary(rows, "language", "guess", "confidence"), relational.per_label(rows, "language", "guess")
    files.write_csv(evaluation.square_confusion(rows, "language", "guess"), f"{a.out}/confusion_matrix")
    files.write_json(summary, f"{a.out}/langid_metrics")
    files.write_text(spark, reports.language_report(summary, labels), f"{a.out}/langid_report")
    return 0


def eval_desc(spark: SparkSession, a: argparse.Namespace) -> int:
    """Descriptions against references"""
    elements = files.read_elements(spark, a.pred)
    pred = elements.select(files.element_key(F.col("page"), F.array(*"xywh")).alias("key"), "class", F.coalesce("content", F.lit("")).alias("text"))
    scores = evaluation.description_scores(evaluation.description_pairs(pred, files.read_references(spark, a.refs)))
    files.write_json(scores, f"{a.out}/desc_detailed")
    files.write_text(spark, reports.summary_report("Description Evaluation Report", evaluation.description_summary(scores)), f"{a.out}/desc_report")
    return 0


def eval_desc_qa(spark: SparkSession, a: argparse.Namespace) -> int:
    """Checks of descriptions"""
    from foliant.functions.text import qa_flags

    elements = files.read_elements(spark, a.elements).withColumn("flags", qa_flags(F.col("content"), F.col("class"), F.lit(a.page_lang) if a.page_lang else None))
    flags = elements.select("file", "elem_pos", "class", F.explode("flags").alias("f")).select("file", "elem_pos", "class", "f.*")
    files.write_json(flags, f"{a.out}/qa_results")
    files.write_text(spark, reports.qa_report(evaluation.flag_rate(elements, "flags"), evaluation.qa_summary(flags)), f"{a.out}/qa_report")
    return 0


def calibrate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Calibration parameters of a detector's confidences"""
    (_, gt), (_, pred) = coco_boxes(spark, a.gt), coco_boxes(spark, a.pred)
    files.write_text(spark, calibration.to_json(calibration.fit(matching.match_calibration(gt, pred), "confidence", "correct", a.method)), a.out)
    return 0


def mine_errors(spark: SparkSession, a: argparse.Namespace) -> int:
    """Missed boxes and false predictions, with the part of the image to cut out"""
    (tables, gt), (_, pred) = coco_boxes(spark, a.gt), coco_boxes(spark, a.pred)
    boxes = gt.withColumn("kind", F.lit("fn")).unionByName(pred.withColumn("kind", F.lit("fp")))
    images = tables["images"].withColumnRenamed("image_id", "page_id")
    names = tables["categories"].withColumnRenamed("category_id", "class_id")
    cases = active.error_cases(matching.mine_errors(gt, pred), boxes, images, names)
    files.write_csv(cases.select("type", "page", "class_gt", "class_pred", "score", "iou", "image_path", "crop_path"), f"{a.out}/audit_index")
    return 0


def select(spark: SparkSession, a: argparse.Namespace) -> int:
    """The images to annotate next"""
    _, pred = coco_boxes(spark, a.pred)
    files.write_json(active.select_uncertain(active.scored(pred, a.strategy), a.top, strategy=a.strategy), a.out)
    return 0


def pseudo_labels(spark: SparkSession, a: argparse.Namespace) -> int:
    """Confident predictions as labels, with a manifest"""
    tables, pred = coco_boxes(spark, a.pred)
    labels = active.pseudo_labels(pred, tables["images"].withColumnRenamed("image_id", "page_id"), tables["categories"].withColumnRenamed("category_id", "class_id"), a.thr, a.model, a.epoch)
    lines = labels.select(files.stem(F.col("file_name")).alias("stem"), F.col("ann_no").alias("ann_pos"), "class_id", "xc", "yc", "wn", "hn")
    files.label_lines(lines).write.mode("overwrite").parquet(f"{a.out}/labels")
    files.write_json(active.manifest(labels), f"{a.out}/manifest")
    return 0


def build_index(spark: SparkSession, a: argparse.Namespace) -> int:
    """Vector index of an elements document"""
    pipelines.index_documents(files.read_elements(spark, a.elements).withColumn("document_id", F.coalesce("document_id", files.base(F.col("file")))), a.out, a.dim)
    return 0


def search(spark: SparkSession, a: argparse.Namespace) -> int:
    """The chunks of an index nearest to a text"""
    hits = vectors.search(vectors.load_index(spark, a.index), spark.createDataFrame([(0, a.q)], "query_id int, text string"), a.k, dims=a.dim)
    print(json.dumps([r.asDict() for r in hits.orderBy("rank").collect()], ensure_ascii=False, indent=2))  # k rows
    return 0


def cache_command(spark: SparkSession, a: argparse.Namespace) -> int:
    """Statistics of a cache table, or the table without a prefix's keys"""
    table = spark.read.schema(cache.SCHEMA).parquet(a.dir)
    if a.clear:
        cache.clear(table, None if a.clear == "all" else a.clear).write.mode("overwrite").parquet(f"{a.dir}_cleared")
    print(json.dumps({"totals": cache.totals(table).first().asDict(), "by_prefix": [r.asDict() for r in cache.by_prefix(table).collect()]}, indent=2, default=str))
    return 0


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    if spark is None:
        from foliant.session import session

        spark = session()
    return a.run(spark, a)


if __name__ == "__main__":
    sys.exit(main())
