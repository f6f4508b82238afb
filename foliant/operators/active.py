"""Active learning: selection by uncertainty, error cases, pseudo-labels, merging of datasets, cycles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.operators import matching as M
from foliant.operators import relational as R
from foliant.operators.documents import crop

STRATEGIES = ("margin", "entropy", "low_conf")


def scored(pred: DataFrame, strategy: str, image: str = "page_id", place: str = "ann_no", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """(image, score, num_predictions, min_confidence, best): each image's uncertainty by a strategy, and the prediction
    that gives it, the first of equals: least margin, largest entropy, or least confidence."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}; one of {', '.join(STRATEGIES)} is needed")
    margin, entropy = R.uncertainty_of(F.col(score), F.col("__n"))
    n = pred.agg(F.count_distinct(image).cast("double").alias("__n"))
    rows = pred.crossJoin(F.broadcast(n)).withColumn("__u", {"margin": margin, "entropy": -entropy, "low_conf": F.col(score)}[strategy])  # one row
    g = rows.groupBy(image).agg(F.min("__u").alias("u"), F.count("*").alias("num_predictions"), F.min(score).alias("min_confidence"), F.min_by(place, F.struct("__u", place)).alias("best"))
    out = {"margin": F.col("u"), "entropy": F.greatest(F.lit(0.0), -F.col("u")), "low_conf": F.greatest(F.lit(0.0), threshold - F.col("u"))}[strategy]
    return g.select(image, out.alias("score"), "num_predictions", "min_confidence", "best")


def select_uncertain(scores: DataFrame, k: int = 500, order: str = "reference", strategy: str = "margin", image: str = "page_id") -> DataFrame:
    """The k images of highest score. order="uncertain" takes the lowest margins, which are the least certain, instead."""
    up = order == "uncertain" and strategy == "margin"
    return scores.orderBy(F.asc("score") if up else F.desc("score"), image).limit(k)


def top_errors(errors: DataFrame, k: int = 150) -> DataFrame:
    """The k errors of each kind with the highest score (a missed box has none: 0); ties in file order."""
    s = F.coalesce("score", F.lit(0.0))
    w = Window.partitionBy("kind").orderBy(s.desc(), "page_id", "ann_no")
    return errors.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def overlay_errors(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(kind, page_id, ann_no, class_id, x, y, w, h, score): predictions that overlap no true box by more than one half
    (fp) and true boxes that no prediction does (fn), of any class."""
    both = M.unmatched(gt, pred)
    return both.select("kind", "page_id", "ann_no", "class_id", "x", "y", "w", "h", "score")


def error_cases(errors: DataFrame, boxes: DataFrame | None, images: DataFrame | None, names: DataFrame) -> DataFrame:
    """The audit index: one row an error with its classes, score, boxes, image and the part of the image to cut out.
    errors: page_id, kind, ann_no; boxes: page_id, kind, ann_no, class_id, x, y, w, h, score of either side; images:
    page_id, file_name, width, height; names: class_id, name. boxes or images are None where errors have their columns."""
    rows = errors if boxes is None else errors.join(boxes, ["page_id", "kind", "ann_no"])
    rows = (rows if images is None else rows.join(images, "page_id")).join(F.broadcast(names), "class_id")
    missed = F.col("kind") == "fn"
    none, own = F.array(*(F.lit(0).cast("long") for _ in range(4))), F.array(*(F.col(c).cast("long") for c in "xywh"))
    cut = crop(tuple(F.col(c) for c in "xywh"), F.col("width"), F.col("height"))
    kind, score = F.upper("kind"), F.when(missed, 0.0).otherwise(F.coalesce("score", F.lit(0.0)))
    out = rows.select(
        kind.alias("type"), F.col("page_id").alias("page"), "ann_no", F.when(missed, F.col("name")).otherwise("N/A").alias("class_gt"), F.when(missed, "N/A").otherwise(F.col("name")).alias("class_pred"), score.alias("score"),
        F.lit(0.0).alias("iou"), F.when(missed, own).otherwise(none).alias("bbox_gt"), F.when(missed, none).otherwise(own).alias("bbox_pred"), F.col("file_name").alias("image_path"),
        F.when(cut[0].isNotNull(), F.array(*(c.cast("long") for c in cut))).alias("crop"),
    )
    name = F.concat_ws("_", "type", "class_gt", F.concat(F.lit("p"), F.lpad(F.col("page").cast("string"), 2, "0")), F.concat(F.format_string("%.3f", "score"), F.lit(".jpg")))
    return out.withColumn("crop_path", F.when(F.col("crop").isNotNull(), name))


def whole_box(box: G.Box, width: Column, height: Column) -> G.Box:
    """A box in whole numbers (fractions cut off), its corner moved into the image, then shrunk to fit, a pixel at least."""
    return G.clamp_origin(tuple(c.cast("int") for c in box), width, height)


def pseudo_labels(pred: DataFrame, images: DataFrame, names: DataFrame, threshold: float = 0.6, source_model: str = "unknown", epoch: int = 0) -> DataFrame:
    """Predictions of at least the threshold as labels: page_id, class_name, the whole box, confidence, provenance, and
    the box as YOLO fractions of the image's own size. A null score is 0. images: page_id, file_name, width, height."""
    some = pred.where(F.coalesce("score", F.lit(0.0)) >= threshold).join(images, "page_id").join(F.broadcast(names), "class_id")
    w, h = F.col("width"), F.col("height")
    x, y, bw, bh = whole_box(tuple(F.col(c) for c in "xywh"), w, h)
    rows = some.select("page_id", "ann_no", "file_name", F.col("name").alias("class_name"), "class_id", x.alias("x"), y.alias("y"), bw.alias("w"), bh.alias("h"), F.col("score").alias("confidence"), "width", "height")
    yolo = G.to_yolo(tuple(F.col(c) for c in "xywh"), w, h)
    return rows.select(*rows.columns, *(c.alias(n) for c, n in zip(yolo, ("xc", "yc", "wn", "hn"), strict=True)), F.lit(source_model).alias("source_model"), F.lit(epoch).alias("epoch"), F.lit(threshold).alias("threshold"))


def manifest(labels: DataFrame) -> DataFrame:
    """One row: labels, images, classes in order, and least, largest and mean confidence (0 without labels)."""
    stat = lambda f: F.coalesce(f("confidence"), F.lit(0.0))
    return labels.agg(F.count("*").alias("total_labels"), F.count_distinct("page_id").alias("images"), F.sort_array(F.collect_set("class_name")).alias("classes"), stat(F.min).alias("conf_min"), stat(F.max).alias("conf_max"), stat(F.avg).alias("conf_mean"))


def merge_datasets(existing: DataFrame, new: DataFrame, key: str = "file_name") -> DataFrame:
    """Files of both, with origin; where both have a file the new one stands."""
    old = existing.join(new.select(key).distinct(), key, "left_anti")
    return old.withColumn("origin", F.lit("existing")).unionByName(new.withColumn("origin", F.lit("pseudo")), allowMissingColumns=True)


def metric_deltas(metrics: DataFrame) -> DataFrame:
    """metrics (cycle, metric, value) with delta to the cycle before; 0 for the first of a metric."""
    return metrics.withColumn("delta", F.coalesce(F.col("value") - F.lag("value").over(Window.partitionBy("metric").orderBy("cycle")), F.lit(0.0)))


def run_cycle(gt: DataFrame, pred: DataFrame, images: DataFrame, names: DataFrame, cycle: int, strategy: str = "margin", quota: int = 500, threshold: float = 0.6) -> dict[str, DataFrame]:
    """One round: errors, the images to annotate, pseudo-labels and one row of what came of it. The detector's own
    training is the caller's; its next predictions are the next round's."""
    errors = M.mine_errors(gt, pred)
    chosen = select_uncertain(scored(pred, strategy), quota, strategy=strategy)
    labels = pseudo_labels(pred, images, names, threshold, f"cycle_{cycle}", cycle)
    counts = errors.agg(F.count_if(F.col("kind") == "fp").alias("false_positives"), F.count_if(F.col("kind") == "fn").alias("false_negatives"))
    row = counts.crossJoin(chosen.agg(F.count("*").alias("selected_samples"))).crossJoin(manifest(labels))  # one row each
    return {"errors": errors, "selected": chosen, "pseudo_labels": labels, "summary": row.select(F.lit(cycle).alias("cycle"), "*")}


def autopilot(gt: DataFrame, images: DataFrame, names: DataFrame, predict: Callable[[int, DataFrame | None], DataFrame], cycles: int = 2, **how) -> list[dict[str, DataFrame]]:
    """Rounds of run_cycle; predict(cycle, pseudo-labels of the round before) gives each round's predictions."""
    done: list[dict[str, DataFrame]] = []
    for cycle in range(1, cycles + 1):
        done.append(run_cycle(gt, predict(cycle, done[-1]["pseudo_labels"] if done else None), images, names, cycle, **how))
    return done
