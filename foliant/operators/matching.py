"""Greedy one-to-one matching of boxes, suppression and average precision.

Pairs of boxes of an image come from an equi-join with the overlap as a Column. Greedy choices, which depend on what was
chosen before, are made in rounds of windows; suppression and the matches at all overlaps run in Python, image by image
over a sorted stream. An image's boxes are few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliant.functions.geometry import intersection
from foliant.session import shared_dir

#: Rounds between two looks at what is left.
ROUNDS = 2


#: Pairs of one class. As an equality it would be a key of the join, which then deals boxes by image and class, and pairs
#: by image once more for the choices that follow.
ONE_CLASS = "gt_class between pred_class and pred_class"


def candidates(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """Overlapping pairs of an image: page_id, gt_no, pred_no, classes, inter and union (whole numbers for whole boxes)."""
    a = gt.select("page_id", F.col("ann_no").alias("gt_no"), F.col("class_id").alias("gt_class"), *(F.col(c).alias(f"g{c}") for c in "xywh"))
    b = pred.select("page_id", F.col("ann_no").alias("pred_no"), F.col("class_id").alias("pred_class"), "score", *(F.col(c).alias(f"p{c}") for c in "xywh"))
    box = lambda k: tuple(F.col(f"{k}{c}") for c in "xywh")
    i = intersection(box("g"), box("p"))
    out = a.join(b, "page_id").withColumn("inter", i.cast("long")).where("inter > 0")
    return out.withColumn("uni", (F.col("gw") * F.col("gh") + F.col("pw") * F.col("ph")).cast("long") - F.col("inter")).select("page_id", "gt_no", "pred_no", "gt_class", "pred_class", "score", "inter", "uni")


def unmatched(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """Predictions (kind fp) that overlap no true box by more than one half, and true boxes (fn) that no prediction does,
    of any class; true boxes have a null score. Overlaps are computed once for both."""
    hits = candidates(gt, pred).where("2 * inter > uni")
    hit = hits.select("page_id", F.explode(F.array(F.struct(F.lit("fn").alias("kind"), F.col("gt_no").alias("ann_no")), F.struct(F.lit("fp").alias("kind"), F.col("pred_no").alias("ann_no")))).alias("h")).select("page_id", "h.*")
    cols = ["page_id", "ann_no", "class_id", *"xywh"]
    both = gt.select(*cols, F.lit(None).cast("double").alias("score"), F.lit("fn").alias("kind")).unionByName(pred.select(*cols, F.col("score").cast("double"), F.lit("fp").alias("kind")))
    return both.join(hit, ["page_id", "kind", "ann_no"], "left_anti")


def by_group(rows: DataFrame, n_keys: int, order: list, work: Callable[[list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """work(the rows of a group, in order) for each group of the first n_keys columns, whose results are rows of schema.
    Groups are dealt to partitions, sorted there and streamed, so memory holds one group and a batch."""
    keys = rows.columns[:n_keys]
    fields = T.DataType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:n_keys] != row[:n_keys]:
                    out += work(held)
                    held = []
                held.append(row)
            if len(out) > 10_000:
                yield table()
                out = []
        out += work(held) if held else []
        if out:
            yield table()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, fields)


def greedy(pairs: DataFrame, driver: str, other: str, *also: str) -> DataFrame:
    """(page_id, driver_no, other_no, overlap, then `also`): each driver box, in its order, takes the free
    box of largest overlap; the first of equals. Whole numbers in `also` part an image's pairs further.

    A driver's best box that no earlier driver still asks for is its own, whatever the others choose; then what either is
    part of goes. Pairs whose boxes are in no other pair are told at once, and the others in rounds; an image's first
    driver is served in every round, so rounds end. Boxes that overlap by half are few, and two or three rounds serve
    nearly all. A round is windows over pairs that stay where they are; what is left of them is written. Pairs of a join by
    image are where they should be.
    """
    spark, path, key = pairs.sparkSession, shared_dir(pairs.sparkSession), ["page_id", *also]
    slim = pairs.select(*key, F.col(driver).cast("long").alias("driver_no"), F.col(other).cast("long").alias("other_no"), (F.col("inter") / F.col("uni")).alias("overlap"))
    by = {c: Window.partitionBy(*key, c) for c in ("driver_no", "other_no")}
    alone = (F.count("*").over(by["driver_no"]) == 1) & (F.count("*").over(by["other_no"]) == 1)
    slim.select("*", alone.alias("matched")).write.parquet(f"{path}/0")
    step, done = 0, []
    while True:
        state = spark.read.parquet(f"{path}/{step}")
        done.append(state.where("matched").drop("matched"))
        left = state.where("not matched").repartition("page_id").withColumn("matched", F.lit(False))
        if left.isEmpty():
            break
        for _ in range(ROUNDS):
            best = F.row_number().over(by["driver_no"].orderBy("matched", F.desc("overlap"), "other_no")) == 1
            free = F.col("driver_no") == F.min("driver_no").over(by["other_no"])
            left = left.withColumn("best", best).withColumn("now", ~F.col("matched") & F.col("best") & free)
            gone = F.bool_or("now").over(by["driver_no"]) | F.bool_or("now").over(by["other_no"])
            left = left.withColumn("gone", gone).where("matched or now or not gone").select(*key, "driver_no", "other_no", "overlap", (F.col("matched") | F.col("now")).alias("matched"))
        step += 1
        left.write.parquet(f"{path}/{step}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("page_id", "driver_no", "other_no", "overlap", *(F.col(c).cast("long").alias(c) for c in also))


def match_confusion(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(true_class, pred_class, n) by predictions in file order, any class, overlap over one half."""
    pairs = candidates(gt, pred).where("2 * inter > uni")
    m = greedy(pairs, "pred_no", "gt_no").select("page_id", F.col("driver_no").alias("pred_no"), F.col("other_no").alias("gt_no"))
    return m.join(pairs, ["page_id", "pred_no", "gt_no"]).groupBy(F.col("gt_class").alias("true_class"), "pred_class").agg(F.count("*").alias("n"))


def match_calibration(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(page_id, pred_no, confidence, correct) of every prediction on images that have both kinds of boxes; same class,
    overlap of at least one half."""
    pairs = candidates(gt, pred).where(f"{ONE_CLASS} and 2 * inter >= uni")
    m = greedy(pairs, "pred_no", "gt_no").select("page_id", F.col("driver_no").alias("pred_no"), F.lit(True).alias("correct"))
    every = pred.join(gt.select("page_id").distinct(), "page_id", "left_semi").select("page_id", F.col("ann_no").alias("pred_no"), F.col("score").alias("confidence"))
    return every.join(m, ["page_id", "pred_no"], "left").withColumn("correct", F.coalesce("correct", F.lit(False)))


def mine_errors(gt: DataFrame, pred: DataFrame, *also: str) -> DataFrame:
    """(page_id, kind, ann_no, then `also`): missed boxes (fn) and, on images with true boxes, predictions that match none
    (fp), with columns of theirs; gt has no score, which is 0. What an image's boxes took, which is as few as they are,
    meets them by image, so that they stay where they were matched."""
    pairs = candidates(gt, pred).where(f"{ONE_CLASS} and 2 * inter >= uni")
    taken = greedy(pairs, "gt_no", "pred_no").groupBy("page_id").agg(F.collect_list("driver_no").alias("fn"), F.collect_list("other_no").alias("fp"))
    images = gt.select("page_id").distinct().join(taken, "page_id", "left")
    gt = gt if "score" in gt.columns else gt.withColumn("score", F.lit(0.0))
    free = lambda t, kind: t.join(images, "page_id").where(~F.coalesce(F.array_contains(kind, F.col("ann_no").cast("long")), F.lit(False))).select("page_id", F.lit(kind).alias("kind"), "ann_no", *also)
    return free(gt, "fn").unionByName(free(pred, "fp"))


def suppress(pred: DataFrame, overlap: float = 0.4, least: float = 0.0) -> DataFrame:
    """Non-maximum suppression: by descending score, a box that overlaps a kept one by more than `overlap` goes."""

    def keep(rows: list[tuple]) -> list[tuple]:
        kept: list[tuple] = []
        for r in rows:
            x, y, w, h = r[2:6]
            for k in kept:
                iw, ih = min(x + w, k[2] + k[4]) - max(x, k[2]), min(y + h, k[3] + k[5]) - max(y, k[3])
                if iw > 0 and ih > 0 and iw * ih > overlap * (w * h + k[4] * k[5] - iw * ih):
                    break
            else:
                kept.append(r)
        return kept

    some = pred.where(F.col("score") > least).select("page_id", "ann_no", "x", "y", "w", "h", "class_id", "score")
    return by_group(some, 1, [F.desc("score"), "ann_no"], keep, some._jdf.schema().toDDL())


def precision_at(gt: DataFrame, pred: DataFrame, percents: tuple[int, ...]) -> DataFrame:
    """(class_id, percent, ap) at each least overlap: area under the precision envelope at 101 recalls, by predictions of
    descending score. Predictions are counted by class and score before they meet the overlaps."""
    spark, path = gt.sparkSession, f"{shared_dir(gt.sparkSession)}/pairs"
    least = F.explode(F.array(*(F.lit(p) for p in percents))).alias("percent")
    of = lambda c: F.count("*").over(Window.partitionBy("page_id", c)) == 1
    pairs = candidates(gt, pred).where(f"{ONE_CLASS} and 100 * inter >= {min(percents)} * uni")
    pairs.select("page_id", "pred_no", "gt_no", F.col("pred_class").alias("class_id"), "score", "inter", "uni", (of("pred_no") & of("gt_no")).alias("alone")).write.parquet(path)
    pairs = spark.read.parquet(path)
    # a pair whose boxes are in no other pair at the least overlap is in none at any; only the others, few, meet each overlap
    met = F.array_compact(F.array(*(F.when(100 * F.col("inter") >= p * F.col("uni"), F.lit(p)) for p in percents)))
    single = pairs.where("alone").groupBy("class_id", "score", met.alias("met")).agg(F.count("*").alias("tp")).select("class_id", F.explode("met").alias("percent"), "score", "tp")
    rank = F.dense_rank().over(Window.partitionBy("page_id").orderBy(F.desc("score"), "pred_no"))
    rest = pairs.where("not alone").withColumn("__d", rank)
    m = greedy(rest.select("*", least).where("100 * inter >= percent * uni"), "__d", "gt_no", "percent")
    chosen = rest.select("page_id", F.col("__d").alias("driver_no"), "class_id", "score").distinct().join(m, ["page_id", "driver_no"]).groupBy("class_id", F.col("percent").cast("int").alias("percent"), "score").agg(F.count("*").alias("tp"))
    hits = single.unionByName(chosen).groupBy("class_id", "percent", "score").agg(F.sum("tp").alias("tp"))
    by = pred.groupBy("class_id", "score").agg(F.count("*").alias("n")).select("*", least).join(hits, ["class_id", "percent", "score"], "left").withColumn("tp", F.coalesce("tp", F.lit(0)))
    down = Window.partitionBy("class_id", "percent").orderBy(F.desc("score"))
    before = down.rowsBetween(Window.unboundedPreceding, 0)
    total = gt.groupBy("class_id").agg(F.count("*").alias("total"))
    curve = by.withColumn("__tp", F.sum("tp").over(before)).withColumn("precision", F.col("__tp") / F.sum("n").over(before)).join(total, "class_id").withColumn("recall", F.col("__tp") / F.col("total"))
    # a recall is met from its first score on, so the best precision from there is the envelope at that recall
    envelope = F.max("precision").over(down.rowsBetween(0, Window.unboundedFollowing))
    steps = F.floor(F.col("recall") * 100 + 1e-9) + 1
    reached = curve.withColumn("envelope", envelope).withColumn("steps", steps).withColumn("gained", F.col("steps") - F.coalesce(F.lag("steps").over(down), F.lit(0)))
    area = reached.groupBy("class_id", "percent").agg((F.sum(F.col("gained") * F.col("envelope")) / 101).alias("ap"))
    return total.select("class_id", least).join(area, ["class_id", "percent"], "left").withColumn("ap", F.coalesce("ap", F.lit(0.0)))


def average_precision(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(class_id, ap50)."""
    return precision_at(gt, pred, (50,)).select("class_id", F.col("ap").alias("ap50"))
