"""Evaluation summaries: languages, texts, descriptions, detections, throughput, statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.functions.geometry import intersection
from foliant.operators import matching as M
from foliant.operators.alignment import Encoder, bert_scores, letters
from foliant.operators.documents import DESCRIBED, TEXTUAL
from foliant.session import checkpoint, shared_dir

#: Least areas of medium and large boxes, detections an image may have, recalls, and overlaps in percent.
SMALL, LARGE, MOST_DETECTIONS, RECALLS = 32 * 32, 96 * 96, (1, 10, 100), 101
OVERLAPS = tuple(range(50, 100, 5))
#: What each metric of a dashboard has to be over (text errors: under).
DASHBOARD = (("coco", "mAP_0.5", 0.7), ("text", "mean_cer", 0.1), ("langid", "accuracy", 0.8), ("descriptions", "bleu", 0.3))


def zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def square_confusion(rows: DataFrame, truth: str, guess: str) -> DataFrame:
    """(truth, guess, n) for every pair of labels seen on either side, in sorted order; 0 for pairs that don't occur.
    Labels are as few as classes or languages; their pairs are made from one array of them. Rows are counted once, the
    counts written and read twice."""
    counted = checkpoint(rows.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count("*").alias("n")))
    labels = counted.select(F.explode(F.array("truth", "guess")).alias("l")).agg(F.sort_array(F.collect_set("l")).alias("ls"))
    every = labels.select(F.explode("ls").alias("truth"), "ls").select("truth", F.explode("ls").alias("guess"))
    return every.join(counted, ["truth", "guess"], "left").select("truth", "guess", F.coalesce("n", F.lit(0)).alias("n"))


def language_summary(rows: DataFrame, truth: str, guess: str, confidence: str) -> DataFrame:
    """One row: accuracy, total, correct, and mean, population deviation, least and largest confidence."""
    hit = F.col(truth) == F.col(guess)
    return rows.agg(
        zero(F.avg(hit.cast("double"))).alias("accuracy"), F.count("*").alias("total"), F.count_if(hit).alias("correct"), F.avg(confidence).alias("conf_mean"), F.stddev_pop(confidence).alias("conf_std"),
        F.min(confidence).alias("conf_min"), F.max(confidence).alias("conf_max"),
    )


def text_matches(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(page_id, gt_no, pred_no, overlap): each true text box, in file order, takes the free predicted text box of any
    textual class that overlaps it most, by more than one half. Boxes have page_id, ann_no, class (a name), x, y, w, h."""
    some = lambda t: t.where(F.col("class").isin(*TEXTUAL)).withColumn("class_id", F.lit(0))
    guesses = some(pred)
    if "score" not in pred.columns:
        guesses = guesses.withColumn("score", F.lit(1.0))
    m = M.greedy(M.candidates(some(gt), guesses).where("2 * inter > uni"), "gt_no", "pred_no")
    return m.select("page_id", F.col("driver_no").alias("gt_no"), F.col("other_no").alias("pred_no"), "overlap")


def text_errors(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(page_id, gt_no, class, cer, wer) of matched boxes whose texts are both not empty."""
    # only textual boxes match; they are written once, for their places are asked for first and their texts after
    spark, path = gt.sparkSession, shared_dir(gt.sparkSession)
    for t, name, also in ((gt, "gt", []), (pred, "pred", ["score"] if "score" in pred.columns else [])):
        t.where(F.col("class").isin(*TEXTUAL)).select("page_id", "ann_no", "class", *"xywh", "text", *also).write.parquet(f"{path}/{name}")
    gt, pred = (spark.read.parquet(f"{path}/{name}") for name in ("gt", "pred"))
    m = text_matches(gt, pred)
    a = gt.select("page_id", F.col("ann_no").cast("long").alias("gt_no"), "class", F.col("text").alias("a")).where("a <> ''")
    b = pred.select("page_id", F.col("ann_no").cast("long").alias("pred_no"), F.col("text").alias("b")).where("b <> ''")
    rows = m.join(a, ["page_id", "gt_no"]).join(b, ["page_id", "pred_no"])
    rows = rows.select("page_id", "gt_no", "class", "a", "b", X.words(F.col("a")).alias("wa"), X.words(F.col("b")).alias("wb"))
    return rows.select("page_id", "gt_no", "class", X.char_error_rate(F.col("a"), F.col("b")).alias("cer"), X.word_error_rate(F.col("wa"), F.col("wb")).alias("wer"))


def error_summary(errors: DataFrame, classes: tuple[str, ...] = TEXTUAL) -> DataFrame:
    """(class, count, mean_cer, mean_wer, std_cer, std_wer) of all (class null) and of each class; 0 without any."""
    stats = [F.count("cer").alias("count"), *(zero(f(c)).alias(f"{n}_{c}") for n, f in (("mean", F.avg), ("std", F.stddev_pop)) for c in ("cer", "wer"))]
    names = errors.sparkSession.createDataFrame([(c,) for c in classes], "class string")
    # classes are few: all and each are told in one pass, in which a class without errors counts by a row of nulls
    rows = errors.select("class", "cer", "wer").unionByName(names.select("class", F.lit(None).cast("double").alias("cer"), F.lit(None).cast("double").alias("wer")))
    both = rows.select("cer", "wer", F.explode(F.array(F.struct(F.lit(True).alias("all"), F.lit(None).cast("string").alias("class")), F.struct(F.lit(False).alias("all"), F.col("class")))).alias("k"))
    g = both.groupBy("k.all", "k.class").agg(*stats)
    return g.where(F.col("all") | F.col("class").isin(*classes)).select("class", "count", "mean_cer", "mean_wer", "std_cer", "std_wer")


def description_pairs(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(key, class, prediction, reference) of described elements whose texts are both not empty. Of references with the
    same key the last (by pos) counts; every prediction does. pred has key, class, text; ref has key, text, pos."""
    last = ref.groupBy("key").agg(F.max_by(F.struct(F.col("text").alias("t")), "pos").alias("r")).select("key", F.col("r.t").alias("reference"))
    rows = pred.where(F.col("class").isin(*DESCRIBED)).join(last, "key")
    return rows.select("key", "class", F.col("text").alias("prediction"), "reference").where("prediction <> '' and reference <> ''")


def description_scores(pairs: DataFrame, encode: Encoder = letters) -> DataFrame:
    """Pairs with bleu of lower-case words, and bertscore: F1 of their alignment by the encoder's vectors."""
    rows = pairs.select("*", X.words(F.lower("reference")).alias("__a"), X.words(F.lower("prediction")).alias("__b"))
    scored = rows.select(*pairs.columns, X.bleu(F.col("__a"), F.col("__b")).alias("bleu"))
    return bert_scores(scored, "reference", "prediction", encode).withColumnRenamed("f1", "bertscore").drop("precision", "recall")


def description_summary(scores: DataFrame) -> DataFrame:
    """(class, count, bleu_mean, bleu_std, bleu_min, bleu_max, bertscore_mean) of all (class null) and of each class."""
    stats = [F.count("*").alias("count"), F.avg("bleu").alias("bleu_mean"), F.stddev_pop("bleu").alias("bleu_std"), F.min("bleu").alias("bleu_min"), F.max("bleu").alias("bleu_max"), F.avg("bertscore").alias("bertscore_mean")]
    return scores.agg(*stats).select(F.lit(None).cast("string").alias("class"), "*").unionByName(scores.groupBy("class").agg(*stats))


def match_totals(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """One row: true boxes, predictions on their images, matched, false positives and false negatives, by predictions in
    file order of any class that overlap by more than one half."""
    matched = M.greedy(M.candidates(gt, pred).where("2 * inter > uni"), "pred_no", "gt_no").agg(F.count("*").alias("matched"))
    on = pred.join(gt.select("page_id").distinct(), "page_id", "left_semi").agg(F.count("*").alias("total_pred"))
    row = gt.agg(F.count("*").alias("total_gt")).crossJoin(on).crossJoin(matched)  # one row each
    return row.select("*", (F.col("total_pred") - F.col("matched")).alias("false_positives"), (F.col("total_gt") - F.col("matched")).alias("false_negatives"))


#: Least overlaps as shares, and size ranges 0 to 3 as least and largest area; a mask has bit 4 * overlap + size.
SHARES = tuple(p / 100 - 1e-10 for p in OVERLAPS)
SIZES = ((0, 1e20), (0, SMALL), (SMALL, LARGE), (LARGE, 1e20))


def _decided(rows: list[tuple]) -> list[tuple]:
    """Greedy choices of one image and class at every overlap and size range, from (page_id, class_id, place, gt_no, inter,
    uni, gt_area) in the order of place and gt_no: (page_id, class_id, place, masks of what it took inside and outside the
    range)."""
    by_place: dict[int, list[tuple]] = {}
    for _, _, place, g, inter, uni, area in rows:
        by_place.setdefault(place, []).append((g, inter, uni, area))
    masks = {place: [0, 0] for place in by_place}
    for i, share in enumerate(SHARES):
        for size, (low, high) in enumerate(SIZES):
            taken: set = set()
            for place, pairs in by_place.items():
                best, mine, inside = share, None, False
                for own in (True, False):  # boxes out of the range are taken only where none within it is
                    for g, inter, uni, area in pairs:
                        if (low <= area <= high) is own and g not in taken and inter >= best * uni:
                            best, mine, inside = inter / uni, g, own
                    if mine is not None:
                        break
                if mine is not None:
                    taken.add(mine)
                    masks[place][0 if inside else 1] |= 1 << 4 * i + size
    return [(*rows[0][:2], place, *both) for place, both in masks.items() if any(both)]


def detection_table(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(class_id, percent, size, most, ap, recall): average precision over 101 recalls and largest recall, for each
    class, overlap, size range (0 all, 1 small, 2 medium, 3 large) and number of detections an image may have.

    Predictions of an image and class are taken by descending score (ties in file order). A true box outside the size
    range neither counts nor costs; nor does an unmatched prediction outside it. Classes and ranges without a true box
    have no row. Predictions of equal score count together.
    """
    spark, path, keys = gt.sparkSession, f"{shared_dir(gt.sparkSession)}/near", ["page_id", "class_id", "place"]
    places = Window.partitionBy("page_id", "class_id").orderBy(F.desc("score"), "ann_no")
    dt = pred.withColumn("place", F.row_number().over(places).cast("long")).where(F.col("place") <= MOST_DETECTIONS[-1])
    a = gt.select("page_id", "class_id", F.col("ann_no").alias("gt_no"), *(F.col(c).alias(f"g{c}") for c in "xywh"))
    b = dt.select(*keys, *(F.col(c).alias(f"p{c}") for c in "xywh"))
    inter = intersection(*(tuple(F.col(f"{k}{c}") for c in "xywh") for k in "gp")).cast("long")
    pairs = a.join(b, ["page_id", "class_id"]).withColumn("inter", inter).where("inter > 0").withColumn("uni", (F.col("gw") * F.col("gh") + F.col("pw") * F.col("ph")).cast("long") - F.col("inter"))
    near = pairs.where("2 * inter >= uni").select(*keys, "gt_no", "inter", "uni", (F.col("gw") * F.col("gh")).cast("double").alias("gt_area"))
    # a pair whose boxes are in no other pair is told at once; the others, which are few, are chosen among in Python
    alone = (F.count("*").over(Window.partitionBy("page_id", "class_id", "place")) == 1) & (F.count("*").over(Window.partitionBy("page_id", "class_id", "gt_no")) == 1)
    near.select("*", alone.alias("alone")).write.parquet(path)
    near = spark.read.parquet(path)
    bits = lambda conds, step: sum((F.when(c, F.lit(1 << step * i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(conds)), F.lit(0).cast("long"))
    enough = bits([F.col("inter") >= F.lit(share) * F.col("uni") for share in SHARES], 4)
    inside = bits([F.col("gt_area").between(float(low), float(high)) for low, high in SIZES], 1)
    single = near.where("alone").select(*keys, (enough * inside).alias("own"), (enough * (15 - inside)).alias("other"))
    rest = M.by_group(near.where("not alone").drop("alone"), 2, ["place", "gt_no"], _decided, f"page_id long, class_id {near.schema['class_id'].dataType.simpleString()}, place long, own long, other long")
    hits = single.unionByName(rest)
    within = lambda area, size: F.when(size == 1, area <= SMALL).when(size == 2, (area >= SMALL) & (area <= LARGE)).when(size == 3, area >= LARGE).otherwise(F.lit(True))
    # predictions of a class, score, masks and least number that counts them are counted before they meet the overlaps
    least = sum(((F.col("place") > m).cast("int") for m in MOST_DETECTIONS), F.lit(0))
    sizes = bits([within(F.col("w") * F.col("h"), F.lit(s)) for s in range(4)], 1)
    mask = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    each = dt.select(*keys, "score", sizes.alias("sizes"), least.alias("least")).join(hits, keys, "left")
    alike = each.groupBy("class_id", "score", "sizes", "least", mask("own"), mask("other")).agg(F.count("*").alias("n"))
    grid = F.explode(F.array(*(F.struct(F.lit(p).alias("percent"), F.lit(s).alias("size"), F.lit(1 << 4 * i + s).cast("long").alias("bit")) for i, p in enumerate(OVERLAPS) for s in range(4))))
    has = lambda c: F.col(c).bitwiseAND(F.col("g.bit")) != 0
    state = F.when(has("own"), 1).when(~has("other") & (F.col("sizes").bitwiseAND(F.element_at(F.array(*(F.lit(1 << s).cast("long") for s in range(4))), F.col("g.size") + 1)) != 0), 0)  # true, false, or neither
    counted = alike.select("*", grid.alias("g")).withColumn("tp", state).where("tp is not null")
    counted = counted.select("class_id", "g.percent", "g.size", "score", "least", "tp", "n", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(m).alias("most")) for i, m in enumerate(MOST_DETECTIONS)))).alias("m")).where("least <= m.i")
    keys = ["class_id", "percent", "size", "most"]
    by = counted.select("*", "m.most").groupBy(*keys, "score").agg(F.sum(F.col("tp") * F.col("n")).alias("tp"), F.sum("n").alias("n"))
    area = F.col("w") * F.col("h")
    sized = gt.select("class_id", F.explode(F.array(*(F.when(within(area, F.lit(s)), F.lit(s)) for s in range(4)))).alias("size")).where("size is not null")
    totals = sized.groupBy("class_id", "size").agg(F.count("*").alias("total"))
    down = Window.partitionBy(*keys).orderBy(F.desc("score"))
    so_far = down.rowsBetween(Window.unboundedPreceding, 0)
    curve = by.withColumn("__tp", F.sum("tp").over(so_far)).withColumn("precision", F.col("__tp") / F.sum("n").over(so_far)).join(F.broadcast(totals), ["class_id", "size"]).withColumn("recall", F.col("__tp") / F.col("total"))
    envelope = F.max("precision").over(down.rowsBetween(0, Window.unboundedFollowing))
    steps = F.floor(F.col("recall") * (RECALLS - 1) + 1e-9) + 1
    curve = curve.withColumn("envelope", envelope).withColumn("steps", F.when(F.col("__tp") > 0, steps).otherwise(F.lit(0)))
    gained = F.col("steps") - F.coalesce(F.lag("steps").over(down), F.lit(0))
    got = curve.withColumn("__g", gained * F.col("envelope")).groupBy(*keys).agg((F.sum("__g") / RECALLS).alias("ap"), F.max("recall").alias("recall"))
    limits = totals.select("class_id", "size", F.explode(F.array(*(F.lit(p) for p in OVERLAPS))).alias("percent")).select("*", F.explode(F.array(*(F.lit(m) for m in MOST_DETECTIONS))).alias("most"))
    return limits.join(got, keys, "left").select(*keys, zero(F.col("ap")).alias("ap"), zero(F.col("recall")).alias("recall"))


def detection_metrics(table: DataFrame) -> DataFrame:
    """(metric, value): the twelve numbers, means over classes and overlaps of detection_table; null without a box."""
    most, size, half = F.col("most"), F.col("size"), F.col("percent")
    top = most == MOST_DETECTIONS[-1]
    wanted = {
        "mAP_0.5_0.95": ("ap", top & (size == 0)), "mAP_0.5": ("ap", top & (size == 0) & (half == 50)), "mAP_0.75": ("ap", top & (size == 0) & (half == 75)),
        "mAP_small": ("ap", top & (size == 1)), "mAP_medium": ("ap", top & (size == 2)), "mAP_large": ("ap", top & (size == 3)),
        **{f"AR_{m}": ("recall", (most == m) & (size == 0)) for m in MOST_DETECTIONS}, "AR_small": ("recall", top & (size == 1)), "AR_medium": ("recall", top & (size == 2)), "AR_large": ("recall", top & (size == 3)),
    }
    row = table.agg(*(F.avg(F.when(cond, F.col(c))).alias(f"m{i}") for i, (c, cond) in enumerate(wanted.values())))
    return row.select(F.explode(F.array(*(F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("value")) for i, name in enumerate(wanted)))).alias("e")).select("e.*")


def class_metrics(table: DataFrame) -> DataFrame:
    """(class_id, ap50, ap, recall) of each class, at all sizes and most detections."""
    some = table.where((F.col("most") == MOST_DETECTIONS[-1]) & (F.col("size") == 0))
    return some.groupBy("class_id").agg(F.avg(F.when(F.col("percent") == 50, F.col("ap"))).alias("ap50"), F.avg("ap").alias("ap"), F.avg("recall").alias("recall"))


def by_file_name(pred: DataFrame, images: DataFrame) -> DataFrame:
    """Predictions that name a file, with its image_id; others go."""
    return pred.join(images.select(F.col("file_name").alias("image_name"), "image_id"), "image_name")


def same_files(gt: DataFrame, gt_images: DataFrame, pred: DataFrame, pred_images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Boxes of two sets with ids of their own, both under the true set's image_id where the files' names agree."""
    ids = gt_images.select("file_name", F.col("image_id").alias("__gt")).join(pred_images.select("file_name", F.col("image_id").alias("__pred")), "file_name").select("__gt", "__pred")
    moved = pred.join(ids, F.col("image_id") == F.col("__pred")).withColumn("image_id", F.col("__gt")).drop("__gt", "__pred")
    return gt.join(ids.select(F.col("__gt").alias("image_id")), "image_id", "left_semi"), moved


def throughput(runs: DataFrame, group: str, pages: str, seconds: str, success: str) -> DataFrame:
    """(group, runs, failed, pages, seconds, pages_per_s, mean_pages_per_s) over the successful runs."""
    good = F.col(success)
    rate = F.try_divide(F.col(pages).cast("double"), F.col(seconds))
    g = runs.groupBy(group).agg(F.count("*").alias("runs"), F.count_if(~good).alias("failed"), F.sum(F.when(good, F.col(pages))).alias("pages"), F.sum(F.when(good, F.col(seconds))).alias("seconds"), F.avg(F.when(good, rate)).alias("mean_pages_per_s"))
    return g.withColumn("pages_per_s", F.try_divide(F.col("pages").cast("double"), F.col("seconds")))


def dashboard(metrics: DataFrame) -> DataFrame:
    """(area, metric, value, good): whether each metric is past its mark; null where it wasn't measured. metrics has
    metric and value."""
    marks = metrics.sparkSession.createDataFrame(list(DASHBOARD), "area string, metric string, mark double")
    good = F.when(F.col("area") == "text", F.col("value") < F.col("mark")).otherwise(F.col("value") > F.col("mark"))
    return marks.join(metrics, "metric", "left").select("area", "metric", "value", good.alias("good"))


def histogram(rows: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """(bin, low, high, n) of equal widths from the least to the largest value; the last bin holds the largest."""
    ends = rows.agg(F.min(value).cast("double").alias("__lo"), F.max(value).cast("double").alias("__hi"))
    at = F.least(F.lit(bins - 1), F.floor(F.try_divide((F.col(value) - F.col("__lo")) * bins, F.col("__hi") - F.col("__lo")))).cast("int")
    n = rows.where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.coalesce(at, F.lit(0)).alias("bin")).agg(F.count("*").alias("n"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    every = ends.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(n, "bin", "left").select("bin", (F.col("__lo") + F.col("bin") * width).alias("low"), (F.col("__lo") + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def most_common(rows: DataFrame, group: str, value: str, order: str, n: int) -> DataFrame:
    """(group, value, n, rank): a group's n commonest values; the earliest of equals by `order`."""
    counted = rows.groupBy(group, value).agg(F.count("*").alias("n"), F.min(order).alias("__o"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), "__o", value)
    return counted.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n).drop("__o")


def qa_summary(flagged: DataFrame, total: Column | None = None) -> DataFrame:
    """(issue, severity, class, n) counted by each of the three in one pass; the others are null. flagged has one row a flag."""
    sets = [[F.col("issue")], [F.col("severity")], [F.col("class")]]
    return flagged.groupingSets(sets, "issue", "severity", "class").agg(F.count("*").alias("n"))


def flag_rate(elements: DataFrame, flags: str) -> DataFrame:
    """One row: elements, those with a flag, and their share. flags: a column of arrays."""
    g = elements.agg(F.count("*").alias("total"), F.count_if(F.size(flags) > 0).alias("flagged"))
    return g.withColumn("flag_rate", F.coalesce(F.try_divide(F.col("flagged").cast("double"), F.col("total")), F.lit(0.0)))
