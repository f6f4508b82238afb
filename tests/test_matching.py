"""Greedy choices in rounds against one box after another."""

import random

from foliant.operators import matching


def plain(rows):
    out, taken, done = [], set(), set()
    for page, d, o, inter, uni in sorted(rows, key=lambda r: (r[0], r[1], -r[3] / r[4], r[2])):
        if (page, d) not in done and (page, o) not in taken:
            done.add((page, d))
            taken.add((page, o))
            out.append((page, d, o, inter / uni))
    return sorted(out)


def test_rounds_equal_one_after_another(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(20), rng.randrange(8), rng.randrange(8), rng.choice([3, 5, 7]), 9) for _ in range(400)]
    rows += [(99, i, i + k, 6 + k, 9) for i in range(12) for k in (0, -1) if i + k >= 0]  # each driver waits for the one before
    rows += [(98, i, 0, 5, 9) for i in range(30)] + [(97, 0, i, 5, 9) for i in range(30)] + rng.choices(rows, k=30)
    df = spark.createDataFrame(rows, "page_id long, a long, b long, inter long, uni long").repartition(3)
    got = matching.greedy(df, "a", "b")
    assert got.columns == ["page_id", "driver_no", "other_no", "overlap"]
    assert sorted(map(tuple, got.collect())) == plain(rows)
    assert matching.greedy(df.limit(0), "a", "b").count() == 0


def test_parts_of_an_image_choose_apart(spark):
    rows = [(1, 0, 0, 5, 9, 50), (1, 1, 0, 8, 9, 50), (1, 1, 0, 8, 9, 75), (1, 1, 2, 8, 9, 75)]
    got = matching.greedy(spark.createDataFrame(rows, "page_id long, a long, b long, inter long, uni long, percent int"), "a", "b", "percent")
    assert sorted((r.percent, r.driver_no, r.other_no) for r in got.collect()) == [(50, 0, 0), (75, 1, 0)]


def test_errors_keep_columns_and_predictions_carry_others(spark, sf):
    from foliant.operators import active
    from foliant.plans.catalogue import boxes, predicted, predictions

    cols = "page_id long, ann_no long, class_id int, x long, y long, w long, h long"
    gt = spark.createDataFrame([(1, 1, 0, 0, 0, 10, 10), (1, 2, 0, 50, 0, 10, 10), (2, 1, 1, 0, 0, 10, 10)], cols)
    pred = spark.createDataFrame([(1, 1, 0, 0, 0, 10, 10, 0.9), (1, 2, 1, 50, 0, 10, 10, 0.4), (3, 1, 0, 0, 0, 9, 9, 0.8)], cols + ", score double")
    errors = matching.mine_errors(gt, pred, "class_id", *"xywh", "score")
    assert {(r.page_id, r.kind, r.ann_no, r.class_id, r.x, r.score) for r in errors.collect()} == {(1, "fn", 2, 0, 50, 0.0), (2, "fn", 1, 1, 0, 0.0), (1, "fp", 2, 1, 50, 0.4)}
    names = spark.createDataFrame([(0, "Text"), (1, "Title")], "class_id int, name string")
    cases = active.error_cases(errors.selectExpr("*", "'p' file_name", "600 width", "700 height"), None, None, names)
    assert {(r.type, r.page, r.class_gt, r.class_pred) for r in cases.collect()} == {("FN", 1, "Text", "N/A"), ("FN", 2, "Title", "N/A"), ("FP", 1, "N/A", "Title")}
    one = predicted(boxes(spark, sf), "l_suppkey")
    assert sorted(map(tuple, one.drop("l_suppkey").collect())) == sorted(map(tuple, predictions(spark, sf).collect())) and one.columns[-1] == "l_suppkey"
    assert one._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1


def test_text_boxes_of_long_and_short_images_agree(spark, sf, tmp_path):
    """A prediction's text is that of the box its number names, also where an image has a hundred boxes and more."""
    from pyspark.sql import functions as F

    from foliant.plans.scores import text_boxes

    rows = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_orderkey < 100")
    for t in ("supplier", "nation"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    long_ = spark.range(1, 130).select(F.lit(10**9).cast("long").alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 10 + 1).alias("l_suppkey"), F.col("id").cast("int").alias("l_linenumber"), F.lit(3.0).alias("l_quantity"), F.lit(0.1).alias("l_discount"))
    got = []
    for more in (rows.limit(0), long_):
        rows.select(*long_.columns).unionByName(more.select(*long_.columns)).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
        pred = text_boxes(spark, str(tmp_path))[1]
        got.append(sorted(tuple(r[c] for c in sorted(pred.columns)) for r in pred.where("page_id < 100").collect()))
    assert got[0] == got[1] and got[0]


def test_blocks_are_detected_once(spark):
    from pyspark.sql import functions as F

    from foliant.operators.models import markup_blocks
    from foliant.plans import pipelines

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def marked(x):
        seen.add(1)
        return x

    pages = spark.createDataFrame([(i, f"<h1>t{i}</h1><p>the cat</p>") for i in range(6)], "page_id long, html string")
    found = pipelines.layout(pages, lambda p: markup_blocks(p.withColumn("html", marked("html"))))
    assert found.count() == 12 and seen.value == 6


def test_boxes_are_dealt_once_before_they_are_matched(spark, sf):
    """True boxes and predictions of an image meet, and its pairs are counted by box, where both were numbered; the same
    rows as a join by class."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from foliant.plans.catalogue import boxes, predictions

    gt, pred = boxes(spark, sf), predictions(spark, sf)
    pairs = matching.candidates(gt, pred).where(matching.ONE_CLASS)
    lone = pairs.withColumns({c: F.count("*").over(Window.partitionBy("page_id", f"{c}_no")) for c in ("gt", "pred")})
    for threshold in ("-1", "1m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        plan = lone.where("true")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(") == 2
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_class = gt.alias("g").join(pred.alias("p"), ["page_id", "class_id"]).where("least(g.x + g.w, p.x + p.w) > greatest(g.x, p.x) and least(g.y + g.h, p.y + p.h) > greatest(g.y, p.y)")
    got = sorted((r.page_id, r.gt_no, r.pred_no) for r in pairs.collect())
    assert got and got == sorted(map(tuple, by_class.select("page_id", "g.ann_no", "p.ann_no").collect()))


def test_predictions_are_those_of_two_looks(spark, sf):
    """Near and far predictions told in one look equal both parts read apart, also where numbers are null; sums by class
    need no numbered boxes."""
    from foliant.plans.catalogue import boxes, predicted, predictions

    cols = ["page_id", "ann_no", *"xywh", "class_id", "l_suppkey", "l_discount"]
    some = boxes(spark, sf).where("page_id < 300").select(cols)
    gt = spark.createDataFrame(some.collect() + [(-1, 1, 5, 5, 5, 5, 0, None, 0.1)], some.schema)
    near = gt.where("l_suppkey % 13 <> 0").selectExpr("page_id", "ann_no", "x + l_suppkey % 60 x", "y", "w", "h", "if(l_suppkey % 11 = 0, (class_id + 1) % 5, class_id) class_id", "1 - l_discount * 5 score")
    far = gt.where("l_suppkey % 17 = 0").selectExpr("page_id", "ann_no + 100", "x", "y + 450", "w", "h", "class_id", "double('0.3') + l_discount * 5")
    got = predicted(gt)
    assert got.dtypes == near.dtypes and far.count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, near.unionByName(far.toDF(*near.columns)).collect()))
    counted = predictions(spark, sf).groupBy("class_id", "score").count()
    assert "Window" not in counted._jdf.queryExecution().optimizedPlan().toString()
