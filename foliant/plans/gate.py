"""Queries of the dataset gate: label, annotation, image and file name audits, repairs, licences, directions, skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import text as X
from foliant.operators import quality as Q
from foliant.plans.catalogue import BOXES, boxes, query, read

#: Label lines made of the boxes: fractions of a page of 600 x 700, some with an unknown class, a corner left of the page,
#: or no width. Pages are files; those of orders without items are empty.
LABELS = BOXES + """, lab AS (SELECT 'page_' || page_id file, ann_no line_no, CASE WHEN l_suppkey % 19 = 0 THEN class_id + 4 ELSE class_id END class_id, CASE WHEN l_suppkey % 23 = 0 THEN -0.01::DOUBLE ELSE (x + w / 2) / 600 END x,
 (y + h / 2) / 700 y, CASE WHEN l_suppkey % 29 = 0 THEN 0::DOUBLE ELSE w / 600 END w, h / 700 h FROM gt), files AS (SELECT 'page_' || o_orderkey file FROM orders),
found AS (SELECT file entity, line_no, unnest(list_filter([CASE WHEN class_id > 4 THEN 'unknown_class' END, CASE WHEN x < 0 OR y < 0 OR w <= 0 OR h <= 0 THEN 'invalid_coords' END, CASE WHEN x + w > 1 OR y + h > 1 THEN 'out_of_bounds' END], lambda i: i IS NOT NULL)) issue FROM lab
 UNION ALL SELECT file, NULL, 'empty_labels' FROM files WHERE file NOT IN (SELECT file FROM lab))
"""


def labels(spark, sf_dir) -> DataFrame:
    b = boxes(spark, sf_dir)
    x, y, w, h = (F.col(c).cast("double") for c in "xywh")
    return b.select(
        F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("file"), F.col("ann_no").alias("line_no"), F.when(F.col("l_suppkey") % 19 == 0, F.col("class_id") + 4).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("l_suppkey") % 23 == 0, F.lit(-0.01)).otherwise((x + w / 2) / 600).alias("x"), ((y + h / 2) / 700).alias("y"), F.when(F.col("l_suppkey") % 29 == 0, F.lit(0.0)).otherwise(w / 600).alias("w"), (h / 700).alias("h"),
    )


def label_files(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.concat(F.lit("page_"), F.col("o_orderkey").cast("string")).alias("file"))


def label_findings(spark, sf_dir) -> DataFrame:
    return Q.label_issues(labels(spark, sf_dir), files=label_files(spark, sf_dir))


def rounded(df: DataFrame, *names: str, places: int = 9) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


@query(LABELS + "SELECT issue, count(*) n, count(DISTINCT entity) entities FROM found GROUP BY issue")
def q_label_audit(spark, sf_dir):
    return Q.issue_counts(label_findings(spark, sf_dir))


@query(LABELS + "SELECT entity, line_no, issue FROM found")
def q_label_findings(spark, sf_dir):
    return label_findings(spark, sf_dir).select("entity", "line_no", "issue")


@query(LABELS + "SELECT issue, count(*) n FROM (SELECT unnest(list_filter([CASE WHEN x - w / 2 < 0 OR x + w / 2 > 1 OR y - h / 2 < 0 OR y + h / 2 > 1 THEN 'out_of_bounds' END], lambda i: i IS NOT NULL)) issue FROM lab) GROUP BY issue")
def q_label_audit_centers(spark, sf_dir):
    """Bounds by true centres."""
    return Q.label_issues(labels(spark, sf_dir), strict_center=True).where("issue = 'out_of_bounds'").groupBy("issue").agg(F.count("*").alias("n"))


@query(LABELS + "SELECT file, count(*) n_lines, count_if(class_id BETWEEN 0 AND 4 AND x BETWEEN 0 AND 1 AND y BETWEEN 0 AND 1 AND w > 0 AND w <= 1 AND h > 0 AND h <= 1 AND x + w <= 1 AND y + h <= 1) n_valid, n_valid > 0 valid FROM lab GROUP BY file")
def q_label_validity(spark, sf_dir):
    return Q.validate_files(labels(spark, sf_dir))


REPAIRED = """, c AS (SELECT file, line_no, class_id, greatest(0, least(1, x)) x, greatest(0, least(1, y)) y, greatest(0.001, least(1, w)) w, greatest(0.001, least(1, h)) h FROM lab),
rep AS (SELECT * FROM (SELECT file, line_no, class_id, x, y, CASE WHEN x + w > 1 THEN 1 - x ELSE w END w, CASE WHEN y + h > 1 THEN 1 - y ELSE h END h FROM c) WHERE w > 0.001 AND h > 0.001)"""


@query(LABELS + REPAIRED + " SELECT file, line_no, class_id, round(x, 9) x, round(y, 9) y, round(w, 9) w, round(h, 9) h FROM rep")
def q_label_repair(spark, sf_dir):
    return rounded(Q.repair_labels(labels(spark, sf_dir))[0], *"xywh")


@query(LABELS + REPAIRED + " SELECT f.file, CASE WHEN f.file NOT IN (SELECT entity FROM found) THEN 'copy' WHEN f.file IN (SELECT file FROM rep) THEN 'fix' ELSE 'quarantine' END \"action\" FROM files f")
def q_label_triage(spark, sf_dir):
    """What happens to each file: copied, repaired, or put aside because no line survives or there is none."""
    good = Q.repair_labels(labels(spark, sf_dir))[0].select(F.col("file").alias("entity"))
    return Q.triage(label_files(spark, sf_dir), "file", label_findings(spark, sf_dir), good)


@query(LABELS + """, f AS (SELECT file, line_no, class_id, bad, CASE WHEN bad THEN greatest(0, x) ELSE x END x, CASE WHEN bad THEN greatest(0, y) ELSE y END y, CASE WHEN bad THEN greatest(0.001, w) ELSE w END w, CASE WHEN bad THEN greatest(0.001, h) ELSE h END h
 FROM (SELECT *, x < 0 OR y < 0 OR w <= 0 OR h <= 0 bad FROM lab WHERE class_id <= 4))
SELECT file, line_no, class_id, round(CASE WHEN x + w > 1 OR y + h > 1 THEN least(x, 1 - w) ELSE x END, 9) x, round(CASE WHEN x + w > 1 OR y + h > 1 THEN least(y, 1 - h) ELSE y END, 9) y, round(w, 9) w, round(h, 9) h FROM f""")
def q_label_fix(spark, sf_dir):
    """The audit's mending in place."""
    return rounded(Q.fix_labels(labels(spark, sf_dir)), *"xywh")


#: Annotations with corners off the page, no size, no category, or beyond the largest coordinate.
ANNOTATIONS = BOXES + """, ann AS (SELECT page_id * 1000 + ann_no ann_id, CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE class_id END category_id, x - CASE WHEN l_suppkey % 7 = 0 THEN 300 ELSE 0 END x, y, CASE WHEN l_suppkey % 29 = 0 THEN 0 ELSE w END + CASE WHEN l_suppkey % 37 = 0 THEN 20000 ELSE 0 END w,
 CASE WHEN l_suppkey % 41 = 0 THEN -5 ELSE h END h FROM gt)
"""


def noisy_annotations(spark, sf_dir) -> DataFrame:
    s = F.col("l_suppkey")
    return boxes(spark, sf_dir).select(
        (F.col("page_id") * 1000 + F.col("ann_no")).alias("ann_id"), F.when(s % 31 != 0, F.col("class_id")).alias("category_id"), (F.col("x") - F.when(s % 7 == 0, 300).otherwise(0)).alias("x"), "y",
        (F.when(s % 29 == 0, 0).otherwise(F.col("w")) + F.when(s % 37 == 0, 20000).otherwise(0)).alias("w"), F.when(s % 41 == 0, -5).otherwise(F.col("h")).alias("h"),
    )


@query(ANNOTATIONS + "SELECT CAST(ann_id AS VARCHAR) entity, unnest(list_filter([CASE WHEN x < 0 OR y < 0 OR w <= 0 OR h <= 0 THEN 'invalid_coords' END, CASE WHEN category_id IS NULL THEN 'missing_category' END], lambda i: i IS NOT NULL)) issue FROM ann UNION ALL SELECT 'Footnote', 'unknown_class'")
def q_annotation_audit(spark, sf_dir):
    """A class that is declared but no category counts too."""
    declared = spark.createDataFrame([(c,) for c in (*Q.CLASSES, "Footnote")], "class string")
    categories = spark.createDataFrame([(c,) for c in Q.CLASSES], "name string")
    return Q.annotation_issues(noisy_annotations(spark, sf_dir), categories, declared).select("entity", "issue")


@query(ANNOTATIONS + "SELECT ann_id, category_id, greatest(0, x) x, greatest(0, y) y, CASE WHEN greatest(0, x) + greatest(1, w) > 10000 THEN 10000 - greatest(0, x) ELSE greatest(1, w) END w, greatest(1, h) h FROM ann")
def q_annotation_repair(spark, sf_dir):
    return Q.repair_annotations(noisy_annotations(spark, sf_dir))


@query(ANNOTATIONS + "SELECT ann_id, category_id, CASE WHEN bad THEN greatest(0, x) ELSE x END x, CASE WHEN bad THEN greatest(0, y) ELSE y END y, CASE WHEN bad THEN greatest(1, w) ELSE w END w, CASE WHEN bad THEN greatest(1, h) ELSE h END h FROM (SELECT *, x < 0 OR y < 0 OR w <= 0 OR h <= 0 bad FROM ann)")
def q_annotation_fix(spark, sf_dir):
    return Q.fix_annotations(noisy_annotations(spark, sf_dir))


#: Images made of parts: some unreadable, tiny, long or with much EXIF.
IMAGES = "WITH img AS (SELECT p_name || '_' || p_partkey || CASE WHEN p_size % 3 = 0 THEN '.PNG' ELSE '.jpg' END path, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 50 * p_size + 30 END width, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS INT) % 1300 + 20 END height, CAST(CASE WHEN p_partkey % 23 = 0 THEN 20000 ELSE 100 END AS INT) exif FROM part)"


def images(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part")
    some = F.col("p_partkey") % 17 != 0
    return p.select(
        F.concat("p_name", F.lit("_"), F.col("p_partkey").cast("string"), F.when(F.col("p_size") % 3 == 0, ".PNG").otherwise(".jpg")).alias("path"), F.when(some, 50 * F.col("p_size") + 30).alias("width"),
        F.when(some, F.floor("p_retailprice").cast("int") % 1300 + 20).alias("height"), F.when(F.col("p_partkey") % 23 == 0, 20000).otherwise(100).alias("exif_bytes"),
    )


@query(IMAGES + " SELECT path entity, unnest(list_filter([CASE WHEN width IS NULL THEN 'unreadable' END, CASE WHEN least(width, height) < 400 THEN 'tiny_dims' END, CASE WHEN greatest(width, height) > 10 * least(width, height) THEN 'extreme_aspect_ratio' END, CASE WHEN exif > 10000 THEN 'corrupt_exif' END], lambda i: i IS NOT NULL)) issue FROM img")
def q_image_sanity(spark, sf_dir):
    return Q.image_issues(images(spark, sf_dir)).select("entity", "issue")


@query(IMAGES + """ SELECT path, CAST(CASE WHEN s < 400 THEN floor(width * (400::DOUBLE / s)) WHEN l > 10 * s AND width > height THEN least(width, height * 5) ELSE width END AS INT) new_w,
 CAST(CASE WHEN s < 400 THEN floor(height * (400::DOUBLE / s)) WHEN l > 10 * s AND width <= height THEN least(height, width * 5) ELSE height END AS INT) new_h FROM (SELECT *, least(width, height) s, greatest(width, height) l FROM img WHERE width IS NOT NULL)""")
def q_image_plan(spark, sf_dir):
    w, h = Q.image_plan(F.col("width"), F.col("height"))
    return images(spark, sf_dir).where("width is not null").select("path", w.cast("int").alias("new_w"), h.cast("int").alias("new_h"))


NAMES = "WITH n AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || '.png' WHEN 1 THEN lower(c_mktsegment) || ' é' || c_custkey % 50 || '.jpg' WHEN 2 THEN 'page_' || c_custkey || '.jpg' ELSE upper(c_mktsegment) || ' ' || c_custkey % 50 || '.JPG' END AS name FROM customer), m AS (SELECT *, regexp_matches(name, '[^\\x00-\\x7F]') non_ascii, contains(name, ' ') spaces, name <> lower(name) uppercase FROM n), s AS (SELECT *, CASE WHEN non_ascii OR spaces OR uppercase THEN regexp_replace(replace(lower(name), ' ', '_'), '[^a-z0-9._-]', '', 'g') END suggested FROM m), k AS (SELECT *, count(*) OVER (PARTITION BY coalesce(suggested, name)) > 1 collides FROM s)"


def names(spark, sf_dir) -> DataFrame:
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    few = (k % 50).cast("string")
    name = F.when(k % 4 == 0, F.concat("c_name", F.lit(".png"))).when(k % 4 == 1, F.concat(F.lower(seg), F.lit(" é"), few, F.lit(".jpg"))).when(k % 4 == 2, F.concat(F.lit("page_"), k.cast("string"), F.lit(".jpg"))).otherwise(F.concat(F.upper(seg), F.lit(" "), few, F.lit(".JPG")))
    return Q.file_names(read(spark, sf_dir, "customer").select("c_custkey", name.alias("name")), "name")


@query(NAMES + " SELECT c_custkey, name, non_ascii, spaces, uppercase, suggested, collides FROM k")
def q_filename_hygiene(spark, sf_dir):
    return names(spark, sf_dir)


@query(NAMES + ", p AS (SELECT name AS old, suggested AS new FROM k WHERE suggested IS NOT NULL AND NOT collides), l AS (SELECT regexp_replace(name, '\\.[^.]*$', '') || '.txt' AS label FROM n WHERE c_custkey % 3 = 0) SELECT 'image' kind, old, new FROM p UNION ALL SELECT 'label', label, regexp_replace(new, '\\.[^.]*$', '') || '.txt' FROM p JOIN l ON regexp_replace(label, '\\.[^.]*$', '') = regexp_replace(old, '\\.[^.]*$', '')")
def q_rename_plan(spark, sf_dir):
    """Images to rename, and the labels that go with them."""
    n = names(spark, sf_dir)
    some = n.where("c_custkey % 3 = 0").select(F.concat(F.regexp_replace("name", r"\.[^.]*$", ""), F.lit(".txt")).alias("label"))
    return Q.rename_plan(n, "name", some, "label")


@query("SELECT CASE WHEN contains(t, 'image') THEN 'Image fixes' WHEN contains(t, 'label') THEN 'Label fixes' WHEN contains(t, 'rename') THEN 'Filename fixes' ELSE 'Image fixes' END \"group\", count(*) n FROM (SELECT lower(CASE event_id % 4 WHEN 0 THEN 'Fixed image: ' WHEN 1 THEN 'Fixed Label: ' WHEN 2 THEN 'Renamed: ' ELSE 'Other: ' END || event_type) t FROM events) GROUP BY 1")
def q_changelog(spark, sf_dir):
    what = F.element_at(F.array(*(F.lit(x) for x in ("Fixed image: ", "Fixed Label: ", "Renamed: ", "Other: "))), (F.col("event_id") % 4 + 1).cast("int"))
    return Q.changelog(read(spark, sf_dir, "events").select(F.concat(what, "event_type").alias("t")), F.col("t")).select("group", "n")


#: Texts in both directions, a page's share of Arabic words following its number.
PAGES = """WITH t AS (SELECT doc_id % 40 page, CASE WHEN doc_id % 40 < 8 THEN repeat('سلام עולם ', CAST(doc_id % 40 AS INT) * 300) || text ELSE text END text FROM documents)"""
RTL_COUNT = f"(length(text) - length(regexp_replace(text, '{X.RTL}', '', 'g')))"


def page_texts(spark, sf_dir) -> DataFrame:
    page = F.col("doc_id") % 40
    text = F.when(page < 8, F.concat(F.repeat(F.lit("سلام עולם "), (page * 300).cast("int")), F.col("text"))).otherwise(F.col("text"))
    return read(spark, sf_dir, "documents").select(page.alias("page"), text.alias("text"))


@query(PAGES + f", g AS (SELECT page, sum({RTL_COUNT})::BIGINT rtl_chars, sum(length(text))::BIGINT total_chars FROM t GROUP BY page), r AS (SELECT *, CASE WHEN total_chars > 0 THEN rtl_chars / total_chars ELSE 0.0 END rtl_ratio FROM g) SELECT page, rtl_chars, total_chars, round(rtl_ratio, 9) rtl_ratio, rtl_ratio > 0.6 is_rtl, rtl_ratio > 0.3 AND rtl_ratio < 0.7 is_mixed, round(CASE WHEN total_chars = 0 THEN 0.0 ELSE greatest(rtl_ratio, 1 - rtl_ratio) END, 9) confidence FROM r")
def q_page_direction(spark, sf_dir):
    """The first eight pages hold right-to-left words."""
    return rounded(Q.page_directions(page_texts(spark, sf_dir), "page", "text"), "rtl_ratio", "confidence")


#: Line directions of pages, in degrees: one in eleven pages leans, and a few lines stand upright.
ANGLES = "WITH a AS (SELECT l_orderkey page, CASE WHEN l_suppkey % 9 = 0 THEN 92.5 + l_linenumber ELSE CASE WHEN l_orderkey % 11 = 0 THEN 7 ELSE 0 END + (l_partkey % 21 - 10) / 10 END::DOUBLE angle FROM lineitem), w AS (SELECT page, CASE WHEN angle > 90 THEN angle - 180 ELSE angle END a FROM a), p AS (SELECT page, count(*) n_lines, median(a) angle, stddev_pop(a) angle_std FROM w GROUP BY page)"


def angles(spark, sf_dir) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    lean = F.when(F.col("l_orderkey") % 11 == 0, 7).otherwise(0) + (F.col("l_partkey") % 21 - 10) / 10
    return li.select(F.col("l_orderkey").alias("page"), F.when(F.col("l_suppkey") % 9 == 0, 92.5 + F.col("l_linenumber")).otherwise(lean).cast("double").alias("angle"))


@query(ANGLES + " SELECT page, n_lines, round(angle, 6) angle, round(angle_std, 6) angle_std, round(greatest(0.0, 1 - angle_std / 45), 6) confidence, abs(angle) > 1.5 skewed FROM p")
def q_page_angles(spark, sf_dir):
    return rounded(Q.page_angles(angles(spark, sf_dir), "page", "angle"), "angle", "angle_std", "confidence", places=6)


SEGMENTS = "WITH s AS (SELECT l_orderkey page, l_partkey % 50 x1, l_suppkey % 50 y1, l_partkey % 50 + 100 - CASE WHEN l_linenumber % 3 = 0 THEN 95 ELSE 0 END x2, l_suppkey % 50 + l_linenumber * 3 + CASE WHEN l_linenumber % 3 = 0 THEN 80 ELSE 0 END y2 FROM lineitem), a AS (SELECT page, degrees(atan2(y2 - y1, x2 - x1)) a FROM s)"


def segments(spark, sf_dir) -> DataFrame:
    x, y, n = F.col("l_partkey") % 50, F.col("l_suppkey") % 50, F.col("l_linenumber")
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), x.alias("x1"), y.alias("y1"), (x + 100 - F.when(n % 3 == 0, 95).otherwise(0)).alias("x2"), (y + n * 3 + F.when(n % 3 == 0, 80).otherwise(0)).alias("y2"))


@query(SEGMENTS + ", m AS (SELECT page, coalesce(median(CASE WHEN a > -45 AND a < 45 THEN a END), 0.0) angle FROM a GROUP BY page) SELECT page, round(angle, 6) angle, abs(angle) > 0.2 rotate FROM m")
def q_deskew(spark, sf_dir):
    return rounded(Q.deskew_angle(segments(spark, sf_dir), "page"), "angle", places=6)


@query(SEGMENTS + ", c AS (SELECT page, count_if(abs(a) < 15) horizontal, count_if(abs(a) >= 15 AND (abs(a - 90) < 15 OR abs(a + 90) < 15)) vertical FROM a GROUP BY page), r AS (SELECT *, CASE WHEN horizontal + vertical > 0 THEN vertical / (horizontal + vertical) ELSE 0.0 END vertical_ratio FROM c) SELECT page, horizontal, vertical, round(vertical_ratio, 9) vertical_ratio, vertical_ratio > 0.3 is_rtl FROM r")
def q_upright_lines(spark, sf_dir):
    return rounded(Q.upright_lines(segments(spark, sf_dir), "page"), "vertical_ratio")


@query(ANGLES + f""", t AS (SELECT doc_id page, CASE WHEN doc_id % 9 = 0 THEN repeat('سلام ', len(text)) || text ELSE text END text FROM documents), d AS (SELECT page, CASE WHEN length(text) > 0 THEN {RTL_COUNT} / length(text) ELSE 0 END > 0.6 is_rtl FROM t),
s AS (SELECT count(*) pages, 100.0 * count_if(is_rtl) / count(is_rtl) rtl_percentage, 100.0 * count_if(abs(angle) > 1.5) / count(*) skewed_percentage, avg(angle) mean_angle FROM d LEFT JOIN p USING (page))
SELECT pages, round(rtl_percentage, 6) rtl_percentage, round(skewed_percentage, 6) skewed_percentage, round(mean_angle, 6) mean_angle, rtl_percentage > 20 OR skewed_percentage > 10 needs_preprocessing, CASE WHEN skewed_percentage > 0 THEN 1 ELSE 0 END + CASE WHEN skewed_percentage > 0 AND abs(mean_angle) > 5 THEN 1 ELSE 0 END + CASE WHEN rtl_percentage > 5 THEN 1 ELSE 0 END + CASE WHEN skewed_percentage = 0 AND rtl_percentage <= 5 THEN 1 ELSE 0 END n_recommendations FROM s""")
def q_skew_summary(spark, sf_dir):
    """Documents as pages; one in nine is Arabic."""
    text = F.when(F.col("doc_id") % 9 == 0, F.concat(F.repeat(F.lit("سلام "), F.length("text")), F.col("text"))).otherwise(F.col("text"))
    directions = Q.page_directions(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), text.alias("text")), "page", "text")
    s = Q.skew_summary(directions.join(Q.page_angles(angles(spark, sf_dir), "page", "angle"), "page", "left"))
    return rounded(s.select("pages", "rtl_percentage", "skewed_percentage", "mean_angle", "needs_preprocessing", F.size("recommendations").alias("n_recommendations")), "rtl_percentage", "skewed_percentage", "mean_angle", places=6)


@query("SELECT * EXCLUDE r FROM (SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source ORDER BY doc_id) r FROM documents) WHERE r <= 10")
def q_first_examples(spark, sf_dir):
    return Q.first_of_each(read(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "source", ["doc_id"], 10)


@query(BOXES + "SELECT class_id, count(*) n, sum(greatest(0, least(x, 999))) x, sum(greatest(0, least(w, 1000 - greatest(0, least(x, 999))))) w, count_if(greatest(0, least(w, 1000 - greatest(0, least(x, 999)))) <= 1 OR greatest(0, least(h, 900 - greatest(0, least(y, 899)))) <= 1) dropped FROM pred GROUP BY class_id")
def q_ingest_clamp(spark, sf_dir):
    """The ingest's clamp, whose sizes may reach 0; and how many boxes it drops."""
    from foliant.plans.catalogue import PAGE_H, PAGE_W, box, predictions

    x, _, w, h = G.clamp_origin(box(), PAGE_W, PAGE_H, 0)
    return predictions(spark, sf_dir).groupBy("class_id").agg(F.count("*").alias("n"), F.sum(x).alias("x"), F.sum(w).alias("w"), F.count_if((w <= 1) | (h <= 1)).alias("dropped"))
