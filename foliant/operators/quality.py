"""Dataset gate: audits of labels, images and file names, their repairs, and what follows from them.

Labels are rows (file, line_no, class_id, x, y, w, h) in fractions, annotations rows (ann_id, category_id, x, y, w, h)
in pixels, images rows (path, width, height, exif_bytes). A finding is a row (entity, line_no, issue, detail).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import text as X

#: Classes in the order of their ids.
CLASSES = ("Text", "Title", "List", "Table", "Figure")
#: Limits of image sanity, and the largest coordinate a repaired annotation may reach.
LEAST_SIDE, MOST_ASPECT, MOST_EXIF, PLAN_ASPECT, MOST_COORDINATE = 400, 10, 10_000, 5, 10_000
#: Percentages over which a dataset needs attention.
MOST_RTL, MOST_SKEWED = 20, 10


def box() -> G.Box:
    return tuple(F.col(c) for c in "xywh")


def shown(*columns: Column) -> Column:
    return F.concat_ws(",", *(c.cast("string") for c in columns))


def findings(rows: DataFrame, entity: str, line: str | None, issues: dict[str, Column], detail: Column) -> DataFrame:
    """(entity, line_no, issue, detail) of every issue that holds, in one pass."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in issues.items())))
    return rows.select(F.col(entity).cast("string").alias("entity"), (F.col(line) if line else F.lit(None)).cast("int").alias("line_no"), F.explode(found).alias("issue"), detail.alias("detail"))


def label_issues(labels: DataFrame, n_classes: int = len(CLASSES), files: DataFrame | None = None, strict_center: bool = False) -> DataFrame:
    """Findings of label lines: unknown_class, invalid_coords, out_of_bounds; and empty_labels for those of `files`
    (one column, file) that have no line. A box is out of bounds where x + w or y + h passes 1; with strict_center,
    where half its size on either side of its centre does."""
    x, y, w, h = box()
    out = (x - w / 2 < 0) | (x + w / 2 > 1) | (y - h / 2 < 0) | (y + h / 2 > 1) if strict_center else (x + w > 1.0) | (y + h > 1.0)
    issues = {"unknown_class": (F.col("class_id") < 0) | (F.col("class_id") >= n_classes), "invalid_coords": (x < 0) | (y < 0) | (w <= 0) | (h <= 0), "out_of_bounds": out}
    got = findings(labels, "file", "line_no", issues, shown(F.col("class_id"), *box()))
    if files is None:
        return got
    empty = files.select("file").distinct().join(labels.select("file"), "file", "left_anti")
    return got.unionByName(empty.select(F.col("file").cast("string").alias("entity"), F.lit(None).cast("int").alias("line_no"), F.lit("empty_labels").alias("issue"), F.lit("").alias("detail")))


def valid_line(n_classes: int = len(CLASSES)) -> Column:
    """A known class, a box of some size within the page."""
    x, y, w, h = box()
    return (F.col("class_id") >= 0) & (F.col("class_id") < n_classes) & (x >= 0) & (x <= 1) & (y >= 0) & (y <= 1) & (w > 0) & (w <= 1) & (h > 0) & (h <= 1) & (x + w <= 1) & (y + h <= 1)


def validate_files(labels: DataFrame, n_classes: int = len(CLASSES)) -> DataFrame:
    """(file, n_lines, n_valid, valid): a file is valid if any of its lines is."""
    g = labels.groupBy("file").agg(F.count("*").alias("n_lines"), F.count_if(valid_line(n_classes)).alias("n_valid"))
    return g.withColumn("valid", F.col("n_valid") > 0)


def fix_labels(labels: DataFrame, n_classes: int = len(CLASSES)) -> DataFrame:
    """Labels as the audit mends them in place: unknown classes go; x and y are raised to 0, w and h to .001; then x and
    y are moved down so that x + w and y + h reach 1."""
    x, y, w, h = box()
    bad = (x < 0) | (y < 0) | (w <= 0) | (h <= 0)
    clamped = [F.when(bad, F.greatest(F.lit(low), c)).otherwise(c) for c, low in ((x, 0.0), (y, 0.0), (w, 0.001), (h, 0.001))]
    kept = labels.where((F.col("class_id") >= 0) & (F.col("class_id") < n_classes)).withColumns(dict(zip("xywh", clamped, strict=True)))
    over = (x + w > 1.0) | (y + h > 1.0)
    return kept.withColumns({"x": F.when(over, F.least(x, 1.0 - w)).otherwise(x), "y": F.when(over, F.least(y, 1.0 - h)).otherwise(y)})


def repair_labels(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired lines, files to quarantine): lines by G.repair_yolo that keep a size over .001; files without one."""
    fixed = labels.withColumns(dict(zip("xywh", G.repair_yolo(box()), strict=True))).where("w > 0.001 and h > 0.001")
    return fixed, labels.select("file").distinct().join(fixed.select("file"), "file", "left_anti")


def annotation_issues(annotations: DataFrame, categories: DataFrame, classes: DataFrame) -> DataFrame:
    """Findings of a COCO set: invalid_coords and missing_category of annotations, and unknown_class for each of classes
    (one column, class) that is no category's name."""
    x, y, w, h = box()
    got = findings(annotations, "ann_id", None, {"invalid_coords": (x < 0) | (y < 0) | (w <= 0) | (h <= 0), "missing_category": F.col("category_id").isNull()}, shown(*box()))
    absent = classes.select(F.col("class").alias("name")).distinct().join(categories.select("name"), "name", "left_anti")
    return got.unionByName(absent.select(F.col("name").alias("entity"), F.lit(None).cast("int").alias("line_no"), F.lit("unknown_class").alias("issue"), F.lit("Not in categories").alias("detail")))


def fix_annotations(annotations: DataFrame) -> DataFrame:
    """Annotations as the audit mends them: x and y raised to 0, w and h to 1, where one is invalid."""
    x, y, w, h = box()
    bad = (x < 0) | (y < 0) | (w <= 0) | (h <= 0)
    return annotations.withColumns({c: F.when(bad, F.greatest(F.lit(low), F.col(c))).otherwise(F.col(c)) for c, low in (("x", 0), ("y", 0), ("w", 1), ("h", 1))})


def repair_annotations(annotations: DataFrame, most: int = MOST_COORDINATE) -> DataFrame:
    """x and y from 0, w and h from 1, no further than `most`; what has no size then goes."""
    x, y = F.greatest(F.lit(0), F.col("x")), F.greatest(F.lit(0), F.col("y"))
    w, h = F.greatest(F.lit(1), F.col("w")), F.greatest(F.lit(1), F.col("h"))
    return annotations.withColumns({"x": x, "y": y, "w": F.when(x + w > most, most - x).otherwise(w), "h": F.when(y + h > most, most - y).otherwise(h)}).where("w > 0 and h > 0")


def image_issues(images: DataFrame) -> DataFrame:
    """Findings of images: unreadable (no size), tiny_dims, extreme_aspect_ratio, corrupt_exif."""
    w, h = F.col("width"), F.col("height")
    issues = {
        "unreadable": w.isNull() | h.isNull(), "tiny_dims": F.least(w, h) < LEAST_SIDE, "extreme_aspect_ratio": F.greatest(w, h) > MOST_ASPECT * F.least(w, h), "corrupt_exif": F.col("exif_bytes") > MOST_EXIF,
    }
    return findings(images, "path", None, issues, shown(w, h))


def image_plan(width: Column, height: Column) -> tuple[Column, Column]:
    """Size that a repaired image gets: the long side at most five times the short one where it is over ten times; but
    where a side is below 400, the original size scaled until it isn't."""
    short, long = F.least(width, height), F.greatest(width, height)
    capped = long > MOST_ASPECT * short
    w = F.when(capped & (width > height), F.least(width, height * PLAN_ASPECT)).otherwise(width)
    h = F.when(capped & (width <= height), F.least(height, width * PLAN_ASPECT)).otherwise(height)
    scaled = lambda side: F.floor(side * (F.lit(float(LEAST_SIDE)) / short)).cast("int")
    return F.when(short < LEAST_SIDE, scaled(width)).otherwise(w), F.when(short < LEAST_SIDE, scaled(height)).otherwise(h)


def clean_name(name: Column) -> Column:
    """Lower case, blanks as underscores, nothing but ASCII letters and digits, dots, underscores and hyphens."""
    return F.regexp_replace(F.replace(F.lower(name), F.lit(" "), F.lit("_")), "[^a-z0-9._-]", "")


def file_names(files: DataFrame, name: str) -> DataFrame:
    """Every column of files, with non_ascii, spaces, uppercase, suggested (null where none of them holds) and collides:
    whether another file would have the same name."""
    n = F.col(name)
    marks = {"non_ascii": n.rlike(r"[^\x00-\x7F]"), "spaces": F.contains(n, F.lit(" ")), "uppercase": n != F.lower(n)}
    rows = files.withColumns(marks)
    rows = rows.withColumn("suggested", F.when(F.col("non_ascii") | F.col("spaces") | F.col("uppercase"), clean_name(n))).withColumn("__to", F.coalesce("suggested", n))
    taken = rows.groupBy("__to").agg((F.count("*") > 1).alias("collides"))
    return rows.join(taken, "__to", "left").drop("__to")


def rename_plan(named: DataFrame, name: str, labels: DataFrame, label: str) -> DataFrame:
    """(kind, old, new) of the images to rename and of the label files with the same stem; a name that would collide
    stays as it is."""
    stem = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    plan = named.where("suggested is not null and not collides").select(F.col(name).alias("old"), F.col("suggested").alias("new"))
    with_stems = plan.select(stem(F.col("old")).alias("__stem"), stem(F.col("new")).alias("__new"))
    renamed = labels.select(F.col(label).alias("old"), stem(F.col(label)).alias("__stem")).join(with_stems, "__stem").select(F.lit("label").alias("kind"), "old", F.concat("__new", F.regexp_extract("old", r"(\.[^.]*)?$", 0)).alias("new"))
    return plan.select(F.lit("image").alias("kind"), "old", "new").unionByName(renamed)


def triage(files: DataFrame, path: str, problems: DataFrame, repaired: DataFrame) -> DataFrame:
    """Every file once, with action: copy (no problem), fix (among the repaired) or quarantine. Problems and repaired
    hold paths in a column `entity`, repeated or not."""
    bad, good = problems.select(F.col("entity").alias(path)).distinct(), repaired.select(F.col("entity").alias(path)).distinct()
    marked = files.select(path).distinct().join(bad.withColumn("__bad", F.lit(True)), path, "left").join(good.withColumn("__good", F.lit(True)), path, "left")
    return marked.select(path, F.when(F.col("__bad").isNull(), "copy").when(F.col("__good"), "fix").otherwise("quarantine").alias("action"))


def changelog(fixes: DataFrame, text: str) -> DataFrame:
    """(group, n, fixes): what was done, by what it speaks of; the first of image, label and rename decides, and
    anything else is an image fix."""
    low = F.lower(text)
    group = F.when(F.contains(low, F.lit("image")), "Image fixes").when(F.contains(low, F.lit("label")), "Label fixes").when(F.contains(low, F.lit("rename")), "Filename fixes").otherwise("Image fixes")
    return fixes.groupBy(group.alias("group")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(text)).alias("fixes"))


def issue_counts(*parts: DataFrame) -> DataFrame:
    """(issue, n, entities) over the union of findings."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("issue").agg(F.count("*").alias("n"), F.count_distinct("entity").alias("entities"))


def status(critical: Column, rtl: Column, skewed: Column, licensed: Column) -> Column:
    """READY, or NEEDS ATTENTION with any critical issue, more right-to-left or skewed pages than allowed, or no licence."""
    return F.when((critical > 0) | (rtl > MOST_RTL) | (skewed > MOST_SKEWED) | ~licensed, "NEEDS ATTENTION").otherwise("READY")


def scan_pii(rows: DataFrame, id_col: str, text_col: str, types: tuple[str, ...] = tuple(X.PII), width: int = 50, swift_any_case: bool = False) -> DataFrame:
    """(id, type, original, redacted, context) of every hit of the wanted types in a text column, or in one of file
    names. The context is cut before hits part into rows, so that no row carries a text."""
    t = F.col(text_col)
    hit = F.transform(X.pii_hits(t, types, swift_any_case), lambda h: F.struct(h["type"].alias("type"), h["original"].alias("original"), X.redact(h["original"], h["type"]).alias("redacted"), X.context(t, h["original"], width).alias("context")))
    return rows.select(id_col, F.explode(hit).alias("h")).select(id_col, "h.*")


def pii_totals(hits: DataFrame, id_col: str, scanned: DataFrame) -> DataFrame:
    """One row: findings, entities with any, entities scanned."""
    got = hits.agg(F.count("*").alias("findings"), F.count_distinct(id_col).alias("with_pii"))
    return got.crossJoin(scanned.agg(F.count_distinct(id_col).alias("scanned")))  # one row each


def folder_licenses(files: DataFrame, folder: str, text: str) -> DataFrame:
    """(folder, files, license types, has_attribution, multiple, warnings, recommendations) of licence files; a folder
    whose rows have a null text has no licence file."""
    terms = X.license_terms(F.col(text))
    each = files.select(folder, F.col(text).isNotNull().alias("__is"), terms["license_type"].alias("__type"), terms["requires_attribution"].alias("__credit"))
    g = each.groupBy(folder).agg(
        F.count_if("__is").alias("license_files"), F.sort_array(F.collect_set(F.when(F.col("__is"), F.col("__type")))).alias("license_types"), F.coalesce(F.bool_or(F.col("__is") & F.col("__credit")), F.lit(False)).alias("has_attribution")
    )
    none, unclear, several = F.col("license_files") == 0, (F.col("license_files") > 0) & ~F.col("has_attribution"), F.size("license_types") > 1
    pick = lambda *pairs: F.array_compact(F.array(*(F.when(cond, what if isinstance(what, Column) else F.lit(what)) for cond, what in pairs)))
    warnings = pick((none, "No license files found in dataset"), (unclear, "License files found but attribution requirements unclear"), (several, F.concat(F.lit("Multiple license types found: "), F.array_join("license_types", ", "))))
    advice = pick(
        (none, "Add a LICENSE file to the dataset root"), (none, "Consider using a standard open-source license (MIT, Apache 2.0, etc.)"), (unclear, "Clarify attribution requirements in license files"), (several, "Consider standardizing on a single license type"),
    )
    return g.select("*", several.alias("multiple"), warnings.alias("warnings"), advice.alias("recommendations"))


def page_directions(rows: DataFrame, page: str, text: str) -> DataFrame:
    """(page, rtl_chars, total_chars, rtl_ratio, is_rtl, is_mixed, confidence) over all the texts of a page."""
    g = rows.groupBy(page).agg(F.sum(X.rtl_chars(F.col(text))).alias("rtl_chars"), F.sum(F.length(X.blank(F.col(text)))).alias("total_chars"))
    ratio, rtl, mixed, sure = X.direction_of(F.col("rtl_chars"), F.col("total_chars"))
    return g.select("*", ratio.alias("rtl_ratio"), rtl.alias("is_rtl"), mixed.alias("is_mixed"), sure.alias("confidence"))


def wrapped_angle(degrees: Column) -> Column:
    """Line directions over 90 degrees count from the other side."""
    return F.when(degrees > 90, degrees - 180).otherwise(degrees)


def line_angle(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.degrees(F.atan2(y2 - y1, x2 - x1))


def page_angles(lines: DataFrame, page: str, angle: str, threshold: float = 1.5) -> DataFrame:
    """(page, n_lines, angle, angle_std, confidence, skewed): the median of a page's wrapped line angles, their
    population deviation, 1 - deviation / 45 from 0, and whether the median is steeper than the threshold."""
    a = wrapped_angle(F.col(angle))
    g = lines.where(F.col(angle).isNotNull()).groupBy(page).agg(F.count("*").alias("n_lines"), F.median(a).alias("angle"), F.stddev_pop(a).alias("angle_std"))
    return g.withColumn("confidence", F.greatest(F.lit(0.0), 1 - F.col("angle_std") / 45)).withColumn("skewed", F.abs("angle") > threshold)


def deskew_angle(lines: DataFrame, page: str, least: float = 0.2) -> DataFrame:
    """(page, angle, rotate): the median angle of the lines within 45 degrees of level (0 without any), and whether a
    page is turned: more than `least` degrees. Lines have x1, y1, x2, y2."""
    a = line_angle(*(F.col(c) for c in ("x1", "y1", "x2", "y2")))
    g = lines.groupBy(page).agg(F.coalesce(F.median(F.when((a > -45) & (a < 45), a)), F.lit(0.0)).alias("angle"))
    return g.withColumn("rotate", F.abs("angle") > least)


def upright_lines(lines: DataFrame, page: str) -> DataFrame:
    """(page, horizontal, vertical, vertical_ratio, is_rtl): lines within 15 degrees of level or plumb; a page with over
    .3 plumb ones is taken for right-to-left."""
    a = line_angle(*(F.col(c) for c in ("x1", "y1", "x2", "y2")))
    level, plumb = F.abs(a) < 15, (F.abs(a - 90) < 15) | (F.abs(a + 90) < 15)
    g = lines.groupBy(page).agg(F.count_if(level).alias("horizontal"), F.count_if(plumb & ~level).alias("vertical"))
    ratio = F.coalesce(F.try_divide(F.col("vertical").cast("double"), F.col("horizontal") + F.col("vertical")), F.lit(0.0))
    return g.withColumn("vertical_ratio", ratio).withColumn("is_rtl", F.col("vertical_ratio") > 0.3)


#: What reports advise.
SKEW_ADVICE = {
    "many skewed": "High percentage of skewed pages detected. Consider implementing automatic deskewing.",
    "some skewed": "Moderate percentage of skewed pages detected. Manual review recommended.",
    "few skewed": "Low percentage of skewed pages detected. Current preprocessing may be sufficient.",
    "rotation": "Average rotation angle: %.1f°. Consider applying global rotation correction.",
    "many rtl": "High percentage of RTL pages detected. Consider RTL-specific preprocessing.",
    "some rtl": "Some RTL pages detected. Mixed script handling may be needed.",
    "none": "No significant rotation or RTL issues detected.",
}


def skew_summary(pages: DataFrame) -> DataFrame:
    """One row over pages (is_rtl, skewed, angle; a page without lines has null angle and skewed): percentages, mean
    angle, whether preprocessing is needed, and recommendations."""
    percent = lambda c, of: F.coalesce(F.try_divide(100.0 * c, of), F.lit(0.0))
    g = pages.agg(F.count("*").alias("pages"), F.count_if(F.coalesce(F.col("is_rtl"), F.lit(False))).alias("__rtl"), F.count("is_rtl").alias("__known"), F.count_if(F.coalesce(F.col("skewed"), F.lit(False))).alias("__skewed"), F.avg("angle").alias("mean_angle"))
    g = g.select("pages", percent(F.col("__rtl"), F.col("__known")).alias("rtl_percentage"), percent(F.col("__skewed"), F.col("pages")).alias("skewed_percentage"), "mean_angle")
    s, r, a = F.col("skewed_percentage"), F.col("rtl_percentage"), F.col("mean_angle")
    advice = F.array_compact(F.array(
        F.when(s > 20, SKEW_ADVICE["many skewed"]).when(s > 10, SKEW_ADVICE["some skewed"]).when(s > 0, SKEW_ADVICE["few skewed"]),
        F.when((s > 0) & (F.abs(a) > 5), F.format_string(SKEW_ADVICE["rotation"], a)),
        F.when(r > 20, SKEW_ADVICE["many rtl"]).when(r > 5, SKEW_ADVICE["some rtl"]),
    ))
    advice = F.when(F.size(advice) == 0, F.array(F.lit(SKEW_ADVICE["none"]))).otherwise(advice)
    return g.select("*", ((r > MOST_RTL) | (s > MOST_SKEWED)).alias("needs_preprocessing"), advice.alias("recommendations"))


def first_of_each(rows: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first n rows of each group, as examples."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("__r") <= n).drop("__r")
