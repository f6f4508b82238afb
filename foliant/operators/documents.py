"""Element documents: reading order, OCR lines, descriptions, JSON, merging.

Elements are rows (document_id, page, class, x, y, w, h, content, language, meta, elem_pos); elem_pos is the order in
which they came and breaks every tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators.quality import CLASSES

#: Classes with text of their own, and those that are described.
TEXTUAL, DESCRIBED = ("Text", "Title", "List"), ("Table", "Figure")
#: Least length and confidence of a language.
LEAST_CHARS, LEAST_CONFIDENCE = 3, 0.55
BOX = ("x", "y", "w", "h")


def textual(kind: Column) -> Column:
    return kind.isin(*TEXTUAL)


def class_name(class_id: Column) -> Column:
    """Name of a detector's class; Text for those it doesn't know."""
    return F.coalesce(F.try_element_at(F.array(*(F.lit(c) for c in CLASSES)), F.when(class_id >= 0, class_id + 1)), F.lit("Text"))


def class_id(name: Column, classes: tuple[str, ...] = CLASSES) -> Column:
    """Place of a name in a list of classes, from 0; null if it isn't there."""
    at = F.array_position(F.array(*(F.lit(c) for c in classes)), name)
    return F.when(at > 0, at - 1).cast("int")


def corners_to_box(x1: Column, y1: Column, x2: Column, y2: Column) -> tuple[Column, Column, Column, Column]:
    """Whole numbers; fractions are cut off towards zero, after the subtraction."""
    return x1.cast("int"), y1.cast("int"), (x2 - x1).cast("int"), (y2 - y1).cast("int")


def in_page_range(page: Column, start: int, stop: int | None = None) -> Column:
    """From start up to, not including, stop; pages count from 0."""
    return (page >= start) & (F.lit(True) if stop is None else page < stop)


def gated_language(text: Column, language: Column, confidence: Column) -> Column:
    """Null for texts of fewer than three characters, "unknown" below the least confidence."""
    return F.when(F.length(X.strip(X.blank(text))) < LEAST_CHARS, None).when(confidence < LEAST_CONFIDENCE, "unknown").otherwise(language)


def without_prefix(text: Column, prefix: str) -> Column:
    """text, trimmed, without a leading prefix, such as a label's mark or an echoed prompt; trimmed again."""
    t = X.strip(text)
    return F.when(t.startswith(prefix), X.strip(F.substring(t, F.lit(len(prefix) + 1), F.length(t)))).otherwise(t)


def lines_to_elements(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, content, confidence, text_lines): the lines of a box, blank ones left out, joined by a blank in the order
    of line_no, and their mean confidence; null content and confidence 0 where none is left."""
    t = X.strip(F.col("text"))
    kept = F.when(X.blank(t) != "", F.struct("line_no", t.alias("t"), "confidence"))
    g = lines.groupBy(*keys).agg(F.array_sort(F.collect_list(kept)).alias("l"))
    joined = F.array_join(F.transform("l", lambda e: e["t"]), " ")
    mean = F.try_divide(F.aggregate("l", F.lit(0.0), lambda s, e: s + e["confidence"]), F.size("l"))
    return g.select(*keys, F.nullif(joined, F.lit("")).alias("content"), F.coalesce(mean, F.lit(0.0)).alias("confidence"), F.size("l").cast("long").alias("text_lines"))


def reading_order(rows: DataFrame, group: str, keys: list[str], value: str) -> DataFrame:
    """(group, reading): a group's values, as text, in the order of keys (page, y, x, then what came first)."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(*keys, F.col(value).alias("__v")))), lambda e: e["__v"].cast("string"))
    return rows.groupBy(group).agg(F.array_join(ordered, ",").alias("reading"))


def text_of_json(value: Column) -> Column:
    """A value as JSON text."""
    whole = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def element_json(meta: bool = True) -> Column:
    """An element as JSON: class, bbox, content, language and page, nulls shown; meta only where it has an entry."""
    body = F.to_json(F.struct("class", F.array(*BOX).alias("bbox"), "content", "language", "page"), {"ignoreNullFields": "false"})
    if not meta:
        return body
    return F.when(F.size("meta") > 0, F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(',"meta":'), F.to_json("meta"), F.lit("}"))).otherwise(body)


def to_documents(elements: DataFrame, missing: str = "merged_document") -> DataFrame:
    """(document_id, payload, n): one JSON text a document, its elements in reading order. A null id is `missing`."""
    rows = elements.select(F.coalesce("document_id", F.lit(missing)).alias("document_id"), "page", "y", "x", "elem_pos", element_json("meta" in elements.columns).alias("__j"))
    g = rows.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("page", "y", "x", "elem_pos", "__j"))).alias("e"))
    joined = F.array_join(F.transform("e", lambda e: e["__j"]), ",")
    return g.select("document_id", F.concat(F.lit('{"document_id":'), text_of_json(F.col("document_id")), F.lit(',"elements":['), joined, F.lit("]}")).alias("payload"), F.size("e").cast("long").alias("n"))


def merge_parts(parts: DataFrame, part: str = "part_no") -> DataFrame:
    """Elements of several partial documents as one: every row gets the id of the first part that names one, and
    elem_pos counts on from part to part."""
    first = parts.agg(F.min_by("document_id", F.when(F.col("document_id").isNotNull(), F.col(part))).alias("__id"))
    return parts.crossJoin(F.broadcast(first)).select(*(F.coalesce("__id", F.lit("merged_document")).alias("document_id") if c == "document_id" else F.struct(part, "elem_pos").alias("elem_pos") if c == "elem_pos" else F.col(c) for c in parts.columns))


def to_describe(elements: DataFrame) -> DataFrame:
    """Tables and figures without content."""
    return elements.where(F.col("class").isin(*DESCRIBED) & F.col("content").isNull())


def merge_descriptions(elements: DataFrame, described: DataFrame) -> DataFrame:
    """Elements, in which a table or figure without content takes that of the first described row (by elem_pos) of its
    document, page, box and class, and the source vlm_description in meta; without one it stays as it is."""
    keys = ["document_id", "page", "class", *BOX]
    first = described.groupBy(*keys).agg(F.min_by(F.struct(F.col("content").alias("c")), "elem_pos").alias("__new"))
    rows = elements.join(first, keys, "left")
    take = F.col("__new").isNotNull() & F.col("class").isin(*DESCRIBED) & F.col("content").isNull()
    source = F.map_from_arrays(F.array(F.lit("source")), F.array(F.lit("vlm_description")))
    out = rows.withColumn("__take", take).withColumn("content", F.when(F.col("__take"), F.col("__new.c")).otherwise(F.col("content")))
    if "meta" in elements.columns:
        kept = F.map_filter(F.coalesce("meta", F.create_map().cast("map<string,string>")), lambda k, _: k != "source")
        out = out.withColumn("meta", F.when(F.col("__take"), F.map_concat(kept, source)).otherwise(F.col("meta")))
    return out.select(*elements.columns)


def merge_stages(pages: DataFrame, results: DataFrame, key: str, value: str) -> DataFrame:
    """pages with the value of their successful result; null where there is none. Results have key, success and value;
    of several successes of a page the least value counts."""
    good = results.where("success").groupBy(key).agg(F.min(value).alias(value))
    return pages.join(good, key, "left")


def crop(box: tuple[Column, ...], width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """The part of a box that can be cut from an image: whole numbers, corner moved into it, size to its border; a part
    of no size is null."""
    x, y, w, h = (c.cast("int") for c in box)
    x, y = F.greatest(F.lit(0), F.least(x, width - 1)), F.greatest(F.lit(0), F.least(y, height - 1))
    w, h = F.least(w, width - x), F.least(h, height - y)
    some = (w > 0) & (h > 0)
    return tuple(F.when(some, c) for c in (x, y, w, h))


def fitted(width: Column, height: Column, most: int = 1024) -> tuple[Column, Column]:
    """Size with the longer side at `most` and the same shape, fractions cut off; smaller images keep theirs."""
    big = F.greatest(width, height) > most
    w = F.when(width > height, F.lit(most)).otherwise(F.floor(width * most / height).cast("int"))
    h = F.when(width > height, F.floor(height * most / width).cast("int")).otherwise(F.lit(most))
    return F.when(big, w).otherwise(width), F.when(big, h).otherwise(height)


def batches(rows: DataFrame, group: str, order: list[str], size: int) -> DataFrame:
    """rows with batch, from 0: the rows of a group in their order, `size` at a time."""
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("long"))


def chunked(elements: DataFrame, keys: list[str], size: int = 220, overlap: int = 30) -> DataFrame:
    """(keys, chunk_no, chunk) of elements with content."""
    return elements.where("content is not null").select(*keys, F.posexplode(X.chunks(F.col("content"), size, overlap)).alias("chunk_no", "chunk"))
