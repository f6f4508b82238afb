"""Queries of element documents: classes, OCR lines, JSON, descriptions, markup blocks, chunks, languages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import text as X
from foliant.operators import documents as D
from foliant.operators import models
from foliant.plans.catalogue import BOXES, boxes, query, read

#: Elements made of boxes: five classes, content of the textual ones, some without language, meta in one of three.
ELEMENTS = BOXES + """, e AS (SELECT 'doc' || page_id % 50 document_id, CAST(page_id // 50 AS INT) page, ['Text', 'Title', 'List', 'Table', 'Figure'][class_id + 1] AS class, x, y, w, h, CASE WHEN class_id < 3 THEN 'word ' || l_suppkey || ' "é"' END AS content, CASE WHEN class_id < 3 AND l_suppkey % 3 > 0 THEN 'en' END AS language, l_suppkey % 3 = 1 AS has_meta, page_id * 100 + ann_no elem_pos FROM gt)
"""


def elements(spark, sf_dir) -> DataFrame:
    b, few = boxes(spark, sf_dir), F.col("class_id") < 3
    s = F.col("l_suppkey")
    meta = F.when(s % 3 == 1, F.create_map(F.lit("source"), F.lit("ocr"))).otherwise(F.create_map().cast("map<string,string>"))
    return b.select(
        F.concat(F.lit("doc"), (F.col("page_id") % 50).cast("string")).alias("document_id"), F.floor(F.col("page_id") / 50).cast("int").alias("page"), D.class_name(F.col("class_id")).alias("class"), *"xywh",
        F.when(few, F.concat(F.lit("word "), s.cast("string"), F.lit(' "é"'))).alias("content"), F.when(few & (s % 3 > 0), F.lit("en")).alias("language"), meta.alias("meta"), (F.col("page_id") * 100 + F.col("ann_no")).alias("elem_pos"),
    )


@query(ELEMENTS + """, j AS (SELECT *, '{"class":"' || class || '","bbox":[' || x || ',' || y || ',' || w || ',' || h || '],"content":' || CASE WHEN content IS NULL THEN 'null' ELSE '"' || replace(content, '"', '\\"') || '"' END || ',"language":' || CASE WHEN language IS NULL THEN 'null' ELSE '"' || language || '"' END || ',"page":' || page || CASE WHEN has_meta THEN ',"meta":{"source":"ocr"}' ELSE '' END || '}' j FROM e)
SELECT document_id, '{"document_id":"' || document_id || '","elements":[' || string_agg(j, ',' ORDER BY page, y, x, elem_pos) || ']}' payload, count(*) n FROM j GROUP BY document_id""")
def q_compile_documents(spark, sf_dir):
    return D.to_documents(elements(spark, sf_dir))


@query(ELEMENTS + "SELECT class, count(*) n, count(content) with_content, count_if(class IN ('Text', 'Title', 'List')) textual, count_if(content IS NULL AND class IN ('Table', 'Figure')) to_describe FROM e GROUP BY class")
def q_class_filter(spark, sf_dir):
    e = elements(spark, sf_dir)
    described = e.join(D.to_describe(e).select("elem_pos", F.lit(1).alias("d")), "elem_pos", "left")
    return described.groupBy("class").agg(F.count("*").alias("n"), F.count("content").alias("with_content"), F.count_if(D.textual(F.col("class"))).alias("textual"), F.count("d").alias("to_describe"))


@query("SELECT o_orderkey % 9 - 1 AS class_id, CASE WHEN o_orderkey % 9 - 1 BETWEEN 0 AND 4 THEN ['Text', 'Title', 'List', 'Table', 'Figure'][o_orderkey % 9] ELSE 'Text' END AS name, count(*) n, CAST(CASE WHEN o_orderkey % 9 - 1 BETWEEN 0 AND 4 THEN o_orderkey % 9 - 1 ELSE 0 END AS INT) back FROM orders GROUP BY ALL")
def q_class_map(spark, sf_dir):
    """Classes that a detector doesn't know are text."""
    k = (F.col("o_orderkey") % 9 - 1).cast("int")
    rows = read(spark, sf_dir, "orders").select(k.alias("class_id"), D.class_name(k).alias("name"))
    return rows.groupBy(F.col("class_id").cast("long").alias("class_id"), "name").agg(F.count("*").alias("n")).withColumn("back", D.class_id(F.col("name")))


@query(BOXES + "SELECT page_id, ann_no, CAST(trunc(x + 0.75) AS INT) x, CAST(trunc(y - 900.25) AS INT) y, CAST(trunc((x + w + 0.5) - (x + 0.75)) AS INT) w, CAST(trunc((y + h + 0.25) - (y - 900.25)) AS INT) h FROM gt")
def q_corners(spark, sf_dir):
    """Corners with fractions, some of them negative, to boxes."""
    x, y, w, h = (F.col(c).cast("double") for c in "xywh")
    box = D.corners_to_box(x + 0.75, y - 900.25, x + w + 0.5, y + h + 0.25)
    return boxes(spark, sf_dir).select("page_id", "ann_no", *(c.alias(n) for c, n in zip(box, "xywh", strict=True)))


@query(BOXES + "SELECT page_id, ann_no, least(x, x + 5) x, least(y - 7, y) y, greatest(x + w, x + w + 5) - least(x, x + 5) w, greatest(y + h, y + h - 7) - least(y, y - 7) h FROM gt")
def q_quads(spark, sf_dir):
    """Slanted quadrilaterals to upright boxes."""
    x, y, w, h = (F.col(c) for c in "xywh")
    point = lambda a, b: F.array(a.cast("long"), b.cast("long"))
    quad = F.array(point(x, y), point(x + w, y - 7), point(x + w + 5, y + h - 7), point(x + 5, y + h))
    return boxes(spark, sf_dir).select("page_id", "ann_no", *(c.alias(n) for c, n in zip(G.quad_to_box(quad), "xywh", strict=True)))


@query(BOXES + "SELECT page_id, ann_no, CASE WHEN ok THEN cx END x, CASE WHEN ok THEN cy END y, CASE WHEN ok THEN cw END w, CASE WHEN ok THEN ch END h FROM (SELECT *, cw > 0 AND ch > 0 ok FROM (SELECT *, least(w, 600 - cx) cw, least(h, 500 - cy) ch FROM (SELECT page_id, ann_no, greatest(0, least(x - 20, 599)) cx, greatest(0, least(y, 499)) cy, CASE WHEN l_suppkey % 29 = 0 THEN 0 ELSE w END w, h FROM gt)))")
def q_crops(spark, sf_dir):
    x, y, w, h = (F.col(c) for c in "xywh")
    cut = D.crop((x - 20, y, F.when(F.col("l_suppkey") % 29 == 0, 0).otherwise(w), h), F.lit(600), F.lit(500))
    return boxes(spark, sf_dir).select("page_id", "ann_no", *(c.alias(n) for c, n in zip(cut, "xywh", strict=True)))


@query("SELECT p_partkey, CAST(CASE WHEN greatest(w, h) <= 1024 THEN w WHEN w > h THEN 1024 ELSE floor(w * 1024 / h) END AS INT) w, CAST(CASE WHEN greatest(w, h) <= 1024 THEN h WHEN w > h THEN floor(h * 1024 / w) ELSE 1024 END AS INT) h FROM (SELECT p_partkey, p_size * 90 w, p_partkey % 3000 + 10 h FROM part)")
def q_resize(spark, sf_dir):
    w, h = D.fitted(F.col("w"), F.col("h"))
    p = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 90).alias("w"), (F.col("p_partkey") % 3000 + 10).cast("int").alias("h"))
    return p.select("p_partkey", w.cast("int").alias("w"), h.cast("int").alias("h"))


#: Conversations as pages of OCR lines, some blank, with confidences.
LINES = "WITH l AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN '  ' ELSE ' ' || text || ' ' END t, ((conv_id + turn) % 10) / 10::DOUBLE c FROM conversations)"


def ocr_lines(spark, sf_dir) -> DataFrame:
    t = F.when(F.col("turn") % 5 == 4, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("text"), F.lit(" ")))
    return read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("line_no"), t.alias("text"), (((F.col("conv_id") + F.col("turn")) % 10) / 10.0).cast("double").alias("confidence"))


@query(LINES + f", s AS (SELECT conv_id, turn, regexp_replace(t, '^[{X.SPACES}]+|[{X.SPACES}]+$', '', 'g') t, c FROM l) SELECT conv_id, CASE WHEN count(CASE WHEN t <> '' THEN 1 END) > 0 THEN string_agg(CASE WHEN t <> '' THEN t END, ' ' ORDER BY turn) END AS content, round(coalesce(avg(CASE WHEN t <> '' THEN c END), 0.0), 9) confidence, count(CASE WHEN t <> '' THEN 1 END) text_lines FROM s GROUP BY conv_id")
def q_ocr_lines(spark, sf_dir):
    return D.lines_to_elements(ocr_lines(spark, sf_dir), ["conv_id"]).withColumn("confidence", F.round("confidence", 9))


@query(LINES + f" SELECT conv_id, turn line_no, CASE WHEN length(regexp_replace(coalesce(t, ''), '^[{X.SPACES}]+|[{X.SPACES}]+$', '', 'g')) < 3 THEN NULL WHEN c < 0.55 THEN 'unknown' ELSE 'en' END AS language, c > 0.5 kept FROM l")
def q_language_gate(spark, sf_dir):
    """Short texts have no language, unsure ones an unknown one; and which lines a scan would keep."""
    return ocr_lines(spark, sf_dir).select("conv_id", "line_no", D.gated_language(F.col("text"), F.lit("en"), F.col("confidence")).alias("language"), (F.col("confidence") > 0.5).alias("kept"))


@query("SELECT label, without, count(*) n FROM (SELECT '__label__' || lang AS label, lang AS without FROM documents UNION ALL SELECT '  ' || lang, lang FROM documents) GROUP BY ALL")
def q_prefixes(spark, sf_dir):
    """Marks cut from the front of labels."""
    d = read(spark, sf_dir, "documents")
    rows = d.select(F.concat(F.lit("__label__"), "lang").alias("label")).unionByName(d.select(F.concat(F.lit("  "), "lang").alias("label")))
    return rows.groupBy("label", D.without_prefix(F.col("label"), "__label__").alias("without")).agg(F.count("*").alias("n"))


@query(ELEMENTS + """, new AS (SELECT document_id, page, class, x, y, w, h, 'about ' || elem_pos AS content, elem_pos FROM e WHERE class IN ('Table', 'Figure') AND elem_pos % 2 = 0), f AS (SELECT document_id, page, class, x, y, w, h, arg_min(content, elem_pos) AS c FROM new GROUP BY ALL)
SELECT e.elem_pos, e.class, CASE WHEN e.content IS NULL AND e.class IN ('Table', 'Figure') THEN f.c ELSE e.content END AS content, CASE WHEN e.content IS NULL AND e.class IN ('Table', 'Figure') AND f.c IS NOT NULL THEN 'vlm_description' WHEN e.has_meta THEN 'ocr' END AS source FROM e LEFT JOIN f USING (document_id, page, class, x, y, w, h)""")
def q_description_merge(spark, sf_dir):
    """Every other table and figure has a description; some boxes are there twice."""
    e = elements(spark, sf_dir)
    new = e.where("class in ('Table', 'Figure') and elem_pos % 2 = 0").withColumn("content", F.concat(F.lit("about "), F.col("elem_pos").cast("string")))
    return D.merge_descriptions(e, new).select("elem_pos", "class", "content", F.try_element_at("meta", F.lit("source")).alias("source"))


@query("SELECT o_orderkey page_id, min(CASE WHEN l_returnflag <> 'R' THEN l_partkey END) AS value FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def q_stage_merge(spark, sf_dir):
    """Results of a stage joined back to their pages where they succeeded."""
    results = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page_id"), (F.col("l_returnflag") != "R").alias("success"), F.col("l_partkey").alias("value"))
    return D.merge_stages(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id")), results, "page_id", "value")


@query(ELEMENTS + ", p AS (SELECT *, page % 3 part_no FROM e WHERE document_id IN ('doc1', 'doc2', 'doc3')) SELECT (SELECT arg_min(document_id, part_no * 1000 + CAST(document_id[4:] AS INT)) FROM p WHERE part_no > 0) document_id, count(*) n, string_agg(CAST(elem_pos AS VARCHAR), ',' ORDER BY page, y, x, part_no, elem_pos) reading FROM p")
def q_merge_parts(spark, sf_dir):
    """Three parts as one document, the first of them without an id."""
    p = elements(spark, sf_dir).where("document_id in ('doc1', 'doc2', 'doc3')").withColumn("part_no", F.col("page") % 3)
    first = p.where("part_no > 0").agg(F.min_by("document_id", F.struct("part_no", "document_id")).alias("d"))
    named = p.crossJoin(F.broadcast(first)).withColumn("document_id", F.when(F.col("part_no") > 0, F.col("d"))).drop("d").withColumn("was", F.col("elem_pos"))
    merged = D.merge_parts(named)
    return D.reading_order(merged, "document_id", ["page", "y", "x", "elem_pos"], "was").join(merged.groupBy("document_id").agg(F.count("*").alias("n")), "document_id")


#: Documents with something wrong in two of three: the kind of fault follows the page.
FAULTS = (
    (0, "Missing required field: document_id"), (1, "Element 0 missing required field: content"), (2, "Element 0 bbox must be a list of 4 integers"), (3, "Element 0 bbox contains negative values"), (4, "Element 0 bbox must contain only integers"),
    (5, "'elements' must be a list"), (6, "Not a JSON object"), (7, "Element 0 is not a dictionary"),
)


@query(BOXES + "SELECT page_id, CASE page_id % 12 " + " ".join("WHEN {} THEN '{}'".format(k, e.replace("'", "''")) for k, e in FAULTS) + " END AS error, page_id % 12 > 7 AS ok, count(*) n FROM gt GROUP BY page_id")
def q_schema_validate(spark, sf_dir):
    """The first thing wrong with a JSON document for each page."""
    kind = F.col("page_id") % 12
    box = F.when(kind == 2, F.concat_ws(",", "x", "y", "w")).when(kind == 3, F.concat_ws(",", -1 - F.col("x"), "y", "w", "h")).when(kind == 4, F.concat_ws(",", "x", F.lit("1.5"), "w", "h")).otherwise(F.concat_ws(",", "x", "y", "w", "h"))
    element = F.when(kind == 7, F.lit("3")).otherwise(F.concat(F.lit('{"class":"Text","bbox":['), box, F.lit('],"language":null,"page":0'), F.when(kind == 1, "").otherwise(',"content":null'), F.lit("}")))
    pages = boxes(spark, sf_dir).groupBy("page_id").agg(F.array_join(F.collect_list(element), ",").alias("e"), F.count("*").alias("n"))
    payload = F.concat(F.lit("{"), F.when(kind == 0, "").otherwise('"document_id":"d",'), F.lit('"elements":'), F.when(kind == 5, F.lit("7")).otherwise(F.concat(F.lit("["), F.col("e"), F.lit("]"))), F.when(kind == 6, "").otherwise("}"))
    return pages.select("page_id", X.document_error(payload).alias("error"), X.valid_document(payload).alias("ok"), "n")


_TAGS = "|".join(models.TAGS)


@query(f"""WITH b AS (SELECT page_id, unnest(bs) b, generate_subscripts(bs, 1) - 1 elem_pos FROM (SELECT page_id, regexp_extract_all(html, '(?s)<({_TAGS})(?: [^>]*)?>(.*?)</(?:{_TAGS})>') bs FROM pages)),
t AS (SELECT page_id, CAST(elem_pos AS INT) elem_pos, regexp_extract(b, '^<({_TAGS})', 1) tag, regexp_replace(regexp_replace(replace(regexp_replace(b, '(?s)<[^>]*>', ' ', 'g'), '&amp;', '&'), '[{X.SPACES}]+', ' ', 'g'), '^[{X.SPACES}]+|[{X.SPACES}]+$', '', 'g') plain FROM b)
SELECT page_id, elem_pos, CASE {" ".join(f"WHEN tag = '{t}' THEN '{c}'" for t, c in models.TAGS.items())} END AS class, 0 x, elem_pos * 40 y, least(1000, greatest(1, length(plain) * 10)) w, (length(plain) // 100 + 1) * 20 h, CASE WHEN tag NOT IN ('table', 'figure') AND plain <> '' THEN plain END AS content FROM t""")
def q_markup_blocks(spark, sf_dir):
    """Blocks of web pages as a detector's and an OCR engine's stand-in."""
    return models.markup_blocks(read(spark, sf_dir, "pages")).drop("score")


@query()
def q_process_pages(spark, sf_dir):
    """Pages to documents end to end. No SQL: suppression is greedy, and the language a vote; tests hold it in plain Python."""
    from foliant.plans.pipelines import process

    pages = read(spark, sf_dir, "pages")
    docs = D.to_documents(process(pages, F.regexp_extract("url", "://([^/?#]*)", 1)))
    return docs.select("document_id", "n", F.md5("payload").alias("digest"), X.valid_document(F.col("payload")).alias("valid"))


def _language_sql() -> str:
    score = lambda words: f"len(list_filter(w, lambda x: x IN ({', '.join(repr(v) for v in words)})))"
    counts = {k: score(v) for k, v in sorted(models.COMMON.items())}
    best = f"greatest({', '.join(counts.values())})"
    total = " + ".join(counts.values())
    pick = " ".join(f"WHEN {c} = {best} THEN '{k}'" for k, c in counts.items())
    return f"WITH w AS (SELECT doc_id, text, lang, list_transform(regexp_extract_all(lower(coalesce(text, '')), '{X.WORD}'), lambda x: regexp_replace(x, '[.,;:!?]+$', '')) w FROM documents), s AS (SELECT *, CASE WHEN {total} > 0 THEN {best} / ({total}) ELSE 0.0 END sure, CASE {pick} END guess FROM w), g AS (SELECT lang, CASE WHEN length(regexp_replace(coalesce(text, ''), '^[{X.SPACES}]+|[{X.SPACES}]+$', '', 'g')) < 3 THEN NULL WHEN sure < 0.55 THEN 'unknown' ELSE guess END guess, sure FROM s)"


LANGUAGES = _language_sql()


def language_rows(spark, sf_dir) -> DataFrame:
    guess, sure = models.language_of(F.col("text"))
    return read(spark, sf_dir, "documents").select("lang", guess.alias("guess"), sure.alias("confidence"))


@query(LANGUAGES + " SELECT lang, guess, count(*) n, round(avg(sure), 6) confidence FROM g GROUP BY ALL")
def q_language_id(spark, sf_dir):
    return language_rows(spark, sf_dir).groupBy("lang", "guess").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("confidence"))


@query("SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 4 batch FROM conversations")
def q_batches(spark, sf_dir):
    return D.batches(read(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", ["turn"], 4)


@query(f"WITH w AS (SELECT conv_id, turn, unnest(ws) word, generate_subscripts(ws, 1) p FROM (SELECT conv_id, turn, regexp_extract_all(lower(coalesce(text, '')), '{X.WORD}') ws FROM conversations)), c AS (SELECT conv_id, turn, word, count(*) n, min(p) p FROM w GROUP BY ALL) SELECT conv_id, turn, word, n FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, p) r FROM c) WHERE r <= 3")
def q_top_words(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(X.top_words(X.words(F.lower("text")))).alias("t"))
    return c.select("conv_id", "turn", "t.word", F.col("t.n").cast("long").alias("n"))


@query("SELECT doc_id, page, CASE WHEN page >= 2 AND page < 5 THEN 'in' ELSE 'out' END AS place FROM (SELECT doc_id, doc_id % 8 page FROM documents)")
def q_page_range(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 8).alias("page"))
    return d.withColumn("place", F.when(D.in_page_range(F.col("page"), 2, 5), "in").otherwise("out"))
