"""The query catalogue: name -> (spark, sf_dir) -> DataFrame, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import geometry as G
from foliant.functions import text as X
from foliant.operators import matching as M
from foliant.operators import quality as Q
from foliant.operators import relational as R
from foliant.operators.documents import reading_order
from foliant.operators.hashes import near_hashes
from foliant.operators.nearest import top_similar

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PAGE_W, PAGE_H = 1000, 900


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground-truth boxes: every order is a page, every line item a box. They are dealt by page_id, as joins by page need."""
    items = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    w = Window.partitionBy("page_id").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return items.withColumn("ann_no", F.row_number().over(w)).select(
        "page_id", "ann_no", ((F.col("l_partkey") * 7) % 500).alias("x"), (F.col("l_linenumber") * 90).cast("long").alias("y"),
        (40 + F.floor("l_quantity") * 4).cast("long").alias("w"), F.lit(60).cast("long").alias("h"), (F.col("l_partkey") % 5).cast("int").alias("class_id"), "l_suppkey", "l_discount",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(boxes(spark, sf_dir))


def predicted(gt: DataFrame, *also: str) -> DataFrame:
    """The predictions of true boxes, with columns of theirs, told in one look at a true box: one near it, one far below."""
    s, far = F.col("l_suppkey"), F.col("__far")
    either = lambda low, near: F.when(far, low).otherwise(near)
    each = gt.select("*", F.explode(F.array(F.when(s % 13 != 0, F.lit(False)), F.when(s % 17 == 0, F.lit(True)))).alias("__far")).where("__far is not null")
    return each.select(
        "page_id", either(F.col("ann_no") + 100, F.col("ann_no")).alias("ann_no"), either(F.col("x"), F.col("x") + s % 60).alias("x"), either(F.col("y") + 450, F.col("y")).alias("y"), "w", "h",
        F.when(~far & (s % 11 == 0), (F.col("class_id") + 1) % 5).otherwise(F.col("class_id")).alias("class_id"), either(0.3 + F.col("l_discount") * 5, 1 - F.col("l_discount") * 5).alias("score"), *also,
    )


BOXES = """WITH gt AS (SELECT l_orderkey page_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) ann_no, (l_partkey * 7) % 500 x, l_linenumber * 90 y,
 40 + CAST(floor(l_quantity) AS INT) * 4 w, 60 h, CAST(l_partkey % 5 AS INT) class_id, l_suppkey, l_discount FROM lineitem),
pred AS (SELECT page_id, ann_no, x + l_suppkey % 60 x, y, w, h, CASE WHEN l_suppkey % 11 = 0 THEN (class_id + 1) % 5 ELSE class_id END class_id, 1 - l_discount * 5 score FROM gt WHERE l_suppkey % 13 <> 0
 UNION ALL SELECT page_id, 100 + ann_no, x, y + 450, w, h, class_id, 0.3 + l_discount * 5 FROM gt WHERE l_suppkey % 17 = 0),
pairs AS (SELECT * FROM (SELECT g.page_id, g.ann_no gt_no, p.ann_no pred_no, g.class_id gt_class, p.class_id pred_class,
 greatest(0, least(g.x + g.w, p.x + p.w) - greatest(g.x, p.x)) * greatest(0, least(g.y + g.h, p.y + p.h) - greatest(g.y, p.y)) inter, g.w * g.h + p.w * p.h area FROM gt g JOIN pred p USING (page_id)) WHERE inter > 0)
"""
def box() -> G.Box:
    return tuple(F.col(c) for c in "xywh")



@query(BOXES + "SELECT page_id, ann_no, round(xc, 6) xc, round(yc, 6) yc, round(w / 1000, 6) w, round(h / 900, 6) h FROM (SELECT page_id, ann_no, w, h, (greatest(0, least(x, 1000 - w)) + w / 2) / 1000 xc, (greatest(0, least(y, 900 - h)) + h / 2) / 900 yc FROM gt)")
def q_bbox_to_yolo(spark, sf_dir):
    out = G.to_yolo(G.clip_keeping_size(box(), PAGE_W, PAGE_H), PAGE_W, PAGE_H)
    return boxes(spark, sf_dir).select("page_id", "ann_no", *(F.round(c, 6).alias(n) for c, n in zip(out, ("xc", "yc", "w", "h"), strict=True)))


@query(BOXES + "SELECT class_id, count(*) n, sum(w * h) area, sum(greatest(0, least(x, 999))) x, sum(greatest(1, least(w, 1000 - greatest(0, least(x, 999))))) w, sum(greatest(1, least(h, 900 - greatest(0, least(y, 899))))) h FROM pred GROUP BY class_id")
def q_clamp_variants(spark, sf_dir):
    x, _, w, h = G.clamp_origin(box(), PAGE_W, PAGE_H)
    return predictions(spark, sf_dir).groupBy("class_id").agg(F.count("*").alias("n"), F.sum(F.col("w") * F.col("h")).alias("area"), F.sum(x).alias("x"), F.sum(w).alias("w"), F.sum(h).alias("h"))


@query("SELECT o_orderpriority, p_brand, count(*) n, sum(CAST(l_quantity AS BIGINT)) quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL")
def q_annotation_image_category(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return li.groupBy("o_orderpriority", "p_brand").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("SELECT l_returnflag, count(*) n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def q_semi_annotations(spark, sf_dir):
    done = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    return read(spark, sf_dir, "lineitem").join(done, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("SELECT lang, count(*) n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1")
def q_anti_unlabelled(spark, sf_dir):
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left_anti").groupBy("lang").agg(F.count("*").alias("n"))


@query(BOXES + "SELECT gt_class, pred_class, count(*) n, count_if(2 * inter = area - inter) n_half, count_if(2 * inter > area - inter) n_over FROM pairs GROUP BY ALL")
def q_iou_candidates(spark, sf_dir):
    p = M.candidates(boxes(spark, sf_dir), predictions(spark, sf_dir))
    return p.groupBy("gt_class", "pred_class").agg(F.count("*").alias("n"), F.count_if(2 * F.col("inter") == F.col("uni")).alias("n_half"), F.count_if(2 * F.col("inter") > F.col("uni")).alias("n_over"))


@query(BOXES + "SELECT 'fp' kind, class_id, count(*) n FROM pred p WHERE NOT EXISTS (SELECT 1 FROM pairs q WHERE q.page_id = p.page_id AND q.pred_no = p.ann_no AND 2 * inter > area - inter) GROUP BY class_id UNION ALL SELECT 'fn', class_id, count(*) FROM gt g WHERE NOT EXISTS (SELECT 1 FROM pairs q WHERE q.page_id = g.page_id AND q.gt_no = g.ann_no AND 2 * inter > area - inter) GROUP BY class_id")
def q_fp_fn_overlay(spark, sf_dir):
    return M.unmatched(boxes(spark, sf_dir), predictions(spark, sf_dir)).groupBy("kind", "class_id").agg(F.count("*").alias("n"))


@query("""SELECT c AS class, coalesce(n, 0) n, 100.0 * coalesce(n, 0) / (SELECT count(*) FROM events) pct, 100.0 * coalesce(n, 0) / (SELECT count(*) FROM events) < 5 rare FROM (SELECT unnest(['signup', 'error', 'click', 'view', 'purchase', 'refund']) c) LEFT JOIN (SELECT event_type, count(*) n FROM events GROUP BY 1) ON c = event_type""")
def q_class_imbalance(spark, sf_dir):
    declared = spark.createDataFrame([(c,) for c in ("signup", "error", "click", "view", "purchase", "refund")], "class string")
    return R.class_balance(read(spark, sf_dir, "events"), "event_type", declared)


@query(BOXES + "SELECT class_id, count(*) n, min(w) min_w, max(w) max_w, round(avg(w), 6) avg_w, min(h) min_h, max(h) max_h, round(avg(h), 6) avg_h, min(w * h) min_area, max(w * h) max_area, round(avg(w * h), 6) avg_area, round(stddev_pop(w), 6) std_w, round(median(w), 6) median_w, count(DISTINCT page_id) pages FROM gt GROUP BY class_id")
def q_dataset_stats(spark, sf_dir):
    sized = boxes(spark, sf_dir).withColumn("area", F.col("w") * F.col("h"))
    sides = [f(c).alias(f"{n}_{c}") if n != "avg" else F.round(f(c), 6).alias(f"{n}_{c}") for c in ("w", "h", "area") for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))]
    return sized.groupBy("class_id").agg(F.count("*").alias("n"), *sides, F.round(F.stddev_pop("w"), 6).alias("std_w"), F.round(F.median("w"), 6).alias("median_w"), F.count_distinct("page_id").alias("pages"))


@query("""WITH r AS (SELECT CAST(quality AS VARCHAR) t, CASE WHEN n_chars > 1000 THEN '1' ELSE '0' END g FROM labels JOIN documents USING (doc_id)), l AS (SELECT t label FROM r UNION SELECT g FROM r),
s AS (SELECT label, (SELECT count(*) FROM r WHERE t = label AND g = label) tp, (SELECT count(*) FROM r WHERE t <> label AND g = label) fp, (SELECT count(*) FROM r WHERE t = label AND g <> label) fn FROM l),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END r FROM s)
SELECT label, tp, fp, fn, tp + fn support, round(p, 9) "precision", round(r, 9) recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 9) f1 FROM m""")
def q_confusion_prf(spark, sf_dir):
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id").select(F.col("quality").cast("string").alias("t"), F.when(F.col("n_chars") > 1000, "1").otherwise("0").alias("g"))
    return R.per_label(rows, "t", "g").select("label", "tp", "fp", "fn", "support", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")))


CONFIDENT = "SELECT (l_partkey % 101) / 100.0 c, l_suppkey % 3 > 0 y FROM lineitem"


def confident(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(((F.col("l_partkey") % 101) / 100.0).cast("double").alias("c"), (F.col("l_suppkey") % 3 > 0).alias("y"))


@query(f"SELECT round(sum(CASE WHEN b >= 1 THEN abs(conf - acc) * n ELSE 0 END) / sum(n), 6) ece, CAST(sum(n) AS BIGINT) n FROM (SELECT ceil(c * 10) b, count(*) n, avg(c) conf, avg(CAST(y AS INT)) acc FROM (SELECT CAST(c AS DOUBLE) c, y FROM ({CONFIDENT})) GROUP BY 1)")
def q_ece(spark, sf_dir):
    return R.ece(confident(spark, sf_dir), "c", "y").select(F.round("ece", 6).alias("ece"), "n")


@query(f"""WITH r AS (SELECT greatest(1e-8, least(CAST(c AS DOUBLE), 1 - 1e-8)) c, CAST(y AS INT) y FROM ({CONFIDENT})), e AS (SELECT k, pow(10.0, -2.0 + k * (4.0::DOUBLE / 99)) t, ln(c / (1 - c + 1e-8)) z, y FROM r, range(100) q(k)),
p AS (SELECT k, t, y, greatest(1e-8, least(1 / (1 + exp(-z / t)), 1 - 1e-8)) p FROM e) SELECT CAST(k AS INT) k, round(t, 6) t, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) nll FROM p GROUP BY k, t ORDER BY avg(-(y * ln(p) + (1 - y) * ln(1 - p))), k LIMIT 1""")
def q_temperature(spark, sf_dir):
    return R.best_temperature(confident(spark, sf_dir), "c", "y").select("k", F.round("t", 6).alias("t"), F.round("nll", 6).alias("nll"))


def _ascii_sql(text: str, kind: str) -> str:
    """A text in which letters and digits beyond ASCII are underscores, which are no part of any pattern but that of
    addresses: the SQL engine knows word boundaries beside ASCII only."""
    return text if kind == "email" else f"regexp_replace(regexp_replace({text}, '[^\\x00-\\x7F\\p{{L}}\\p{{M}}\\p{{N}}]', '#', 'g'), '[^\\x00-\\x7F]', '_', 'g')"


def _pii_sql(types=tuple(X.PII)) -> str:
    parts = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS type, unnest(regexp_extract_all({_ascii_sql('text', k)}, '{X.PII[k]}')) AS original FROM documents" for k in types)
    return f"({parts})"


#: Where engines agree on case and edits; the narrower queries q_..._ascii hold SQL against the whole ones' rows.
NOT_ASCII = r"[^\x00-\x7F]"


@query(f"SELECT doc_id, type, original, count(*) n FROM {_pii_sql()} GROUP BY ALL")
def q_pii_findings(spark, sf_dir):
    """Every type in every document."""
    hits = read(spark, sf_dir, "documents").select("doc_id", F.explode(X.pii_hits(F.col("text"))).alias("h"))
    return hits.groupBy("doc_id", "h.type", "h.original").agg(F.count("*").alias("n"))


#: Documents with hits of the types that they lack.
RARE = "(VALUES (1, 'PAN ABCDE1234F and aadhaar 1234-5678-9012'), (2, 'SSN 123-45-6789, born 01/02/1990 or 1990-02-01'), (3, 'IBAN DE89370400440532013000 by DEUTDEFF500'), (4, 'a@b.org, 4111111111111111 and +49 (123) 456-7890'), (5, 'ab'))"


def _redact_sql() -> str:
    keep = lambda k: f"CASE WHEN length(o) > {2 * k} THEN o[1:{k}] || repeat('*', length(o) - {2 * k}) || o[length(o) - {k - 1}:] ELSE repeat('*', length(o)) END"
    dated = "CASE WHEN regexp_matches(o, '[-/][0-9]{4}$') THEN regexp_replace(o, '[0-9]{4}$', '****') WHEN regexp_matches(o, '^[0-9]{4}[-/]') THEN regexp_replace(o, '^[0-9]{4}', '****') ELSE repeat('*', length(o)) END"
    return f"CASE type WHEN 'dob' THEN {dated} WHEN 'email' THEN {keep(1)} ELSE {keep(2)} END"


_CONTEXT_SQL = "CASE WHEN place > 51 THEN '...' ELSE '' END || t[greatest(1, place - 50):least(length(t), place + length(o) + 49)] || CASE WHEN place + length(o) + 49 < length(t) THEN '...' ELSE '' END"


def _pii_rows_sql(table: str, types) -> str:
    return " UNION ALL ".join(f"SELECT id, t, '{k}' AS type, unnest(regexp_extract_all({_ascii_sql('t', k)}, '{X.PII[k]}')) AS o FROM {table}" for k in types)


REDACTED = ("email", "pan", "aadhaar", "iban", "swift", "dob", "credit_card", "ssn")


@query(f"WITH d AS (SELECT doc_id id, text t FROM documents UNION ALL SELECT -col0, col1 FROM {RARE}), h AS ({_pii_rows_sql('d', REDACTED)}), p AS (SELECT *, instr(t, o) AS place FROM h) SELECT id, type, o original, {_redact_sql()} redacted, {_CONTEXT_SQL} AS context, count(*) n FROM p GROUP BY ALL")
def q_pii_redacted(spark, sf_dir):
    """All types but phone numbers, which any four digits are; with texts that hold the types the documents lack."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("t"))
    rows = docs.unionByName(spark.sql(f"SELECT CAST(-col1 AS BIGINT) AS id, col2 AS t FROM VALUES {RARE[8:-1]}"))
    return Q.scan_pii(rows, "id", "t", REDACTED).groupBy("id", "type", "original", "redacted", "context").agg(F.count("*").alias("n"))


@query(f"WITH h AS {_pii_sql()} SELECT (SELECT count(*) FROM h) findings, (SELECT count(DISTINCT doc_id) FROM h) with_pii, (SELECT count(DISTINCT doc_id) FROM documents) scanned")
def q_pii_summary(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return Q.pii_totals(docs.select("doc_id", F.explode(X.pii_hits(F.col("text")))), "doc_id", docs)


RTL_SHARE = f"length(regexp_replace(text, '{X.RTL[:1] + '^' + X.RTL[1:]}', '', 'g'))"


@query(f"""WITH d AS (SELECT doc_id, lang, CASE WHEN r > 0.6 THEN 'rtl' WHEN r > 0.3 THEN 'mixed' ELSE 'ltr' END direction FROM (SELECT doc_id, lang, CASE WHEN length(text) > 0 THEN {RTL_SHARE} / length(text) ELSE 0 END r FROM documents)),
h AS {_pii_sql()} SELECT lang, direction, type, count(original) n, count(DISTINCT doc_id) documents FROM d LEFT JOIN h USING (doc_id) GROUP BY ALL""")
def q_quality_summary(spark, sf_dir):
    """Personal data and direction by language and type; every language has a row."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", X.direction(F.col("text"))[1].alias("direction"), F.explode_outer(X.pii_hits(F.col("text"))).alias("h"))
    return docs.groupBy("lang", "direction", F.col("h.type").alias("type")).agg(F.count("h.original").alias("n"), F.count_distinct("doc_id").alias("documents"))


def _any_sql(keys, text="lower(text)") -> str:
    return "(" + " OR ".join(f"contains({text}, '{k}')" for k in keys) + ")"


def _license_sql(text: str = "text") -> dict[str, str]:
    """The terms of license_terms, in SQL."""
    low, head = f"lower({text})", f"lower({text}[1:500])"
    credit = "".join(f"WHEN regexp_matches({text}[1:500], '(?is){w}{X.CREDIT_TEXT}') THEN regexp_replace(regexp_extract({text}[1:500], '(?is){w}{X.CREDIT_TEXT}', 1), '^[{X.SPACES}]+|[{X.SPACES}]+$', '', 'g') " for w in X.CREDITS)
    return {
        "license_type": "CASE " + " ".join(f"WHEN {_any_sql(keys, low)} THEN '{n}'" for n, keys in X.LICENSES) + " ELSE 'Unknown' END", "requires_attribution": _any_sql(X.ATTRIBUTION, low), "attribution_text": f"CASE {credit}ELSE '' END",
        "commercial_use": f"NOT {_any_sql(X.NOT_COMMERCIAL, head)}", "modification_allowed": f"NOT {_any_sql(X.NOT_MODIFIED, head)}",
        "requirements": "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {_any_sql(keys, head)} THEN '{n}' END" for n, keys in X.REQUIREMENTS) + "], lambda r: r IS NOT NULL), ',')",
    }


@query("SELECT doc_id, " + ", ".join(f"{v} AS {k}" for k, v in _license_sql().items()) + " FROM documents")
def q_license_terms(spark, sf_dir):
    terms = X.license_terms(F.col("text"))
    terms["requirements"] = F.array_join(terms["requirements"], ",")
    return read(spark, sf_dir, "documents").select("doc_id", *(c.alias(n) for n, c in terms.items()))


@query(f"""WITH f AS (SELECT source folder, {_license_sql()['license_type']} t, {_license_sql()['requires_attribution']} a FROM documents WHERE {_any_sql(('license', 'copyright'), 'lower(text)')}),
g AS (SELECT source folder, count(t) license_files, coalesce(array_to_string(list_sort(list_distinct(list(t) FILTER (t IS NOT NULL))), ','), '') license_types, coalesce(bool_or(a), false) has_attribution, count(DISTINCT t) > 1 multiple FROM (SELECT DISTINCT source FROM documents) LEFT JOIN f ON folder = source GROUP BY 1)
SELECT *, CASE WHEN license_files = 0 THEN 1 ELSE 0 END + CASE WHEN license_files > 0 AND NOT has_attribution THEN 1 ELSE 0 END + CASE WHEN multiple THEN 1 ELSE 0 END n_warnings, CASE WHEN license_files = 0 THEN 2 ELSE 0 END + CASE WHEN license_files > 0 AND NOT has_attribution THEN 1 ELSE 0 END + CASE WHEN multiple THEN 1 ELSE 0 END n_recommendations FROM g""")
def q_license_compliance(spark, sf_dir):
    """Sources as folders; their licence files are the documents that speak of a licence or copyright."""
    t = F.col("text")
    docs = read(spark, sf_dir, "documents").select("source", F.when(X.has_any(t, ("license", "copyright")), t).alias("t"))
    g = Q.folder_licenses(docs, "source", "t")
    return g.select(F.col("source").alias("folder"), "license_files", F.array_join("license_types", ",").alias("license_types"), "has_attribution", "multiple", F.size("warnings").alias("n_warnings"), F.size("recommendations").alias("n_recommendations"))


WORDS_SQL = f"regexp_extract_all(coalesce(text, ''), '{X.WORD}')"


@query(f"""WITH w AS (SELECT doc_id, text, {WORDS_SQL} w FROM documents WHERE text IS NOT NULL), s AS (SELECT doc_id, text, w, unnest(CASE WHEN len(w) <= 220 THEN [0] ELSE range(0, len(w), 190) END) i FROM w)
SELECT doc_id, i // 190 chunk_no, md5(CASE WHEN len(w) <= 220 THEN text ELSE array_to_string(w[i + 1:i + 220], ' ') END) digest FROM s""")
def q_chunk_documents(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.chunks(F.col("text"))).alias("chunk_no", "chunk")).select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.md5("chunk").alias("digest"))


#: Turns as descriptions: their class and page language follow their place.
KINDS = ("Table", "Figure", "Chart", "Text")


def qa_rows(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    kind = F.element_at(F.array(*(F.lit(k) for k in KINDS)), ((F.col("conv_id") + F.col("turn")) % 4 + 1).cast("int"))
    return c.select("conv_id", "turn", kind.alias("class"), X.qa_flags(F.col("text"), kind, F.when(F.col("conv_id") % 2 == 0, "en")).alias("flags"))


def _qa_sql() -> str:
    """Flags of the same rows: (conv_id, turn, class, f), f being [issue, severity]."""
    low, spaces = "lower(text)", X.SPACES
    generic = " + ".join(f"CAST(contains({low}, '{p}') AS INT)" for p in X.GENERIC)
    english = f"({_any_sql(X.ENGLISH, low)} AND NOT regexp_matches(text, '[^\x00-\x7F]'))"
    missing = " OR ".join(f"(class = '{k}' AND NOT {_any_sql(v, low)})" for k, v in X.RELEVANT.items())
    flags = (
        ("n > 80", "length_excessive", "medium"), ("n < 3", "length_insufficient", "high"), (f"conv_id % 2 = 0 AND NOT {english}", "language_mismatch", "medium"),
        (f"class <> 'Text' AND NOT regexp_matches(text, '{X.NUMBER}')", "missing_numerics", "medium"), ("len(s) = 0", "no_sentences", "high"), (f"len(list_filter(s, lambda x: len(regexp_extract_all(x, '{X.WORD}')) > 30)) > 0", "long_sentences", "low"),
        ("n >= 5 AND 2 * len(list_distinct(list_transform(w, lambda x: lower(x)))) < n", "excessive_repetition", "medium"), (f"{generic} > 2", "generic_content", "low"), (f"{generic} <= 2 AND ({missing})", "inappropriate_content", "medium"),
    )
    picked = ", ".join(f"CASE WHEN {cond} THEN ['{issue}', '{severity}'] END" for cond, issue, severity in flags)
    return f"""(SELECT conv_id, turn, class, unnest(list_filter([{picked}], lambda f: f IS NOT NULL)) f FROM (SELECT *, len(w) n FROM (SELECT conv_id, turn, text, ['{"', '".join(KINDS)}'][(conv_id + turn) % 4 + 1] AS class, {WORDS_SQL} w,
 list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda x: regexp_replace(x, '^[{spaces}]+|[{spaces}]+$', '', 'g')), lambda x: x <> '') s FROM conversations WHERE text <> '')))"""


@query(f"SELECT conv_id, turn, class, f[1] issue, f[2] severity FROM {_qa_sql()}")
def q_qa_flags(spark, sf_dir):
    """All checks of every turn."""
    return qa_rows(spark, sf_dir).select("conv_id", "turn", "class", F.explode("flags").alias("f")).select("conv_id", "turn", "class", "f.issue", "f.severity")


@query(f"SELECT issue, severity, class, count(*) n FROM (SELECT class, f[1] issue, f[2] severity FROM {_qa_sql()}) GROUP BY GROUPING SETS ((issue), (severity), (class))")
def q_qa_summary(spark, sf_dir):
    """Counts by issue, by severity and by class in one pass (grouping sets)."""
    from foliant.operators.evaluation import qa_summary

    return qa_summary(q_qa_flags(spark, sf_dir))


@query(f"SELECT (SELECT count(*) FROM conversations) total, count(*) flagged, round(count(*) / (SELECT count(*) FROM conversations), 9) flag_rate FROM (SELECT DISTINCT conv_id, turn FROM {_qa_sql()})")
def q_qa_rate(spark, sf_dir):
    from foliant.operators.evaluation import flag_rate

    return flag_rate(qa_rows(spark, sf_dir), "flags").withColumn("flag_rate", F.round("flag_rate", 9))


def adjacent(spark, sf_dir):
    """Each turn's text and the next turn's; null texts are empty."""
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    return c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("other")), ["conv_id", "turn"])


def both_ascii():
    return ~F.concat("text", "other").rlike(NOT_ASCII)


def cer(pairs):
    return pairs.select("conv_id", "turn", F.round(X.char_error_rate(F.col("text"), F.col("other")), 9).alias("cer"))


@query()
def q_cer_pairs(spark, sf_dir):
    """All adjacent turns. No SQL: DuckDB's levenshtein counts bytes."""
    return cer(adjacent(spark, sf_dir))


@query("SELECT a.conv_id, a.turn, round(levenshtein(a.text, b.text) / length(a.text), 9) cer FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE length(a.text) > 0 AND NOT regexp_matches(a.text || b.text, '[^\\x00-\\x7F]')")
def q_cer_pairs_ascii(spark, sf_dir):
    """The rows of q_cer_pairs that SQL gives too: ASCII texts, the true one not empty."""
    return cer(adjacent(spark, sf_dir).where((F.length("text") > 0) & both_ascii()))


@query("SELECT min(doc_id) doc_id, count(*) n, md5(text) digest FROM documents GROUP BY md5(text) HAVING count(*) > 1")
def q_exact_dup(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).where("n > 1").select("doc_id", "n", "digest")


#: Hashes of 60 bits that orders of a customer share but for a few bits, and those of some that differ in nine or more.
NEAR_SQL = "xor(CAST('0x' || md5(CAST(o_custkey AS VARCHAR))[1:15] AS BIGINT), [0, 1, 2305843, 255, 511, 34359738368][o_orderkey % 6 + 1])"


@query(f"WITH h AS (SELECT min(o_orderkey) id, o_custkey, {NEAR_SQL} h FROM orders GROUP BY ALL), c AS (SELECT min(id) id, h FROM h GROUP BY h) SELECT a.id a, b.id b, bit_count(xor(a.h, b.h)) distance FROM c a JOIN c b ON a.id < b.id AND bit_count(xor(a.h, b.h)) <= 8")
def q_near_hashes(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    change = F.element_at(F.array(*(F.lit(x).cast("long") for x in (0, 1, 2305843, 255, 511, 34359738368))), (F.col("o_orderkey") % 6 + 1).cast("int"))
    h = F.conv(F.substring(F.md5(F.col("o_custkey").cast("string")), 1, 15), 16, 10).cast("long").bitwiseXOR(change)
    return near_hashes(o.select("o_orderkey", h.alias("h")), "o_orderkey", "h")


SPLIT = "CASE WHEN n < 3 OR r <= floor(n * 0.8) THEN 'train' WHEN r <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END"


@query(f"SELECT o_orderkey, {SPLIT} split FROM (SELECT o_orderkey, count(*) OVER () n, row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) r FROM orders)")
def q_split_uniform(spark, sf_dir):
    return R.split_rows(read(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@query(f"SELECT doc_id, {SPLIT} split FROM (SELECT doc_id, count(*) OVER (PARTITION BY lang, source) n, row_number() OVER (PARTITION BY lang, source ORDER BY md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR))), doc_id) r FROM documents)")
def q_split_stratified(spark, sf_dir):
    return R.split_rows(read(spark, sf_dir, "documents").select("doc_id", "lang", "source"), ["doc_id"], ["lang", "source"]).select("doc_id", "split")


@query(f"WITH s AS (SELECT conv_id, {SPLIT} split FROM (SELECT conv_id, count(*) OVER () n, row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(conv_id AS VARCHAR))), conv_id) r FROM (SELECT DISTINCT conv_id FROM conversations))) SELECT split, count(*) n, count(DISTINCT conv_id) conversations FROM conversations JOIN s USING (conv_id) GROUP BY split")
def q_split_grouped(spark, sf_dir):
    """Whole conversations move together."""
    turns = read(spark, sf_dir, "conversations").select("conv_id")
    groups = R.split_rows(turns.distinct(), ["conv_id"])
    return turns.join(groups, "conv_id").groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("conv_id").alias("conversations"))


@query("WITH d AS (SELECT md5(text) k, lang || (doc_id % 3) s FROM documents), u AS (SELECT DISTINCT k, s FROM d) SELECT a.s split_a, b.s split_b, count(*) n, array_to_string(list_sort(list(a.k))[1:10], ',') examples FROM u a JOIN u b ON a.k = b.k AND a.s < b.s GROUP BY ALL")
def q_split_leakage(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(F.md5("text").alias("k"), F.concat("lang", (F.col("doc_id") % 3).cast("string")).alias("s"))
    return R.leakage(rows, "k", "s").withColumn("examples", F.array_join("examples", ","))


@query(BOXES + "SELECT page_id, ann_no, class_id FROM (SELECT *, row_number() OVER (PARTITION BY class_id ORDER BY md5(concat_ws('|', '42', CAST(page_id AS VARCHAR), CAST(ann_no AS VARCHAR))), page_id, ann_no) r FROM gt) WHERE r <= 200")
def q_balanced_subset(spark, sf_dir):
    return R.first_per_group(boxes(spark, sf_dir).select("page_id", "ann_no", "class_id"), ["class_id"], ["page_id", "ann_no"], 200)


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR))), doc_id) r FROM documents) WHERE r <= 5")
def q_stratified_subset(spark, sf_dir):
    return R.first_per_group(read(spark, sf_dir, "documents").select("doc_id", "lang", "source"), ["lang", "source"], ["doc_id"], 5)


@query("SELECT l_returnflag, count(*) n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT 1000) GROUP BY 1")
def q_random_subset(spark, sf_dir):
    picked = read(spark, sf_dir, "orders").select("o_orderkey").orderBy(R.order_hash(42, "o_orderkey"), "o_orderkey").limit(1000)
    return read(spark, sf_dir, "lineitem").join(picked, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) r, count(*) OVER () n FROM orders) WHERE r <= greatest(1, floor(n * 0.03))")
def q_fraction_sample(spark, sf_dir):
    return R.fraction_sample(read(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 0.03)


@query("SELECT o_orderkey FROM (SELECT *, row_number() OVER (ORDER BY md5('7|' || o_orderkey), o_orderkey) r FROM orders WHERE CAST('0x' || md5('7|' || o_orderkey)[1:8] AS BIGINT) < 429496730) WHERE r <= 20")
def q_previews(spark, sf_dir):
    """One row in ten by chance, and the first twenty of them."""
    some = R.chance_sample(read(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 0.1, 7)
    return some.orderBy(R.order_hash(7, "o_orderkey"), "o_orderkey").limit(20)


@query("SELECT p_partkey, CASE WHEN r <= floor(n * 0.9) THEN 'train' WHEN r <= floor(n * 0.9) + floor(n * 0.1) THEN 'val' ELSE 'test' END split FROM (SELECT p_partkey, count(*) OVER () n, row_number() OVER (ORDER BY md5('42|' || p_partkey), p_partkey) r FROM part WHERE p_size % 3 = 0)")
def q_split_png(spark, sf_dir):
    """Only images named .png are split, nine tenths and one."""
    from foliant.sources.files import suffix

    files = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.when(F.col("p_size") % 3 == 0, ".png").otherwise(".jpg")).alias("name"))
    return R.split_rows(files.where(suffix(F.col("name")) == ".png"), ["p_partkey"], [], 42, 0.9, 0.1).select("p_partkey", "split")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') iso, round((epoch_us(ts) - epoch_us((SELECT min(ts) FROM events))) / 1e6, 6) elapsed FROM events")
def q_stamps(spark, sf_dir):
    """Stamps of times, and seconds since the first."""
    e = read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    first = e.agg(F.min("ts").alias("first"))
    return e.crossJoin(F.broadcast(first)).select("event_id", X.stamp(F.col("ts")).alias("stamp"), X.iso_stamp(F.col("ts")).alias("iso"), F.round(X.elapsed(F.col("first"), F.col("ts")), 6).alias("elapsed"))


@query("SELECT type, title, count(*) n FROM (SELECT event_type || '_per_user' AS type, upper(event_type[1]) || event_type[2:] || ' Per User' title FROM events) GROUP BY ALL")
def q_titles(spark, sf_dir):
    kind = F.concat("event_type", F.lit("_per_user"))
    return read(spark, sf_dir, "events").groupBy(kind.alias("type"), X.title(kind).alias("title")).agg(F.count("*").alias("n"))


@query("SELECT p_size id, dense_rank() OVER (ORDER BY p_size) - 1 new_id FROM (SELECT DISTINCT p_size FROM part)")
def q_id_remap(spark, sf_dir):
    return R.dense_ids(read(spark, sf_dir, "part"), "p_size")


@query("SELECT p_brand, p_type, n FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p, p_type) r FROM (SELECT p_brand, p_type, count(*) n, min(p_partkey) p FROM part GROUP BY 1, 2)) WHERE r = 1")
def q_majority_name(spark, sf_dir):
    return R.majority(read(spark, sf_dir, "part"), "p_brand", "p_type", "p_partkey")


@query(BOXES + "SELECT page_id, array_to_string(list(CAST(ann_no AS VARCHAR) ORDER BY y, x, ann_no), ',') reading FROM gt GROUP BY page_id")
def q_reading_order(spark, sf_dir):
    return reading_order(boxes(spark, sf_dir), "page_id", ["y", "x", "ann_no"], "ann_no")


#: The queries of a search: every row whose id is divisible by 100. The SQL holds the search for the first five rows.
SEARCHED, FIRST = "vec_id % 100 = 0", "vec_id < 5"


def _similar(spark, sf_dir, dims, which=SEARCHED):
    v = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_similar(v, v.where(which).select(F.col("vec_id").alias("query_id"), "embedding"), 5, dims).select("query_id", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def _similar_sql(dims: int) -> str:
    v = f"(SELECT vec_id, list_transform(embedding[1:{dims}], lambda x: CAST(x AS DOUBLE)) e FROM embeddings)"
    return f"SELECT query_id, vec_id, round(s, 6) score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) rank FROM (SELECT q.vec_id query_id, v.vec_id, list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))) s FROM {v} q, {v} v WHERE q.vec_id < 5)) WHERE rank <= 5"


@query()
def q_vector_topk(spark, sf_dir):
    return _similar(spark, sf_dir, None)


@query(_similar_sql(64))
def q_vector_topk_first(spark, sf_dir):
    return _similar(spark, sf_dir, None, FIRST)


@query()
def q_vector_topk_truncated(spark, sf_dir):
    return _similar(spark, sf_dir, 32)


@query(_similar_sql(32))
def q_vector_topk_truncated_first(spark, sf_dir):
    return _similar(spark, sf_dir, 32, FIRST)


@query(BOXES + ", n AS (SELECT count(DISTINCT page_id)::DOUBLE n FROM pred), c AS (SELECT page_id, score c, n, (1 - score) / (n - 1) r FROM pred, n), e AS (SELECT *, (c + 1e-8) / (1 + n * 1e-8) p0, (r + 1e-8) / (1 + n * 1e-8) p1 FROM c) SELECT page_id, round(min(CASE WHEN c >= r THEN c - r WHEN n >= 3 THEN 0.0 ELSE r - c END), 6) margin, round(max(-(p0 * ln(p0) + (n - 1) * p1 * ln(p1))), 6) entropy, round(greatest(0.0, 0.5 - min(c)), 6) low_conf FROM e GROUP BY page_id")
def q_uncertainty(spark, sf_dir):
    every = R.uncertainty(predictions(spark, sf_dir), "page_id", "score")
    return every.select("page_id", *(F.round(c, 6).alias(c) for c in ("margin", "entropy", "low_conf")))


@query(BOXES + "SELECT class_id, count(*) n, round(min(score), 9) lo, round(max(score), 9) hi, round(avg(score), 6) mean FROM pred WHERE score >= 0.6 GROUP BY class_id")
def q_pseudo_manifest(spark, sf_dir):
    return predictions(spark, sf_dir).where("score >= 0.6").groupBy("class_id").agg(F.count("*").alias("n"), F.round(F.min("score"), 9).alias("lo"), F.round(F.max("score"), 9).alias("hi"), F.round(F.avg("score"), 6).alias("mean"))


@query("SELECT event_type, cycle, n, n - coalesce(lag(n) OVER (PARTITION BY event_type ORDER BY cycle), 0) delta FROM (SELECT event_type, event_id // 1000 AS cycle, count(*) n FROM events GROUP BY ALL)")
def q_cycle_deltas(spark, sf_dir):
    n = read(spark, sf_dir, "events").groupBy("event_type", F.floor(F.col("event_id") / 1000).alias("cycle")).agg(F.count("*").alias("n"))
    return n.withColumn("delta", F.col("n") - F.coalesce(F.lag("n").over(Window.partitionBy("event_type").orderBy("cycle")), F.lit(0)))


CACHE = "(SELECT event_type || ':' || user_id AS key, CAST(sum(event_id % 1000) AS BIGINT) size_bytes, max(event_id) last_accessed, count(*) access_count FROM events GROUP BY 1)"


def cache(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy(F.concat("event_type", F.lit(":"), F.col("user_id").cast("string")).alias("key")).agg(F.sum(F.col("event_id") % 1000).alias("size_bytes"), F.max("event_id").alias("last_accessed"), F.count("*").alias("access_count"))


@query(f"SELECT key, size_bytes FROM (SELECT *, sum(size_bytes) OVER () t, coalesce(sum(size_bytes) OVER (ORDER BY last_accessed, access_count, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) b FROM {CACHE}) WHERE t > 1000000 AND t - b > 800000")
def q_cache_evict(spark, sf_dir):
    return R.evict(cache(spark, sf_dir), 1_000_000).select("key", "size_bytes")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 10 <> 0 UNION ALL SELECT c_custkey, upper(c_name), c_acctbal FROM customer WHERE c_custkey % 10 = 0")
def q_cache_upsert(spark, sf_dir):
    old = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return R.upsert(old, old.where("c_custkey % 10 = 0").withColumn("c_name", F.upper("c_name")), "c_custkey")


@query("SELECT event_type, count(*) n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) total FROM events GROUP BY 1")
def q_json_props(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", F.from_json("props", "k long")["k"].alias("k"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query(f"""WITH g AS (SELECT source, coalesce(sum(len(regexp_extract_all(text, '{X.PII['email']}'))), 0)::BIGINT n_pii, 100.0 * count_if({RTL_SHARE} / greatest(1, length(text)) > 0.6) / count(*) rtl, bool_or({_any_sql(('license',))}) licensed FROM documents GROUP BY source)
SELECT source, n_pii, round(rtl, 6) rtl, licensed, CASE WHEN n_pii > 0 OR rtl > 20 OR NOT licensed THEN 'NEEDS ATTENTION' ELSE 'READY' END status FROM g""")
def q_quality_status(spark, sf_dir):
    """Sources as datasets: addresses are their critical issues."""
    t = F.col("text")
    docs = read(spark, sf_dir, "documents").select("source", F.size(X.pii_hits(t, ("email",))).alias("n"), (X.direction(t)[0] > 0.6).alias("rtl"), X.has_any(t, ("license",)).alias("licensed"))
    g = docs.groupBy("source").agg(F.sum("n").alias("n_pii"), (100.0 * F.count_if("rtl") / F.count("*")).alias("rtl"), F.bool_or("licensed").alias("licensed"))
    return g.select("source", "n_pii", F.round("rtl", 6).alias("rtl"), "licensed", Q.status(F.col("n_pii"), F.col("rtl"), F.lit(0.0), F.col("licensed")).alias("status"))


def as_words(pairs):
    """Texts of adjacent turns as lower-case words."""
    return pairs.select("conv_id", "turn", X.words(F.lower("text")).alias("a"), X.words(F.lower("other")).alias("b"))


def bleu(pairs):
    return as_words(pairs).select("conv_id", "turn", F.round(X.bleu(F.col("a"), F.col("b")), 6).alias("bleu"))


@query()
def q_wer_pairs(spark, sf_dir):
    return as_words(adjacent(spark, sf_dir)).select("conv_id", "turn", F.round(X.word_error_rate(F.col("a"), F.col("b")), 9).alias("wer"))


def _bleu_sql() -> str:
    words = lambda t: f"regexp_extract_all(lower(coalesce({t}, '')), '{X.WORD}')"
    grams = lambda t, n: f"list_transform(range(1, len({t}) - {n} + 2), lambda i: array_to_string({t}[i:i + {n} - 1], ' '))"
    g = ", ".join(f"{grams(t, n)} {t}{n}" for t in "ab" for n in range(1, 5))
    hits = lambda n: f"coalesce(list_sum(list_transform(list_distinct(b{n}), lambda g: least(len(list_filter(a{n}, lambda x: x = g)), len(list_filter(b{n}, lambda x: x = g))))), 0)"
    log_p = " + ".join(f"0.25 * ln(greatest({hits(n)}::DOUBLE, 0.1) / greatest(1, len(b) - {n - 1}))" for n in range(1, 5))
    return f"WITH p AS (SELECT a.conv_id, a.turn, {words('a.text')} a, {words('b.text')} b FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1), g AS (SELECT *, {g} FROM p) SELECT conv_id, turn, round(CASE WHEN len(a) = 0 OR len(b) = 0 OR NOT list_has_any(a, b) THEN 0.0 ELSE exp({log_p} + least(0.0, 1 - len(a) / len(b))) END, 6) bleu FROM g"


@query(_bleu_sql())
def q_bleu_pairs(spark, sf_dir):
    """All adjacent turns."""
    return bleu(adjacent(spark, sf_dir))


@query(BOXES + "SELECT class_id, count(*) n, sum(abs(round((xc - w1 / 2) * 1000) - x1)) + sum(abs(round((yc - h1 / 2) * 900) - y1)) AS moved FROM (SELECT class_id, x1, y1, (x1 + w / 2) / 1000 xc, (y1 + h / 2) / 900 yc, w / 1000 w1, h / 900 h1 FROM (SELECT *, greatest(0, least(x, 1000 - w)) x1, greatest(0, least(y, 900 - h)) y1 FROM gt)) GROUP BY class_id")
def q_yolo_roundtrip(spark, sf_dir):
    x, y, w, h = G.clip_keeping_size(box(), PAGE_W, PAGE_H)
    bx, by, _, _ = G.from_yolo(G.to_yolo((x, y, w, h), PAGE_W, PAGE_H), PAGE_W, PAGE_H)
    moved = F.abs(F.round(bx) - x) + F.abs(F.round(by) - y)
    return boxes(spark, sf_dir).groupBy("class_id").agg(F.count("*").alias("n"), F.sum(moved).alias("moved"))
