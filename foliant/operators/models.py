"""Where models plug in: work on pages with errors as data, and stand-ins that need no model.

A model is a Python function on a batch; what fails is a row with the reason, never a failed job. The stand-ins read a
page's markup, so that the stages behind a detector and an OCR engine can be run and tested without either.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as X
from foliant.operators.documents import gated_language, without_prefix

#: What a description model is asked.
PROMPTS = {
    "Table": "Describe this table briefly: what variables, units, and notable values/patterns appear? Focus on the structure, column headers, and key data points.",
    "Figure": "Describe this image. If it is a chart/map/diagram, summarize axes, trends, and key takeaways. Keep the description concise and informative.",
}
#: Tags that are blocks, and the class of each.
TAGS = {"h1": "Title", "h2": "Title", "h3": "Title", "p": "Text", "li": "List", "table": "Table", "figure": "Figure"}
LINE_HEIGHT, PAGE_WIDTH, LINE_CHARS = 20, 1000, 100
#: Commonest words of a few languages.
COMMON = {"en": ("the", "of", "and", "to", "is", "in", "that"), "fr": ("le", "la", "de", "et", "les", "des", "que"), "de": ("der", "die", "und", "das", "ist", "nicht", "ein"), "es": ("el", "de", "la", "que", "y", "los", "en")}


def map_rows(rows: DataFrame, work: Callable[[dict], dict], key: str, result: str, workers: int | None = None, setup: Callable[[], object] | None = None) -> DataFrame:
    """(key, success, error, processing_time, then the fields of `result`, a DDL schema) of work(row) on every row; with
    setup, work(row, model) and setup() runs once a task. A row that raises has success false, the error's text and null
    fields. Rows come back in any order. workers: partitions to deal the rows to."""
    fields = T.DataType.fromDDL(result).fields
    head = [rows.schema[key], *T.DataType.fromDDL("success boolean, error string, processing_time double").fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = setup() if setup else None
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                at = time.perf_counter()
                try:
                    got = work(row, model) if setup else work(row)
                    out.append((row[key], True, None, time.perf_counter() - at, *(got.get(f.name) for f in fields)))
                except Exception as e:  # noqa: BLE001  an error is data here
                    out.append((row[key], False, f"{type(e).__name__}: {e}", time.perf_counter() - at, *(None for _ in fields)))
            yield pd.DataFrame(out, columns=[f.name for f in [*head, *fields]])

    return (rows.repartition(workers) if workers else rows).mapInPandas(run, T.StructType([*head, *fields]))


def map_groups(rows: DataFrame, work: Callable[[pd.DataFrame], list[dict]], group: str, result: str) -> DataFrame:
    """map_rows for whole groups, such as the crops of a page: work(rows of a group) gives a list of results. A group
    that raises is one row with success false."""
    fields = T.DataType.fromDDL(result).fields
    head = [rows.schema[group], *T.DataType.fromDDL("success boolean, error string").fields]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf[group].iloc[0]
        try:
            out = [(key, True, None, *(r.get(f.name) for f in fields)) for r in work(pdf)]
        except Exception as e:  # noqa: BLE001
            out = [(key, False, f"{type(e).__name__}: {e}", *(None for _ in fields))]
        return pd.DataFrame(out, columns=[f.name for f in [*head, *fields]])

    return rows.groupBy(group).applyInPandas(run, T.StructType([*head, *fields]))


def markup_blocks(pages: DataFrame, page: str = "page_id", markup: str = "html") -> DataFrame:
    """(page, elem_pos, class, x, y, w, h, content, score): a detector's and OCR engine's stand-in. Every block tag is a
    box under the one before, a line high for each 100 characters of its text; tables and figures have no text of their
    own. Null and blockless pages have no rows."""
    names = "|".join(TAGS)
    found = F.regexp_extract_all(F.col(markup), F.lit(f"(?s)<({names})(?: [^>]*)?>(.*?)</(?:{names})>"), F.lit(0))
    tag = F.regexp_extract("b", f"^<({names})", 1)
    plain = X.strip(F.regexp_replace(F.regexp_replace(F.regexp_replace("b", "(?s)<[^>]*>", " "), "&amp;", "&"), f"[{X.SPACES}]+", " "))
    kind = F.create_map(*(F.lit(x) for kv in TAGS.items() for x in kv))[F.col("tag")]
    each = pages.select(page, F.posexplode(found).alias("elem_pos", "b")).select(page, "elem_pos", tag.alias("tag"), plain.alias("plain"))
    rows = each.select(page, "elem_pos", kind.alias("class"), F.length("plain").alias("n"), F.when(~F.col("tag").isin("table", "figure"), F.nullif("plain", F.lit(""))).alias("content"))
    tall = rows.withColumn("h", ((F.floor(F.col("n") / LINE_CHARS) + 1) * LINE_HEIGHT).cast("int"))
    return tall.select(page, "elem_pos", "class", F.lit(0).alias("x"), (F.col("elem_pos") * 2 * LINE_HEIGHT).cast("int").alias("y"), F.least(F.lit(PAGE_WIDTH), F.greatest(F.lit(1), F.col("n") * 10)).cast("int").alias("w"), "h", "content", F.lit(1.0).alias("score"))


def language_of(text: Column) -> tuple[Column, Column]:
    """(language, confidence): the language with most of its commonest words in a text, by number and then by name, and
    its share of all such words; gated as OCR output is. Stand-in for a language model."""
    common = sorted({w for v in COMMON.values() for w in v}, key=lambda w: (-len(w), w))
    # whole words, closing marks aside, that are common in a language; a text is searched once
    found = F.regexp_extract_all(F.lower(X.blank(text)), F.lit(f"(?<![^{X.SPACES}])({'|'.join(common)})(?=[.,;:!?]*(?![^{X.SPACES}]))"), F.lit(1))

    def judged(n: Column) -> Column:
        total = sum((n[k] for k in sorted(COMMON)), F.lit(0))
        best = F.array_max(F.array(*(F.struct(n[k].alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("lang")) for i, k in enumerate(sorted(COMMON)))))
        sure = F.coalesce(F.try_divide(best["n"].cast("double"), total), F.lit(0.0))
        return X.let(F.struct(best["lang"].alias("lang"), sure.alias("sure")), lambda g: F.struct(gated_language(text, g["lang"], g["sure"]).alias("language"), g["sure"].alias("sure")))

    counts = X.let(found, lambda ws: F.struct(*(F.size(F.filter(ws, _among(v))).alias(k) for k, v in sorted(COMMON.items()))))
    both = X.let(counts, judged)
    return both["language"], both["sure"]


def _among(words: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda w: w.isin(*words)


def described(elements: DataFrame, describe: Callable[[pd.Series, pd.Series], pd.Series], batch: int = 2) -> DataFrame:
    """Tables and figures with what a model says of them as content. describe(prompts, ids) gives texts; an echoed prompt
    is cut off, and an empty answer is null. The model sees `batch` elements at a time."""

    @F.pandas_udf("string")
    def run(prompts: pd.Series, ids: pd.Series) -> pd.Series:
        parts = [describe(prompts[i : i + batch], ids[i : i + batch]) for i in range(0, len(prompts), batch)]
        return pd.concat(parts, ignore_index=True) if parts else pd.Series([], dtype=str)

    prompt = F.create_map(*(F.lit(x) for kv in PROMPTS.items() for x in kv))[F.col("class")]
    answer = run(prompt, F.col("elem_pos").cast("string"))
    clean = F.lit(None).cast("string")
    for kind, p in PROMPTS.items():
        clean = F.when(F.col("class") == kind, F.nullif(without_prefix(F.col("__a"), p), F.lit(""))).otherwise(clean)
    return elements.withColumn("__a", answer).withColumn("content", clean).drop("__a")


def cosines(n: int) -> np.ndarray:
    """The matrix of the cosine transform of n numbers."""
    k, i = np.meshgrid(np.arange(n), np.arange(n), indexing="ij")
    return np.cos(np.pi * k * (2 * i + 1) / (2 * n))


def perceptual_hash(pixels: np.ndarray) -> int:
    """64 bits of a 32 x 32 grey image: which of its lowest 8 x 8 frequencies are over their median."""
    c = cosines(32)[:8]
    low = (c @ pixels.reshape(32, 32).astype(float) @ c.T).ravel()
    bits = low > np.median(low)
    return int(np.packbits(bits).view(">i8")[0])


@F.pandas_udf(T.LongType())
def image_hash(pixels: pd.Series) -> pd.Series:
    """perceptual_hash of arrays of 1,024 grey values; null for anything else."""
    return pd.Series([perceptual_hash(np.asarray(p)) if p is not None and len(p) == 1024 else None for p in pixels], dtype="Int64")
