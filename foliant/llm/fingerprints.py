"""Bottom-k sketches of word shingles, with DataFrame functions only.

A document's sketch is the k smallest distinct hashes of its five-word shingles. Sketches of parts merge into the
sketch of the whole; from two of them come estimates of resemblance, containment and the number of shingles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.shards import free_names

SHINGLE_WORDS = 5
K = 64
#: 2**62: hashes are 62-bit numbers, so sums and products stay exact enough in doubles.
SPAN = 1 << 62


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(words: Column, n: int = SHINGLE_WORDS) -> Column:
    """Hashes of all shingles, repeats included; fewer words are one shingle, none have none. words are the words'
    hashes, as a plain column: what a lambda refers to is evaluated for each element."""
    each = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0))), lambda i: F.shiftrightunsigned(F.xxhash64(*(F.get(words, i + j) for j in range(n))), 2))
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(each)


def add_sketch(df: DataFrame, text: Column, name: str, k: int = K) -> DataFrame:
    """df with the k smallest distinct shingle hashes of text, ascending. Only hashes below four times the expected
    k-th are sorted, unless too few of those are distinct. Each step is its own column, so it is computed once."""
    df = df.withColumn("__words", F.transform(words_of(text), lambda w: F.xxhash64(w)))
    df = df.withColumn("__all", shingle_hashes(F.col("__words")))
    df = df.withColumn("__below", F.lit(4.0 * k * SPAN) / F.greatest(F.size("__all"), F.lit(1)))
    df = df.withColumn("__few", F.filter("__all", lambda h: h < F.col("__below")))
    df = df.withColumn("__few", F.array_sort(F.array_distinct("__few")))
    enough = (F.size("__few") >= k) | (F.size("__all") <= 4 * k)
    df = df.withColumn(name, F.slice(F.when(enough, F.col("__few")).otherwise(F.array_sort(F.array_distinct("__all"))), 1, k))
    return df.drop("__words", "__all", "__below", "__few")


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Exact below k; otherwise (k - 1) / the k-th smallest hash as a fraction of the span."""
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) * F.lit(float(SPAN)) / F.element_at(s, -1))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; 1 for two empty sketches, 0 if one is empty."""
    union = merge(a, b, k)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.greatest(F.size(union), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated part of a's shingles that b has; 1 for an empty a."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(s: Column) -> Column:
    """A sketch as a string: its hashes in hexadecimal, joined by commas."""
    return F.array_join(F.transform(s, lambda h: F.hex(h)), ",")


def fingerprint_documents(docs: DataFrame, text_col: str = "text", k: int = K) -> DataFrame:
    """Every column of docs, with sketch and n_shingles (estimated). Null and empty texts have an empty sketch and 0;
    texts of fewer than five words are one shingle, long ones are whole, equal ones have equal sketches. Rows are taken
    one by one, repeated or not; an empty table gives no rows. Input columns named as a result get the suffix _in."""
    docs = free_names(docs, "sketch", "n_shingles")
    return add_sketch(docs, F.col(text_col), "sketch", k).withColumn("n_shingles", distinct_shingles(F.col("sketch"), k))


def merged_sketch(sketches: DataFrame, by: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """The sketch of each group's union: hashes that are among the k smallest of the group. Distinct hashes of a group
    are ranked as counts, never gathered: an aggregate keeps k of them."""
    hashes = sketches.select(*by, F.explode(sketch).alias("__h")).distinct()
    ranked = hashes.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy("__h"))).where(F.col("__r") <= k)
    return ranked.groupBy(*by).agg(F.array_sort(F.collect_list("__h")).alias(sketch))


#: Cells of about equally many rows that ids are dealt to; where a cell's codes begin, and those of its ordinary ranges.
CELLS, CELL_BITS, PLAIN = 1024, 42, 1 << 21


def range_codes(docs: DataFrame, id_col: str, order: str, rows_a_range: int) -> DataFrame:
    """docs with __range, ascending in (id, order) with null ids first: ranges of about rows_a_range rows.

    Quantiles of the ids part them into cells, and a cell is cut evenly, so ids may lie as unevenly as they like. Ids
    that fill a cell and more, and null ids, are cut by `order`, a column of even 63-bit numbers. The driver gets a
    number a cell.
    """
    key = F.col(id_col).cast("long")
    n, low, high, cuts = docs.agg(F.count("*"), F.min(key), F.max(key), F.percentile_approx(key, [i / CELLS for i in range(1, CELLS)], F.lit(20 * CELLS))).first()
    low, high, cuts = low or 0, high or 0, cuts or []
    heavy = sorted({x for x, y in zip(cuts[:-1], cuts[1:], strict=True) if x == y})
    edges = sorted({low, *cuts})
    size = 1 << len(edges).bit_length()
    padded = F.array(*(F.lit(x).cast("long") for x in (*edges, *[high + 1] * (size - len(edges)))))
    steps = F.array(*(F.lit(size >> i) for i in range(1, size.bit_length())))
    cell = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step < len(edges)) & (F.get(padded, at + step) <= key), at + step).otherwise(at))
    cuts_a_cell = max(1, -(-n // (CELLS * rows_a_range)))
    bits = min(20, max(0, (n // rows_a_range).bit_length()))
    docs = docs.withColumn("__cell", cell)
    start, stop = F.get(padded, F.col("__cell")), F.get(padded, F.col("__cell") + 1)
    even = F.least(F.lit(cuts_a_cell - 1), F.floor((key - start).cast("double") / (stop - start) * cuts_a_cell)).cast("long") + PLAIN
    hashed = F.shiftright(F.col(order), 63 - bits).cast("long")
    inside = F.when(key.isNull() | (key.isin(heavy) if heavy else F.lit(False)), hashed).otherwise(even)
    above = F.when(key.isNull(), 0).otherwise(F.col("__cell") + 1).cast("long")
    return docs.withColumn("__range", F.shiftleft(above, CELL_BITS) + inside).drop("__cell")


def with_next(docs: DataFrame, id_col: str, text_col: str, derive: Callable[[DataFrame], DataFrame] = lambda d: d, also: tuple[str, ...] = (), rows_a_range: int = 512) -> DataFrame:
    """derive(docs) with next_<column> for text_col and the columns in also, which derive adds from text_col: values of
    the row of next larger id (after the last: the first). A null text is empty there.

    Null ids come first; rows of equal ids are ordered by xxhash64 of their text without its lowest bit, then by text.
    Neighbours meet within a range of range_codes; only each range's first row is looked up from the range before it;
    what derive adds is computed for it anew, so that finding it reads ids and texts only. Long texts are whole, equal
    rows follow each other, one row follows itself, and an empty table gives no rows. Input columns named as a result
    get the suffix _in.
    """
    docs = free_names(docs, *(f"next_{c}" for c in (text_col, *also)))
    docs = range_codes(docs.withColumn("__h", F.shiftrightunsigned(F.xxhash64(F.coalesce(text_col, F.lit(""))), 1)), id_col, "__h", rows_a_range)
    order = [F.col(id_col).asc_nulls_first(), F.col("__h"), F.col(text_col).asc_nulls_first()]
    row = F.struct(F.coalesce(id_col, F.lit(0)).alias("a"), "__h", F.coalesce(text_col, F.lit("")).alias(text_col))
    firsts = derive(docs.groupBy("__range").agg(F.min(row).alias("__first")).select("__range", F.col("__first")[text_col].alias(text_col)))
    firsts = firsts.select(F.col("__range").alias("__next"), *(F.col(c).alias(f"__first_{c}") for c in (text_col, *also)))
    cell = F.shiftright("__range", CELL_BITS)
    ranges = docs.select("__range").distinct().withColumn("__cell", cell)
    cells = ranges.groupBy("__cell").agg(F.min("__range").alias("__r"))  # at most CELLS + 1 rows
    after = cells.select("__cell", F.coalesce(F.lead("__r").over(Window.orderBy("__cell")), F.min("__r").over(Window.partitionBy())).alias("__after"))
    ends = ranges.withColumn("__next", F.lead("__range").over(Window.partitionBy("__cell").orderBy("__range"))).join(F.broadcast(after), "__cell")
    heads = ends.select("__range", F.coalesce("__next", "__after").alias("__next")).join(firsts, "__next").drop("__next")
    full = derive(docs)
    w = Window.partitionBy("__range").orderBy(*order)
    inner = full.withColumns({"__more": F.lead(F.lit(True)).over(w)} | {f"__lead_{c}": F.lead(c).over(w) for c in (text_col, *also)})
    following = {c: F.when(F.col("__more"), F.col(f"__lead_{c}")).otherwise(F.col(f"__first_{c}")) for c in (text_col, *also)}
    following[text_col] = F.coalesce(following[text_col], F.lit(""))
    return inner.join(heads, "__range").select(*[c for c in full.columns if c not in ("__range", "__h")], *(f.alias(f"next_{c}") for c, f in following.items()))


def edited_text(text: Column, following: Column) -> Column:
    """text with its last quarter of code points replaced by the first as many of the other text, or all of it."""
    text, following = F.coalesce(text, F.lit("")), F.coalesce(following, F.lit(""))
    cut = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(following, F.lit(1), cut))
