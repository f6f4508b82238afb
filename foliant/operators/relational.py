"""Joins, aggregates, windows, splits and samples over annotation, label and cache tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.operators.ranks import ordered


def order_hash(seed: int | str, *keys: str) -> Column:
    """Seeded order that any engine with MD5 reproduces."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def class_balance(rows: DataFrame, class_col: str, declared: DataFrame, rare: float = 5.0) -> DataFrame:
    """(class, n, pct, rare) for every declared class; declared has one column, class."""
    counted = rows.groupBy(F.col(class_col).alias("class")).agg(F.count("*").alias("n"))
    out = declared.join(counted, "class", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    total = F.sum("n").over(Window.partitionBy())
    return out.withColumn("pct", F.coalesce(F.try_divide(F.lit(100.0) * F.col("n"), total), F.lit(0.0))).withColumn("rare", F.col("pct") < rare)


def dense_ids(rows: DataFrame, id_col: str) -> DataFrame:
    """(id, new_id): distinct ids, from 0 in ascending order."""
    return ordered(rows.select(F.col(id_col).alias("id")).distinct(), ["id"]).select("id", (F.col("rank") - 1).alias("new_id"))


def majority(rows: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """Commonest value of each key; the earliest of equals."""
    n = rows.groupBy(key, value).agg(F.count("*").alias("n"), F.min(position).alias("p"))
    best = n.groupBy(key).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), F.col("p"), F.col(value))).alias("b"))
    return best.select(key, F.col(f"b.{value}").alias(value), F.col("b.n").alias("n"))


def confusion(rows: DataFrame, truth: str, guess: str) -> DataFrame:
    return rows.groupBy(truth, guess).agg(F.count("*").alias("n"))


def per_label(rows: DataFrame, truth: str, guess: str) -> DataFrame:
    """tp, fp, fn, support, precision, recall, f1 of every label seen on either side; 0 where undefined. One pass."""
    each = rows.select(F.explode(F.array(F.struct(F.col(truth).alias("label"), F.lit(True).alias("t"), (F.col(truth) == F.col(guess)).alias("hit")), F.struct(F.col(guess).alias("label"), F.lit(False).alias("t"), (F.col(truth) == F.col(guess)).alias("hit")))).alias("e")).select("e.*")
    g = each.groupBy("label").agg(F.count_if(F.col("t") & F.col("hit")).alias("tp"), F.count_if(~F.col("t") & ~F.col("hit")).alias("fp"), F.count_if(F.col("t") & ~F.col("hit")).alias("fn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return g.select("*", (F.col("tp") + F.col("fn")).alias("support"), p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1"))


def ece(rows: DataFrame, confidence: str, correct: str, bins: int = 10) -> DataFrame:
    """Expected calibration error over bins (lo, hi]; confidence 0 falls in none but counts."""
    b = F.ceil(F.col(confidence) * bins)
    per = rows.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(confidence).alias("conf"), F.avg(F.col(correct).cast("double")).alias("acc"))
    return per.agg((F.sum(F.when(F.col("bin") >= 1, F.abs(F.col("conf") - F.col("acc")) * F.col("n")).otherwise(0.0)) / F.sum("n")).alias("ece"), F.sum("n").alias("n"))


def best_temperature(rows: DataFrame, confidence: str, correct: str, grid: int = 100) -> DataFrame:
    """Temperature of least log loss on a logarithmic grid from .01 to 100. Equal rows are counted before each meets the
    grid, a constant-size array."""
    eps = 1e-8
    c = F.greatest(F.lit(eps), F.least(F.col(confidence), F.lit(1 - eps)))
    logit = F.ln(c / (1 - c + eps))
    counted = rows.groupBy(logit.alias("z"), F.col(correct).cast("int").alias("y")).agg(F.count("*").alias("n"))
    each = counted.select("z", "y", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda i: F.pow(F.lit(10.0), F.lit(-2.0) + i * (4.0 / (grid - 1))))).alias("k", "t"))
    p = F.greatest(F.lit(eps), F.least(1 / (1 + F.exp(-F.col("z") / F.col("t"))), F.lit(1 - eps)))
    loss = -(F.col("y") * F.ln(p) + (1 - F.col("y")) * F.ln(1 - p))
    return each.groupBy("k", "t").agg((F.sum(F.col("n") * loss) / F.sum("n")).alias("nll")).orderBy("nll", "k").limit(1)


def seeded_ranks(rows: DataFrame, keys: list[str], strata: list[str], seed: int = 42) -> DataFrame:
    """rows with __r, the rank from 1 in seeded order of keys in their stratum (without strata: in all), and __all, the
    stratum's rows; null strata are "unknown". A rank is the offset of a bin of the order and the rank in the bin, so no
    task sorts a whole stratum."""
    names = [f"__s{i}" for i in range(len(strata))]
    rows = rows.select("*", *(F.coalesce(F.col(s).cast("string"), F.lit("unknown")).alias(n) for s, n in zip(strata, names, strict=True)), order_hash(seed, *keys).alias("__h")).withColumn("__b", F.substring("__h", 1, 3))
    sizes = rows.groupBy(*names, "__b").agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*names)  # at most 4,096 rows a stratum
    sizes = sizes.withColumn("__before", F.sum("__n").over(w.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).withColumn("__all", F.sum("__n").over(w))
    out = rows.join(sizes, [*names, "__b"]).withColumn("__r", F.col("__before") + F.row_number().over(Window.partitionBy(*names, "__b").orderBy("__h", *keys)))
    return out.drop(*names, "__h", "__b", "__n", "__before")


def split_rows(rows: DataFrame, keys: list[str], strata: list[str] = [], seed: int = 42, train: float = 0.8, val: float = 0.1) -> DataFrame:  # noqa: B006
    """rows with split: train, val and test of exact sizes in each stratum (without strata: in all), in seeded order of
    keys; null strata are "unknown", and strata of fewer than 3 go to train."""
    out = seeded_ranks(rows, keys, strata, seed)
    a, b = F.floor(F.col("__all") * train), F.floor(F.col("__all") * train) + F.floor(F.col("__all") * val)
    return out.withColumn("split", F.when((F.col("__r") <= a) | (F.lit(bool(strata)) & (F.col("__all") < 3)), "train").when(F.col("__r") <= b, "val").otherwise("test")).drop("__all", "__r")


def fraction_sample(rows: DataFrame, keys: list[str], rate: float, seed: int = 42) -> DataFrame:
    """The first rows in seeded order: as many as the rate says, fractions cut off, but one at least."""
    return seeded_ranks(rows, keys, [], seed).where(F.col("__r") <= F.greatest(F.lit(1), F.floor(F.col("__all") * rate))).drop("__r", "__all")


def chance_sample(rows: DataFrame, keys: list[str], rate: float, seed: int = 42) -> DataFrame:
    """Each row by chance, at the rate; the same rows in every run. Nothing is shuffled."""
    return rows.where(F.conv(F.substring(order_hash(seed, *keys), 1, 8), 16, 10).cast("long") < round(rate * (1 << 32)))


def split_proportions(train: float, val: float, test: float) -> None:
    """Raises unless the three add up to one."""
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError(f"split proportions add up to {train + val + test}, not 1")


def first_per_group(rows: DataFrame, groups: list[str], keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """At most n rows of each group in seeded order."""
    w = Window.partitionBy(*groups).orderBy(order_hash(seed, *keys), *keys)
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def leakage(rows: DataFrame, key: str, split: str, examples: int = 10) -> DataFrame:
    """(split_a, split_b, n, examples): keys that two splits share, and the smallest of them; one aggregate, no self join."""
    sets = rows.groupBy(key).agg(F.sort_array(F.collect_set(split)).alias("s")).where(F.size("s") > 1)
    pairs = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("split_a"), b.alias("split_b")))))
    each = sets.select(key, F.explode(pairs).alias("p")).select(key, "p.*")
    first = each.withColumn("r", F.row_number().over(Window.partitionBy("split_a", "split_b").orderBy(key))).where(F.col("r") <= examples)
    kept = first.groupBy("split_a", "split_b").agg(F.sort_array(F.collect_list(key)).alias("examples"))
    return each.groupBy("split_a", "split_b").agg(F.count("*").alias("n")).join(kept, ["split_a", "split_b"])


def evict(cache: DataFrame, most: float, keep: float = 0.8) -> DataFrame:
    """Rows that an LRU cache over its limit drops: oldest first, until what remains is at most keep * most."""
    total = cache.agg(F.sum("size_bytes").alias("__t"))
    out = ordered(cache, ["last_accessed", "access_count", "key"], ("size_bytes",)).crossJoin(F.broadcast(total))  # one row
    return out.where((F.col("__t") > most) & (F.col("__t") - F.col("before_size_bytes") > keep * most)).select(*cache.columns)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new replace those of old with their key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def uncertainty_of(c: Column, n: Column) -> tuple[Column, Column]:
    """(margin, entropy) of a prediction of confidence c, in closed form: 1 - c is spread evenly over n - 1 others, n
    being the number of images with predictions. Null with one image."""
    r = F.try_divide(1 - c, n - 1)
    margin = F.when(c >= r, c - r).when(n >= 3, 0.0).otherwise(r - c)
    eps = F.lit(1e-8)
    p0, p1 = (c + eps) / (1 + n * eps), (r + eps) / (1 + n * eps)
    return margin, -(p0 * F.ln(p0) + (n - 1) * p1 * F.ln(p1))


def uncertainty(pred: DataFrame, image: str, score: str, threshold: float = 0.5) -> DataFrame:
    """margin (least), entropy (largest) and low_conf of each image from its predictions' confidences."""
    n = pred.agg(F.count_distinct(image).cast("double").alias("__n"))
    margin, entropy = uncertainty_of(F.col(score), F.col("__n"))
    return pred.crossJoin(F.broadcast(n)).groupBy(image).agg(F.min(margin).alias("margin"), F.max(entropy).alias("entropy"), F.greatest(F.lit(0.0), threshold - F.min(score)).alias("low_conf"))  # one row
