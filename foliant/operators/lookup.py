"""Lookup of names by a part of them: an inverted index of grams instead of asking every name for every part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names, and parts, of one gram that one task takes.
A_TASK = 4096


def grams(text: Column, q: int) -> Column:
    """The different runs of q characters of a text; none of shorter texts."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - (q - 1), F.lit(1)))
    return F.when(F.length(text) >= q, F.array_distinct(F.transform(at, lambda i: F.substring(text, i, F.lit(q))))).otherwise(F.array().cast("array<string>"))


def holders(parts: DataFrame, names: DataFrame, q: int = 4) -> DataFrame:
    """(part, name): each different part that is not null, and the smallest name that holds it, null where none does.
    Either table's first column counts; case counts; the empty part is in every name.

    A part shorter than q is one of the grams of its length, and an aggregate over those answers it. Of a longer part the
    gram that the fewest names have is looked up, and the names that have it are asked for the whole part; a gram that no
    name has ends the search. A gram of many names or parts is dealt over several tasks.
    """
    n = names.select(F.col(f"`{names.columns[0]}`").cast("string").alias("name")).where("name is not null").distinct()
    p = parts.select(F.col(f"`{parts.columns[0]}`").cast("string").alias("part")).where("part is not null").distinct()
    sizes = sorted(r[0] for r in p.where(F.length("part") < q).select(F.length("part")).distinct().collect())  # fewer than q
    found = n.agg(F.min("name").alias("name")).select(F.lit("").alias("part"), "name").where("name is not null")
    short = [s for s in sizes if s]
    if short:
        held = n.select("name", F.explode(F.flatten(F.array(*(grams(F.col("name"), s) for s in short)))).alias("part"))
        found = found.unionByName(held.groupBy("part").agg(F.min("name").alias("name")))
    index = n.select("name", F.explode(grams(F.col("name"), q)).alias("gram"))
    known = index.groupBy("gram").agg(F.count("*").alias("n_names"))
    asked = p.where(F.length("part") >= q).select("part", F.explode(grams(F.col("part"), q)).alias("gram"))
    rarest = asked.join(known, "gram", "left").groupBy("part").agg(F.min(F.struct("n_names", "gram")).alias("r"), F.bool_and(F.col("n_names").isNotNull()).alias("all"))
    chosen = rarest.where("all").select("part", "r.gram", F.ceil(F.col("r.n_names") / A_TASK).alias("name_tasks"))
    tasks = chosen.groupBy("gram").agg(F.max("name_tasks").alias("name_tasks"), F.ceil(F.count("*") / A_TASK).alias("part_tasks"))
    each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    dealt = lambda c, k: F.pmod(F.xxhash64(c), F.col(k))
    asks = chosen.drop("name_tasks").join(tasks, "gram").withColumn("i", dealt("part", "part_tasks")).withColumn("j", each("name_tasks")).select("part", "gram", "i", "j")
    answers = index.join(tasks, "gram").withColumn("j", dealt("name", "name_tasks")).withColumn("i", each("part_tasks")).select("name", "gram", "i", "j")
    met = asks.join(answers, ["gram", "i", "j"]).where(F.contains("name", "part")).groupBy("part").agg(F.min("name").alias("name"))
    return p.join(found.unionByName(met), "part", "left")
