"""Connected components of links, by alternating large and small stars; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.shards import checkpoint, n_parts

#: Links of a node that one task takes, whatever the partitions.
LEAST_SPLIT = 128


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (columns a, b: comparable, not null), root the smallest node that the
    links reach. Loops and repeated links change nothing; an empty table gives no rows. A root's own row is left out.

    Each round links nodes to the smallest of their neighbours; the number of rounds grows with the logarithm of the
    longest path. Every round is checkpointed, so a lost executor costs at most one. Nodes with more links than a
    quarter of a partition's share, of which there are a few a partition, have their links dealt over several tasks.
    """
    e = checkpoint(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    parts, state = n_parts(links), (e.count(), None)
    while True:
        most = max(LEAST_SPLIT, state[0] // (2 * parts))
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.ceil(F.count("*") / most).alias("k")).select("u", F.least("u", "m").alias("m"), "k")
        stars = F.broadcast(least.where("k > 1").select("u", "k"))  # at most 4 a partition
        dealt = both.join(stars, "u", "left").select("u", "v", F.coalesce(F.pmod(F.xxhash64("v"), F.col("k")), F.lit(0)).alias("s"))
        copies = least.select("u", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("s"))
        large = dealt.join(copies, ["u", "s"]).where("v > u and v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = checkpoint(small.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == state:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        state = now
