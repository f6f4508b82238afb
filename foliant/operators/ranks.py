"""Ranks and running totals of a whole table without one task for all its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.session import checkpoint


def ordered(rows: DataFrame, order: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """rows with rank (from 1, ascending by `order`, nulls first) and, for each column of `sums`, before_<column>: its
    total over all rows that come earlier (nulls count 0).

    Rows are dealt to ranges and written once, so that each keeps its range; a range's ranks and totals start where the
    ranges before it end, which one row a range tells. Rows that are equal in all of `order` come in any order; name a
    unique column last.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = checkpoint(rows.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()))
    w = Window.partitionBy("__range").orderBy(*order)
    ranges = dealt.groupBy("__range").agg(F.count("*").alias("__n"), *(F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"__{c}") for c in sums))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    ranges = ranges.select("__range", *(F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__{c}") for c in ("n", *sums)))
    inside = w.rowsBetween(Window.unboundedPreceding, -1)
    totals = [(F.col(f"__{c}") + F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0))).over(inside), F.lit(0))).alias(f"before_{c}") for c in sums]
    return dealt.join(F.broadcast(ranges), "__range").select(*rows.columns, (F.col("__n") + F.row_number().over(w)).cast("long").alias("rank"), *totals)
