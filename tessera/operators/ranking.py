"""Ranks over a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """1, 2, ... in ``order`` over all rows.

    Rows are dealt out by ranges of the order and ranked within a part; only the
    parts' counts meet in one task. ``order`` should have no ties, else tied
    rows take their ranks in any order.
    """
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    within = parts.withColumn("_within", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("_part").alias("_p"), before.alias("_before"))
    return within.join(offsets, F.col("_part") == F.col("_p")).withColumn(name, F.col("_within") + F.col("_before")).drop("_part", "_p", "_within", "_before")


def halves(df: DataFrame, order: list[Column], name: str = "half") -> DataFrame:
    """1 for the first floor(n/2) rows in ``order``, 2 for the rest."""
    total = df.agg(F.count("*").alias("_total"))
    ranked = global_rank(df, order, "_rank").crossJoin(F.broadcast(total))  # one row
    return ranked.withColumn(name, F.when(F.col("_rank") <= F.floor(F.col("_total") / 2), 1).otherwise(2)).drop("_rank", "_total")


def group_rank(df: DataFrame, by: list[str], order: list[Column], name: str = "rank", size: str = "group_size") -> DataFrame:
    """1, 2, ... in ``order`` within each group, and the group's size; a group of any size is spread over tasks."""
    ranked = global_rank(df, [F.col(c) for c in by] + order, "_rank")
    sizes = df.groupBy(*by).agg(F.count("*").alias(size))
    same = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in by]
    before = F.coalesce(F.sum(size).over(Window.orderBy(*[F.col(f"_{c}") for c in by]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(*[F.col(c).alias(f"_{c}") for c in by], size).withColumn("_start", before)
    on = same[0]
    for s in same[1:]:
        on = on & s
    return ranked.join(starts, on).withColumn(name, F.col("_rank") - F.col("_start")).drop("_rank", "_start", *[f"_{c}" for c in by])
