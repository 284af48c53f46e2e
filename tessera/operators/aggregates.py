"""Distributions, trends and shapes of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABELS = ("positif", "neutre", "negatif")


def percent(part: Column, total: Column, digits: int = 1) -> Column:
    """100 * part / total, 0 where the total is 0."""
    return F.round(F.coalesce(F.try_divide(part * F.lit(100.0), total), F.lit(0.0)), digits)


def label_stats(df: DataFrame, by: list[str], labels: tuple[str, ...] = LABELS, label_col: str = "label", digits: int = 1) -> DataFrame:
    """Total, and count and percentage of each label, for each group; one pass and one shuffle of counts."""
    counts = [F.count_if(F.col(label_col) == x).alias(x) for x in labels]
    out = df.groupBy(*by).agg(F.count("*").alias("total"), *counts)
    return out.select(*by, "total", *labels, *[percent(F.col(x), F.col("total"), digits).alias(f"pct_{x}") for x in labels])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts of the values that are not null."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))


def distribution(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows, mean, median, least and greatest value of each group."""
    v = F.col(value)
    return df.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.percentile(v, F.lit(0.5)).alias("median"), F.min(v).alias("least"), F.max(v).alias("greatest"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, by: list[str]) -> DataFrame:
    """Counts in ``bins`` equal intervals of [low, high); bin 0 is below and bins + 1 from ``high`` on."""
    return df.groupBy(*by, F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))


def buckets(value: Column, edges: list[float]) -> Column:
    """The name 'a-b' of the half-open interval [a, b) that holds the value; null outside all."""
    out = F.lit(None).cast("string")
    for a, b in zip(edges, edges[1:], strict=False):
        out = F.when((value >= a) & (value < b), F.lit(f"{a:g}-{b:g}")).otherwise(out)
    return out


def crosstab(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Counts with one column for each of ``values``, 0 where there are none."""
    return df.groupBy(row).agg(*[F.count_if(F.col(col) == v).alias(str(v)) for v in values])


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group, with ``rank``; Spark keeps k rows a group before it shuffles."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def variation(df: DataFrame, ts: str, as_of: Column, days: int, by: list[str]) -> DataFrame:
    """Rows of the last ``days`` and of as many before, their difference, and it in percent (100 where there were none before)."""
    new = F.count_if((F.col(ts) >= as_of - F.expr(f"interval {days} days")) & (F.col(ts) < as_of))
    old = F.count_if((F.col(ts) >= as_of - F.expr(f"interval {2 * days} days")) & (F.col(ts) < as_of - F.expr(f"interval {days} days")))
    out = df.where((F.col(ts) >= as_of - F.expr(f"interval {2 * days} days")) & (F.col(ts) < as_of)).groupBy(*by).agg(new.alias("new"), old.alias("previous"))
    change = F.when((F.col("previous") == 0) & (F.col("new") > 0), F.lit(100.0)).when(F.col("previous") == 0, F.lit(0.0)).otherwise(F.round((F.col("new") - F.col("previous")) * 100.0 / F.col("previous"), 1))
    return out.select(*by, "new", "previous", (F.col("new") - F.col("previous")).alias("difference"), change.alias("pct_change"))


def recent(df: DataFrame, ts: str, as_of: Column, hours: dict[str, int]) -> DataFrame:
    """One row: how many rows lie within each number of hours before ``as_of``."""
    return df.agg(*[F.count_if((F.col(ts) >= as_of - F.expr(f"interval {h} hours")) & (F.col(ts) <= as_of)).alias(k) for k, h in hours.items()])


def first_nonempty(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The first value of each group, in order, that is not null, empty, ``nan`` or ``[]``; null where there is none."""
    c = F.col(value)
    good = c.isNotNull() & ~F.lower(F.trim(c.cast("string"))).isin("", "nan", "[]")
    return df.groupBy(*keys).agg(F.min(F.when(good, F.struct(*order, value)))[value].alias(value))


def sum_check(groups: DataFrame, count: str, rows: DataFrame) -> DataFrame:
    """One row (total, rows, ok): whether the groups' counts add up to the rows they were made of."""
    return groups.agg(F.coalesce(F.sum(count), F.lit(0)).alias("total")).crossJoin(rows.agg(F.count("*").alias("rows"))).withColumn("ok", F.col("total") == F.col("rows"))  # one row each


def pattern_counts(df: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """Rows (pattern, n): how many rows each pattern is found in, all in one pass."""
    sums = df.agg(*[F.count_if(F.col(column).rlike(p)).alias(k) for k, p in patterns.items()])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(k).alias("pattern"), F.col(k).alias("n")) for k in patterns])).alias("r")).select("r.*")


def mean_pool(df: DataFrame, keys: list[str], vector: str, mask: Column) -> DataFrame:
    """The mean vector of each group's rows for which ``mask`` holds, as an array."""
    means = df.where(mask).select(*keys, F.posexplode(vector).alias("i", "x")).groupBy(*keys, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("pooled"))
