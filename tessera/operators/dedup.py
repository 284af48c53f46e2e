"""Exact duplicates: groups by text or by a prefix of it, rules, and keep policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONFLICT = "CONFLIT_A_REVOIR"


def trimmed(c: Column) -> Column:
    """Without white space at either end, in the Unicode sense."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def compare_key(c: Column) -> Column:
    """Lower case, trimmed; null counts as empty."""
    return F.lower(trimmed(F.coalesce(c, F.lit(""))))


def prefix_key(c: Column, n: int = 60) -> Column:
    """The first ``n`` characters without 'see more' tails and runs of spaces."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?iU)(En voir plus|See more|أكثر)", "")
    return F.substring(trimmed(F.regexp_replace(plain, r"(?U)\s+", " ")), 1, n)


def group_by_text(df: DataFrame, key: Column, id_col: str, label_col: str, source_col: str, threshold: float = 0.6) -> DataFrame:
    """One row a text: size, least id, its majority label and whether that is in conflict.

    The majority label is the most frequent (the one with the least id among
    equals); under ``threshold`` of the labelled rows the group is in conflict.
    Labels are counted before they meet, so large groups stay small.
    """
    keyed = df.select(F.xxhash64(key).alias("h"), key.alias("k"), F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(source_col).alias("source"))
    per = keyed.groupBy("h", "k", "label").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    best = F.max(F.when(F.col("label").isNotNull(), F.struct(F.col("n").alias("n"), (-F.col("first")).alias("first"), F.col("label").alias("label"))))
    groups = per.groupBy("h", "k").agg(F.sum("n").alias("n"), F.min("first").alias("id"), F.sum(F.when(F.col("label").isNotNull(), F.col("n"))).alias("labelled"), best.alias("best"), F.count("label").alias("n_labels"))
    sure = F.col("best.n") >= threshold * F.col("labelled")
    sources = keyed.groupBy("h", "k").agg(F.countDistinct("source").alias("n_sources"))
    out = groups.join(sources, ["h", "k"])
    return out.select("id", "n", "n_sources", "n_labels", F.when(sure, F.col("best.label")).when(F.col("labelled").isNotNull(), F.lit(CONFLICT)).alias("label_final"), F.coalesce(~sure, F.lit(False)).alias("conflict"))


def typology(df: DataFrame, key: Column, source: str, day: str, moderator: str) -> DataFrame:
    """Groups of two or more rows with the same key: in how many sources, days and hands, and which of the types that makes."""
    groups = df.groupBy(key.alias("k")).agg(F.count("*").alias("n"), F.countDistinct(source).alias("n_sources"), F.countDistinct(day).alias("n_days"), F.countDistinct(moderator).alias("n_moderators")).where("n > 1")
    one = (F.col("n_sources") <= 1) & (F.col("n_days") <= 1) & (F.col("n_moderators") <= 1)
    return groups.select("k", "n", "n_sources", "n_days", "n_moderators", (F.col("n_sources") > 1).alias("t1_sources"), (F.col("n_days") > 1).alias("t2_days"), (F.col("n_moderators") > 1).alias("t3_moderators"), one.alias("t4_perfect"))


def rows_of_groups(df: DataFrame, keys: list[str], having: Column, *aggs: Column) -> DataFrame:
    """The rows of ``df`` whose group by ``keys`` fulfils ``having`` over ``aggs``; counts, not rows, decide."""
    groups = df.groupBy(*keys).agg(*aggs).where(having)
    return df.join(groups, keys)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
