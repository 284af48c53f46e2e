"""Look-ups, updates and checks between tables by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row in ``order`` for each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def update_from(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``target`` with ``columns`` taken from the row of ``source`` with the same key, where that has a value.

    ``source`` has one row a key at most (see ``latest_by``).
    """
    s = source.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = target.join(s, F.col(key) == F.col("_key"), "left")
    return joined.select(*[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, those of ``source`` in place of those of ``target`` with the same key; of several with one key in one table the row of the greatest hash."""
    both = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1)))
    return latest_by(both, keys, [F.col("_new").desc(), F.xxhash64(*target.columns).desc(), F.xxhash64(F.lit(1), *target.columns)]).drop("_new")


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key ``right`` has not."""
    return left.join(right.select(F.col(key)).distinct(), key, "left_anti")


def present(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(F.col(key)).distinct(), key, "left_semi")


def link_counts(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """One row: how many keys of ``left`` there are, and how many of them ``right`` has or lacks."""
    a, b = left.select(F.col(key).alias("k")).where("k is not null").distinct(), right.select(F.col(key).alias("r")).where("r is not null").distinct()
    joined = a.join(b, F.col("k") == F.col("r"), "left")
    return joined.agg(F.count("*").alias("n_keys"), F.count("r").alias("n_linked"), F.count_if(F.col("r").isNull()).alias("n_orphans")).select(F.lit(name).alias("link"), "*")


def update_all_by_text(target: DataFrame, source: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """``target`` with ``columns`` from the source row with the same stripped text: every row of the text is updated; of several source rows the greatest counts."""
    key = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    s = source.where(F.col(text).isNotNull()).groupBy(key(F.col(text)).alias("_text")).agg(F.max(F.struct(*columns)).alias("_s"))
    joined = target.join(s, key(F.col(text)) == F.col("_text"), "left")
    return joined.select(*[F.coalesce(F.col(f"_s.{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


# Words that a yes or no field may have.
TRUE_WORDS, FALSE_WORDS = ("true", "vrai", "oui", "yes", "1"), ("false", "faux", "non", "no", "0")


def typed(c: Column, kind: str) -> Column:
    """A text field as ``bool``, ``int``, ``double`` or ``string``; null where it is none."""
    if kind == "bool":
        word = F.lower(F.trim(c))
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    return F.trim(c) if kind == "string" else F.trim(c).try_cast("bigint" if kind == "int" else kind)


def update_typed(target: DataFrame, fields: DataFrame, key: str, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(updated, rejected): ``target`` with the parsed text ``fields`` of its key, and the fields' rows without a row to update."""
    parsed = fields.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct(*[typed(F.col(c), k).alias(c) for c, k in kinds.items()])).alias("_f"))
    joined = target.join(parsed, F.col(key) == F.col("_key"), "left")
    updated = joined.select(*[F.coalesce(F.col(f"_f.{c}"), F.col(c)).alias(c) if c in kinds else F.col(c) for c in target.columns])
    return updated, fields.join(target.select(key).distinct(), key, "left_anti")


def both_annotators(a: DataFrame, b: DataFrame, text: str, names: tuple[str, str] = ("moi", "camarade")) -> DataFrame:
    """Rows of two annotators with the same stripped text, each pair of them; other columns get the annotator's name."""
    strip = lambda df, n: df.select(F.regexp_replace(text, r"(?U)^\s+|\s+$", "").alias(text if n == names[0] else "_text"), *[F.col(c).alias(f"{c}_{n}") for c in df.columns if c != text])
    return strip(a, names[0]).join(strip(b, names[1]), F.col(text) == F.col("_text")).drop("_text")


def missing_text(left: DataFrame, right: DataFrame, text: str) -> DataFrame:
    """Rows of ``left`` whose stripped text ``right`` has not; null texts stay."""
    key = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return left.join(right.select(key(F.col(text)).alias("_text")).distinct(), key(F.col(text)) == F.col("_text"), "left_anti")
