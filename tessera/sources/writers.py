"""Writers: files for people, and tables that are appended to, merged and cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str) -> None:
    """Every value quoted; arrays as comma-separated text."""
    kinds = dict(df.dtypes)
    flat = [F.array_join(c, ",").alias(c) if kinds[c].startswith("array<string") else F.to_json(c).alias(c) if kinds[c].startswith(("struct", "map", "array")) else F.col(c) for c in df.columns]
    df.select(*flat).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Appends the rows whose key the table at ``path`` has not, each key once."""
    spark = df.sparkSession
    new = df.dropDuplicates([key])
    try:
        old = spark.read.parquet(path).select(key)
    except Exception as e:  # the first write
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    (new if old is None else new.join(old, key, "left_anti")).write.mode("append").parquet(path)


def without(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``keys``."""
    return df.join(keys.select(key).distinct(), key, "left_anti")


def sorted_table(df: DataFrame, path: str, key: str, files: int) -> None:
    """A Parquet table in ranges of ``key``, sorted within each file: readers that look for keys skip most row groups, as by an index."""
    df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def bucketed_table(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """A table that joins on ``key`` with others of as many buckets without a shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)


def copy_table(spark: SparkSession, old: str, new: str) -> None:
    spark.table(old).write.mode("overwrite").saveAsTable(new)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def rename_table(df_or_spark, old: str, new: str) -> None:
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
