"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import let  # noqa: F401
from tessera.operators.work import new_folder, saved  # noqa: F401

#: What separates words, as a Java regular expression: ASCII white space only.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_key(text: Column) -> list[Column]:
    """A text as two 64-bit hashes, ``t1`` and ``t2``: rows with the same text, and only these, meet by them, whatever their ids."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("text"), text).alias("t2")]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as a column ``row``, with two 64-bit hashes of all its columns, ``r1`` and ``r2``.

    They tell rows apart that have no id, or share one; rows that are equal in
    every column have one key. Names of columns can't clash with others'.
    """
    cols = [F.to_json(F.struct(c)) if kind.startswith("map") else F.col(f"`{c}`") for c, kind in docs.dtypes]
    hashes = [F.xxhash64(F.lit(k), *cols, *[c.isNull() for c in cols]) for k in ("r1", "r2")]
    return docs.select(F.struct("*").alias("row"), hashes[0].alias("r1"), hashes[1].alias("r2"))


def ascii_words(text: Column) -> Column:
    """Words between ASCII white space; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), ASCII_SPACE), "")


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint only where the counted ``rows`` are within ``limit``; else Spark shuffles both sides."""
    return F.broadcast(df) if rows <= limit else df
