"""The register of queries, and the tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The moment that relative periods count back from; the events of the test tables are of January 2024.
AS_OF = "2024-01-25 12:00:00"

#: DuckDB's version of ``comments``.
COMMENTS_SQL = """comments AS (
    SELECT d.doc_id, d.text, d.source, d.lang, l.quality, l.toxic,
           CASE WHEN l.toxic = 1 THEN 'negatif' WHEN l.quality = 1 THEN 'positif' WHEN l.quality = 0 THEN 'neutre' END AS label
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def query(sql: str | None = None) -> Callable:
    """Registers a function of (spark, sf_dir) under its name, with the DuckDB SQL that gives the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql.replace("{comments}", COMMENTS_SQL).replace("{as_of}", f"TIMESTAMP '{AS_OF}'")
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as comments, with a label from their annotation, null where there is none."""
    d, n = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "label_id")
    label = F.when(F.col("toxic") == 1, "negatif").when(F.col("quality") == 1, "positif").when(F.col("quality") == 0, "neutre")
    return d.join(n, F.col("doc_id") == F.col("label_id"), "left").select("doc_id", "text", "source", "lang", "quality", "toxic", label.alias("label"))
