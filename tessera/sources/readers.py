"""Readers of the comment pipeline's inputs. All give DataFrames with explicit columns; malformed input never ends a job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import strip_code_fence


def csv_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """CSV files with a header, every column a string."""
    return spark.read.option("header", True).csv(pattern)


def csv_tolerant(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Quoted CSV of the given columns as strings, line feeds inside quotes allowed; rows of another width are left out."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    read = spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED").option("quote", '"').option("escape", '"').option("multiLine", True)
    return read.option("encoding", "UTF-8").csv(path)


def csv_of_reply(spark: SparkSession, path: str, columns: list[str], marker: str) -> DataFrame:
    """CSV as language models write it: without fences, and from the header line that holds ``marker`` on.

    One file is one reply, and a row of the read; records are split by Spark.
    """
    text = spark.read.text(path, wholetext=True).select(strip_code_fence(F.regexp_replace("value", "^\\x{FEFF}", "")).alias("t"))
    body = F.regexp_replace("t", rf"(?s)^.*?[^\n]*{marker}[^\n]*\r?\n", "")
    lines = text.where(F.col("t").contains(marker)).select(F.explode(F.split(body, r"\r?\n")).alias("line")).where(F.trim("line") != "")
    schema = ", ".join(f"`{c}` string" for c in columns)
    return lines.select(F.from_csv("line", schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}).alias("r")).select("r.*")


def json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Files that hold one JSON array of records each."""
    read = spark.read.option("multiLine", True)
    return (read.schema(schema) if schema else read).json(path)


def parquet_parts(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*paths)


def excel(spark: SparkSession, path: str, schema: T.StructType, sheet: str | int = 0, header: int = 1) -> DataFrame:
    """A workbook's sheet, read by a task through pandas where an Excel engine is installed; the header is on row ``header`` + 1."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = schema.fieldNames()

    def of(batches):
        import io

        import pandas as pd

        for b in batches:
            for content in b["content"]:
                df = pd.read_excel(io.BytesIO(content), sheet_name=sheet, header=header, dtype=str)
                yield df.reindex(columns=names)

    return files.mapInPandas(of, T.StructType([T.StructField(n, T.StringType()) for n in names])).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def mongodb(spark: SparkSession, uri: str, database: str, collection: str) -> DataFrame:
    """A collection through the MongoDB connector, which has to be on the class path; its partitioner splits the read."""
    return spark.read.format("mongodb").option("connection.uri", uri).option("database", database).option("collection", collection).load()


def dictionaries(spark: SparkSession, path: str, max_bytes: int = 20_000_000) -> dict:
    """The normaliser's dictionaries: one JSON object of objects. The file's size is checked before it comes to the driver."""
    import json

    files = spark.read.format("binaryFile").load(path)
    size = files.agg(F.sum("length")).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"{path} has {size} bytes; dictionaries of up to {max_bytes} are read")
    return json.loads(bytes(files.select("content").first()[0]).decode("utf-8"))


def text_lines(spark: SparkSession, path: str, name: str = "text") -> DataFrame:
    """Each line of plain text files as a row; blank lines are left out."""
    return spark.read.text(path).select(F.col("value").alias(name)).where(F.trim(name) != "")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows, the same for the same seed, whatever the partitions."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def parse_flag(c):
    """true, 1, yes, oui and false, 0, no, non as booleans; any other text counts as true if not empty."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("true", "1", "yes", "oui"), True).when(t.isin("false", "0", "no", "non", ""), False).when(t.isNotNull(), True)
