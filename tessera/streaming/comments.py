"""The live path: messages in, one row a distinct text out, with how often it came."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.text import clean_stream
from tessera.schemas import COMMENT_MESSAGE



def kafka_messages(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Comment messages of a Kafka topic; offsets live in the query's checkpoint, so a restart replays nothing."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).load()
    return raw.select(F.from_json(F.col("value").cast("string"), COMMENT_MESSAGE).alias("m")).select("m.*")


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Rows as JSON messages, at least once, every five seconds."""
    out = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    return out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).trigger(processingTime="5 seconds").start()


def table_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 10) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def normalised(messages: DataFrame, text_col: str = "commentaire") -> DataFrame:
    """Messages with ``texte_normalise`` and its hash; those with nothing left are dropped."""
    return messages.withColumn("texte_normalise", clean_stream(F.col(text_col))).where("texte_normalise <> ''").withColumn("hash_texte", F.md5("texte_normalise"))


def fold(rows: DataFrame, key: str, ts: str, order: str, keep: list[str]) -> DataFrame:
    """One row a key: its number, first and last time, and the ``keep`` columns of its first row."""
    first = F.min(F.struct(ts, order, *keep)).alias("_f")
    out = rows.groupBy(key).agg(F.count("*").alias("frequence"), F.min(ts).alias("date_creation"), F.max(ts).alias("derniere_occurrence"), first)
    return out.select(key, "frequence", "date_creation", "derniere_occurrence", *[F.col(f"_f.{c}").alias(c) for c in [order, *keep]])


def merge(old: DataFrame, new: DataFrame, key: str, order: str, keep: list[str]) -> DataFrame:
    """Two folded tables as one: counts add up, the earlier first row stays; columns that ``old`` alone has (its scores) stay as they are."""
    base = [key, "frequence", "date_creation", "derniere_occurrence", order, *keep]
    scores = [c for c in old.columns if c not in base]
    out = old.unionByName(new, allowMissingColumns=True).groupBy(key).agg(
        F.sum("frequence").alias("frequence"),
        F.min("date_creation").alias("date_creation"),
        F.max("derniere_occurrence").alias("derniere_occurrence"),
        F.min(F.struct("date_creation", order, *keep)).alias("_f"),
        *[F.max(c).alias(c) for c in scores],  # new rows have none
    )
    return out.select(*base[:4], *[F.col(f"_f.{c}").alias(c) for c in [order, *keep]], *scores)


#: Parts of a frequency table, the same for all of its batches; a batch reads and writes those that its keys fall into.
PARTS = 64


def _versions(spark: SparkSession, path: str, before: int) -> dict[int, int]:
    """The latest finished version below ``before`` of each part of the table, by the names of its folders."""
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[int, int] = {}
    for s in fs.listStatus(root) if fs.exists(root) else []:
        name = s.getPath().getName()
        if name.startswith("v") and int(name[1:]) < before and fs.exists(jvm.Path(s.getPath(), "_SUCCESS")):
            for p in fs.listStatus(s.getPath()):
                if p.getPath().getName().startswith("part="):
                    part = int(p.getPath().getName()[5:])
                    out[part] = max(out.get(part, -1), int(name[1:]))
    return out


def _drop_before(spark: SparkSession, path: str, used: set[int], before: int) -> None:
    """Deletes versions below ``before`` of which no part is in use."""
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for s in fs.listStatus(jvm.Path(path)):
        name = s.getPath().getName()
        if name.startswith("v") and int(name[1:]) < before and int(name[1:]) not in used:
            fs.delete(s.getPath(), True)


def _read_parts(spark: SparkSession, path: str, versions: dict[int, int]) -> DataFrame | None:
    if not versions:
        return None
    return spark.read.parquet(*[f"{path}/v{v}/part={p}" for p, v in sorted(versions.items())])


def frequency_sink(path: str, key: str, ts: str, order: str, keep: list[str], score: Callable[[DataFrame], DataFrame] = lambda df: df, parts: int = PARTS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges a batch into the table at ``path``.

    The table is dealt into ``parts`` parts by a hash of the key. Batch n reads
    the latest versions before it of the parts that its keys fall into, and
    writes only these, as version n: a repeated batch gives the same table, each
    message counts exactly once, and a batch costs what it touches. ``score``
    adds columns, and sees only rows whose key is new to the table; known keys
    keep the scores that they were given. Versions that neither batch n nor the
    one before it needs are deleted.
    """

    def batch(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        new = fold(df, key, ts, order, keep).withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")).persist()
        try:
            touched = {r["part"] for r in new.select("part").distinct().collect()}  # a number for each part at most
            versions = _versions(spark, path, n)
            old = _read_parts(spark, path, {p: v for p, v in versions.items() if p in touched})
            if old is None:
                out = score(new.drop("part"))
            else:
                known = old.select(key)
                fresh = score(new.drop("part").join(known, key, "left_anti"))
                out = merge(old, new.drop("part").join(known, key, "left_semi"), key, order, keep).unionByName(fresh.select(old.columns))
            out.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")).write.partitionBy("part").mode("overwrite").parquet(f"{path}/v{n}")
        finally:
            new.unpersist()
        _drop_before(spark, path, set(_versions(spark, path, n + 1).values()) | set(versions.values()), n)

    return batch


def current(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``frequency_sink`` keeps: the latest version of each part."""
    return _read_parts(spark, path, _versions(spark, path, 1 << 62))


def sessions(df: DataFrame, ts: str, by: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    """Rows (start, end, by, n): sessions of rows of one key with less than ``gap`` between neighbours, for streams and tables."""
    out = df.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def batch_statistics(df: DataFrame, seen: DataFrame | None, key: str) -> DataFrame:
    """One row (processed, new, duplicates) of a batch against the keys ``seen`` before."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    marked = counts.withColumn("_known", F.lit(False)) if seen is None else counts.join(seen.select(F.col(key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left").withColumn("_known", F.col("_k").isNotNull())
    processed, new = F.coalesce(F.sum("n"), F.lit(0)), F.count_if(~F.col("_known"))
    return marked.agg(processed.alias("processed"), new.alias("new"), (processed - new).alias("duplicates"))


def watched(df: DataFrame, name: str, ok: Column) -> DataFrame:
    """``df`` with running totals under ``name`` in each batch's progress: rows, and rows that are ``ok``."""
    return df.observe(name, F.count("*").alias("rows"), F.count_if(ok).alias("ok"))


def mark_sent(rows: DataFrame, sent: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``sent``: whether the producer has written their key to its topic."""
    s = sent.select(F.col(key).alias("_sent")).distinct()
    return rows.join(s, F.col(key) == F.col("_sent"), "left").withColumn("sent", F.col("_sent").isNotNull()).drop("_sent")


def windowed_counts(df: DataFrame, ts: str, by: list[str], size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts in event-time windows, for streams and tables; rows later than ``late`` are dropped from streams."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    out = df.withWatermark(ts, late).groupBy(window, *by).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")
