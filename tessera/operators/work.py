"""Intermediate tables in the shared folder, and components of links."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a local session that has none set (tests, a laptop) gets a temporary
    folder: on a cluster no two machines would share it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tessera/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for this application below the shared one."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of each query at its end, which else stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    The lineage ends there: a lost executor costs only the tasks it ran, a plan
    that uses the rows twice computes them once, and shuffle files go.
    """
    path = new_folder(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes what ``saved`` wrote for ``frames``, when nothing that is still to run reads it."""
    for df in frames:
        spark, files = df.sparkSession, df.inputFiles()
        if files:
            folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            if folder.getParent().getName() == spark.sparkContext.applicationId:
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clean_scratch(spark: SparkSession) -> None:
    """Deletes all that ``saved`` and the file writers of this application left; call it when results have been written or collected."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _linked_to_least(edges: DataFrame, only_smaller: bool) -> DataFrame:
    """Each node's neighbours are linked to the least of them and the node.

    The least neighbour comes from a grouped minimum (combined before the
    shuffle), so a node with a large share of all links never meets in one task.
    """
    if only_smaller:
        out = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = out.groupBy("u").agg(F.min("v").alias("m"))
        joined = out.join(least, "u")
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(own).where("a <> b").distinct()
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("n", "u").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for each node of ``edges`` (a, b); root is the least node that is reachable.

    Large-star and small-star steps alternate until the links no longer change,
    after about log2(longest path) rounds. Each round is written to the shared
    folder. Nulls and loops are ignored; no links give no rows.
    """
    at = saved(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        new = at.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(cast(xxhash64(b, a) as decimal(38, 0)))")).first()
        if new[0] == 0 or new == state:
            return at.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(at.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        state, old = new, at
        at = saved(_linked_to_least(_linked_to_least(at, False), True), "links")
        discard(old)
