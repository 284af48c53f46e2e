"""Mixing sources to target weights by systematic sampling (operator 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACE, keyed, saved

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = 20
#: Rows that are ranked together in one group.
GROUP_ROWS = 1024


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Rows (source, source_size, n_docs, target) from (source, source_size, n_docs).

    Sources in code-point order, null last, have ``weights`` in turn and share
    the total size by weight. Filling all of them at once to a common level and
    stopping each at ``max_copies`` times its size gives what repeated resharing
    gives: sources are taken by cap/weight, and the level is what is left of the
    total over what is left of the weights. The windows run over one row for
    each source. Sources are distinct, a null one included; one whose size is 0 has the target 0,
    and an empty table gives no rows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)).withColumn("cap", F.col("source_size") * float(max_copies))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    rows = rows.withColumn("rest_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", F.col("rest") / F.col("rest_weight")).withColumn("stops", F.col("level") * F.col("weight") >= F.col("cap"))
    # the first source that is below its cap sets the level for itself and all after it
    rows = rows.withColumn("set_level", F.min(F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"])
    capped = F.col("set_level").isNull() | (F.col("set_level") * F.col("weight") >= F.col("cap"))
    return rows.select("source", "source_size", "n_docs", F.when(capped, F.col("cap")).otherwise(F.col("set_level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, copies), one per row of ``docs``.

    The size is the number of words. Each document of a source expects
    target/source_size copies. Documents are laid along a line by size and id,
    each as long as the copies it expects, from one random offset for each
    source; a document is emitted once for each integer it crosses. As
    neighbours have like sizes, the words taken stray from the target by about
    one document at most.

    The prefix sum is the expected copies times a rank. Ranks come from counts
    of (source, size) groups, cut into parts of about ``GROUP_ROWS`` by a hash
    of the id: only counts meet in a window by source, so no source, however
    large, is sorted in one task. Null texts and empty texts have size 0; null
    sources are one source, the last. Repeated rows are separate documents. The
    same rows and seed give the same copies.
    """
    named = keyed(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).cast("string").alias("text")))
    return _copies(named, seed, weights, max_copies).drop("r1", "r2")


def _copies(named: DataFrame, seed: int, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """What ``mix`` returns, and each row's key, for ``keyed`` rows."""
    size = F.coalesce(F.regexp_count(F.col("row.text"), F.lit(rf"[^{ASCII_SPACE[1:-2]}]+")), F.lit(0)).cast("long")
    rows = saved(named.select("row.doc_id", "row.source", size.alias("size"), "r1", "r2"), "sizes")
    groups = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    sources = saved(targets(groups.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_docs")), weights, max_copies), "targets")

    parts = groups.select(F.col("source").alias("g_source"), F.col("size").alias("g_size"), F.ceil(F.col("n") / GROUP_ROWS).alias("n_parts"))
    parted = rows.join(parts, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("size") == F.col("g_size")))
    parted = saved(parted.select("doc_id", "source", "size", "r1", "r2", F.expr("pmod(xxhash64(doc_id, r1), n_parts)").alias("part")), "parts")
    counts = parted.groupBy("source", "size", "part").agg(F.count("*").alias("n"))
    line = Window.partitionBy("source").orderBy("size", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), F.col("part").alias("p_part"), F.coalesce(F.sum("n").over(line), F.lit(0)).alias("before"))
    ranked = parted.withColumn("within", F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("doc_id", "r1", "r2")))
    ranked = ranked.join(offsets, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")) & (F.col("part") == F.col("p_part"))).select("doc_id", "source", "size", "r1", "r2", (F.col("before") + F.col("within")).alias("rank"))

    s = sources.select(F.col("source").alias("s_source"), "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"), (F.expr(f"pmod(xxhash64(source, {seed}), 1048576)") / 1048576.0).alias("offset"))
    placed = ranked.join(s, F.col("source").eqNullSafe(F.col("s_source")))
    crossed = F.floor(F.col("rank") * F.col("rate") + F.col("offset")) - F.floor((F.col("rank") - 1) * F.col("rate") + F.col("offset"))
    return placed.select("doc_id", "source", "size", "source_size", "target", F.least(crossed, F.lit(max_copies)).cast("long").alias("copies"), "r1", "r2")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes them.

    Rows are told apart by all their columns, so those without an id or with a
    shared one have copies of their own; rows that are equal in every column
    come as often as all of them are taken. Rows without a word come or not by
    chance of their place, like any other. An empty table stays empty.
    """
    rows = keyed(docs)
    counts = _copies(rows, SEED, WEIGHTS, MAX_COPIES).groupBy("r1", "r2").agg(F.sum("copies").alias("copies")).where("copies > 0")
    return rows.dropDuplicates(["r1", "r2"]).join(counts, ["r1", "r2"]).select("row", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")
