"""Nearest rows of a stated query set, by exact cosine in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.work import saved

#: Queries of one block; a block is brought to the driver and broadcast.
BLOCK = 2000


def nearest(rows: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """Rows (query_id, id, rank, score): the ``k`` rows most similar to each query, itself left out; equal scores by id.

    Queries are dealt by a hash into blocks of about ``BLOCK``. Each block is
    broadcast and meets the rows, batch by batch where they lie, as one matrix
    product; a batch keeps its best k a query, so what is shuffled is k rows a
    query and batch, not the scores. Rows without an id or a vector, or with a
    vector of another length than the block's first, are left out; a zero vector
    has a similarity of 0 with all.
    """
    usable = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~F.exists(F.col(vec_col), lambda x: x.isNull())
    vectors = lambda df: df.where(usable).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    asked = saved(vectors(queries), "queries")
    n_blocks = -(-asked.count() // BLOCK)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(n_blocks, 1))))
    spark, found = rows.sparkSession, None
    for block in range(n_blocks):
        q = asked.where(F.col("block") == block).toPandas()  # about BLOCK rows
        if q.empty:
            continue
        size = len(q["v"].iloc[0])
        q = q[[len(v) == size for v in q["v"]]]
        met = vectors(rows).where(F.size("v") == size).mapInPandas(_best(spark.sparkContext.broadcast((q["id"].to_numpy(), _unit(np.stack(q["v"])))), k), "query_id long, id long, score double")
        found = met if found is None else found.unionByName(met)
    if found is None:
        found = spark.createDataFrame([], "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _best(block, k: int):
    """The function of the tasks; it brings along all that it needs."""
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qid, q = block.value
        for b in batches:
            if b.empty:
                continue
            ids = b["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            scores = q @ unit(np.stack(b["v"])).T[:, order]
            scores[qid[:, None] == ids[None, :]] = -np.inf
            top = np.argsort(-np.round(scores, 9), axis=1, kind="stable")[:, :k]
            out = pd.DataFrame({"query_id": np.repeat(qid, top.shape[1]), "id": ids[top].ravel(), "score": np.take_along_axis(scores, top, 1).ravel()})
            yield out[np.isfinite(out["score"])]

    return of
