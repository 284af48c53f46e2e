"""Near copies by SimHash of five-word shingles, verified by exact Jaccard similarity (the pipeline's second stage).

Fingerprints of 64 bits within ``simhash.RADIUS`` meet by multi-index hashing. Similar texts may differ in far more
bits, so contents that are not yet linked go the exact way: prefix filtering, which misses no pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.buckets import SIMILARITY, bucket_links, may_be_similar, most_met
from tessera.llm.common import broadcast_if_small, keyed, saved
from tessera.llm.pieces import slices
from tessera.llm.shingles import EMPTY, lists, mix, shingles
from tessera.operators.work import components

#: So many shingles at most, those in most texts, are known as common to the order of the prefixes.
MAX_COMMON = 200_000
#: So many ids of texts to read again are broadcast; more are shuffled.
MAX_IDS = 1_000_000


def _content(found: np.ndarray) -> int:
    """One number of a whole set of shingles."""
    places = np.arange(1, len(found) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return int(mix(mix(found * places).sum(dtype=np.uint64).reshape(1) + np.uint64(len(found))).view(np.int64)[0])


def _fingerprint(found: np.ndarray) -> int:
    """The SimHash of a set of shingles, as a signed number; 0 for none."""
    if not len(found):
        return 0
    ones = np.zeros(simhash.BITS, np.int64)
    for at in range(0, len(found), 65536):  # bounded memory for very long texts
        ones += np.unpackbits(found[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(found)).tobytes(), "big", signed=True)


def _texts(b: pa.RecordBatch) -> list[bytes | None]:
    return b.column("text").cast(pa.binary()).to_pylist()


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded size, so that a task holds the shingles of few texts at a time."""
    for b in batches:
        at = 0
        for part in slices(b.column("text")):
            yield b.slice(at, len(part))
            at += len(part)
        pa.default_memory_pool().release_unused()  # else each worker keeps its largest batch for good


def _common(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several different texts of a slice share, and about how often (as a power of two), ordered by shingle."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            sets = [shingles(t) for t in set(_texts(b))]
            found, n = np.unique(np.concatenate([EMPTY, *sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1])], ["s", "n"])

    counts = rows.select("text").mapInArrow(of, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where("n > 2")
    top = counts.orderBy(F.desc("n"), "s").limit(MAX_COMMON).toPandas()
    keys, level = top["s"].to_numpy(np.int64).view(np.uint64), np.log2(np.maximum(top["n"].to_numpy(np.float64), 1)).astype(np.int64)
    order = np.argsort(keys)
    return keys[order], level[order]


def _prefixes(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, r1, r2, content, size, rank, fp, prefix), one for each text: its fingerprint, and the shingles of which similar texts share one.

    A text of n shingles has at least 0.8 n in common with any that is similar,
    so its first n - 0.8 n + 1 in one order of all shingles hold one of them.
    Any order will do; rare shingles come first, so that a passage or notice in
    many texts brings few of them together. ``rank`` is the lower the more common
    a text's shingles are on average: of many variants of one text, the lowest is
    that text, or the one nearest to it.
    """
    keys, level = (rows.sparkSession.sparkContext.broadcast(x) for x in _common(rows))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            content, size, ranks, fps, prefix = [], [], [], [], []
            for text in _texts(b):
                s = shingles(text)
                n = len(s)
                if len(keys.value) and n:
                    at = np.minimum(np.searchsorted(keys.value, s), len(keys.value) - 1)
                    rank = np.where(keys.value[at] == s, level.value[at], 0)
                    ordered = s[np.lexsort((s, rank))]
                    ranks.append(-int(1000 * rank.mean()))
                else:
                    ordered = s
                    ranks.append(0)
                content.append(_content(s))
                fps.append(_fingerprint(s))
                size.append(n)
                prefix.append(ordered[: n + 1 + (-n * SIMILARITY[0] // SIMILARITY[1])] if n else EMPTY)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "r1", "r2")), pa.array(content, pa.int64()), pa.array(size, pa.int32()), pa.array(ranks, pa.int32()), pa.array(fps, pa.int64()), lists(prefix)], ["doc_id", "r1", "r2", "content", "size", "rank", "fp", "prefix"])

    return rows.mapInArrow(of, "doc_id long, r1 long, r2 long, content long, size int, rank int, fp long, prefix array<long>")


def _similar(pairs: DataFrame, rows: DataFrame, contents: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of contents whose sets of shingles have the similarity, by reading one text of each again."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            sets = [shingles(t) for t in _texts(b)]
            yield pa.RecordBatch.from_arrays([pa.array([_content(s) for s in sets], pa.int64()), lists(sets)], ["content", "s"])

    wanted = pairs.select(F.col("a").alias("content")).unionByName(pairs.select(F.col("b").alias("content"))).distinct()
    keys = saved(contents.select("content", "first_r1").join(wanted, "content", "left_semi").select(F.col("first_r1").alias("r1")).distinct(), "keys")
    sets = saved(rows.join(broadcast_if_small(keys, keys.count(), MAX_IDS), "r1", "left_semi").select("text").mapInArrow(of, "content long, s array<long>"), "shingle-sets")
    both = pairs.join(sets.select(F.col("content").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("content").alias("b"), F.col("s").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common * SIMILARITY[1] >= (F.size("x") + F.size("y") - common) * SIMILARITY[0]).select("a", "b").distinct()


def _simhash_pairs(contents: DataFrame) -> DataFrame:
    """Pairs (a, b) of contents that join all whose fingerprints are within ``simhash.RADIUS`` bits, to be verified.

    Contents of one fingerprint meet its least content; of fingerprints that are linked, the least contents meet.
    """
    fps = saved(contents.groupBy("fp").agg(F.min("content").alias("least")), "content-fingerprints")
    ends = [fps.select(F.col("fp").alias(c), F.col("least").alias(f"{c}_least")) for c in ("a", "b")]
    linked = simhash.links(fps).join(ends[0], "a").join(ends[1], "b").select(F.col("a_least").alias("a"), F.col("b_least").alias("b"))
    return contents.join(fps, "fp").where("content <> least").select(F.col("content").alias("a"), F.col("least").alias("b")).unionByName(linked)


def _classes(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, r1, r2, root), one for each row of ``keyed`` documents."""
    rows = docs.select(F.col("row.doc_id").cast("long").alias("doc_id"), "r1", "r2", F.col("row.text").cast("string").alias("text"))
    found = saved(_prefixes(rows).withColumn("number", F.monotonically_increasing_id()), "prefixes")
    contents = saved(found.groupBy("content").agg(F.min("r1").alias("first_r1"), F.min("number").alias("number"), F.min("fp").alias("fp")), "contents")
    firsts = found.join(broadcast_if_small(contents.select("number"), contents.count(), MAX_IDS), "number", "left_semi")  # prefixes, the largest part, are written once
    bucket = Window.partitionBy("s")
    entries = firsts.select("content", "size", "rank", F.posexplode("prefix").alias("at", "s")).select("s", "content", "rank", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("size")).alias("place"))
    members = entries.withColumn("hub", F.min(F.struct("rank", "content", "place")).over(bucket)).withColumn("n", F.count("*").over(bucket))
    members = saved(members.where("n > 1").select("s", "content", "place", F.col("hub.content").alias("hub"), F.col("hub.place").alias("hub_place")), "buckets")
    hubs = most_met(members.where(may_be_similar(F.col("place"), F.col("hub_place"))).select("content", "hub"))
    near = saved(_simhash_pairs(contents).unionByName(hubs).distinct(), "near-pairs")
    roots = components(bucket_links(members.drop("hub", "hub_place"), may_be_similar, lambda pairs: _similar(pairs, rows, contents), near))
    return found.select("doc_id", "r1", "r2", "content").join(roots.withColumnRenamed("node", "content"), "content", "left").select("doc_id", "r1", "r2", F.coalesce("root", "content").alias("root"))


def near_copies(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, component_id), one for each row of ``docs``: the component is the smallest doc_id that links reach, null if none of its rows has one.

    Texts are linked whose sets of five-word shingles (words between ASCII white
    space, A-Z lower-cased) have a Jaccard similarity of ``SIMILARITY`` or more.
    Equal sets meet first, as one content; null, empty and blank texts have the
    empty set. Contents whose SimHash fingerprints are within ``simhash.RADIUS``
    bits meet by multi-index hashing. Similar ones can be further apart, so
    contents that share a shingle of their prefixes meet in its
    bucket too, where ``bucket_links`` compares those that are not yet linked. Long texts are whole; an empty
    table gives no rows; other columns are not read.
    """
    classes = saved(_classes(keyed(docs)), "classes")
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return classes.join(least, "root").select("doc_id", "component_id")


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component one row stays, the one with the smallest doc_id.

    Rows are told apart by all their columns. A row without an id stays where
    its component has none with an id; of rows with the smallest id the one with
    the least hash stays; of rows that are equal in every column, one. So every
    text is kept or has a near copy that is, and reruns agree. Null and empty
    texts are copies of one another. An empty table stays empty.
    """
    rows = keyed(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "r2")
    kept = _classes(rows).groupBy("root").agg(F.min(order).alias("k")).select("k.r1", "k.r2")
    return rows.join(kept, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"]).select("row.*")
