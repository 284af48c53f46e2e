"""SimHash fingerprints and near-duplicate components by multi-index hashing (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, saved
from tessera.operators.work import components

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
#: Fingerprints differ in this many bits at most to be linked.
RADIUS = 2
#: A table entry with more fingerprints is resolved by whole fingerprints, see ``_whole_balls``.
ENTRY_ROWS = 256
BROADCAST_ROWS = 500_000


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text, as a signed number; 0 where there is no word."""
    words = (text or b"").lower().split()  # for bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return 0
    join, digest = b" ".join, xxhash.xxh64_digest
    if len(words) <= shingle_words:
        hashes = digest(join(words), SEED)
    else:
        hashes = b"".join([digest(join(x), SEED) for x in zip(*(words[k:] for k in range(shingle_words)), strict=False)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(rows), 65536):  # bounded memory for very long texts
        ones += np.unpackbits(rows[at : at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fp), one for each row of ``docs``; a null text counts as empty and gets 0."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(x) for x in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(of, "doc_id long, fp long")


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` within 2 bits of each other into the right components.

    The fingerprint is cut into two segments of 32 bits. Of two fingerprints
    that differ in 2 bits or fewer, the first segments differ in at most one, or
    else the second ones in none: so the Hamming ball of radius 1 is enumerated
    in the first segment, and of radius 0 in the second. Each segment has a table
    by its value. What a fingerprint fetches there is verified by the complete
    distance. A ball's values are asked for by setting bits only, as of two that
    differ in one bit one has it not set: 18 rows a fingerprint on average.

    Entries of up to ``ENTRY_ROWS`` fingerprints are fetched as they are, which
    bounds what a row can fetch. Fingerprints that belong to, or ask for, a
    larger entry are linked by ``_whole_balls`` with one another.
    """
    halves = F.array(F.struct(F.lit(0).alias("segment"), F.shiftrightunsigned("fp", 32).alias("value")), F.struct(F.lit(1).alias("segment"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("value")))
    table = saved(fps.select("fp", F.explode(halves).alias("h")).select("h.segment", "h.value", "fp"), "segment-tables")
    large = saved(table.groupBy("segment", "value").agg(F.count("*").alias("n")).where(F.col("n") > ENTRY_ROWS).select("segment", "value"), "large-entries")
    n_large = large.count()
    others = F.filter(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.col("value").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), k))), lambda v: v != F.col("value"))
    asked = table.withColumn("own", F.lit(True)).unionByName(table.where("segment = 0").select("segment", F.explode(others).alias("value"), "fp", F.lit(False).alias("own")))
    marked = broadcast_if_small(large, n_large, BROADCAST_ROWS)
    few = asked.join(marked, ["segment", "value"], "left_anti") if n_large else asked
    fetched = few.select("segment", "value", F.col("fp").alias("a"), "own").join(table.withColumnRenamed("fp", "b"), ["segment", "value"])
    close = fetched.where((~F.col("own") | (F.col("a") < F.col("b"))) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS))
    found = close.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return found.unionByName(_whole_balls(saved(asked.join(marked, ["segment", "value"], "left_semi").select("fp").distinct(), "crowded"))) if n_large else found


def _whole_balls(fps: DataFrame) -> DataFrame:
    """Links that join all of ``fps`` within 2 bits of each other, with 65 rows a fingerprint however large their groups.

    Two fingerprints within 2 bits are each within one bit of some third value
    or of the other. Each is listed under itself and the 64 values that differ
    in one bit; an entry is one mask of the bits in which its members differ from
    it, so it has 65 members at most, which are linked to the least of them.
    """
    signed = [x - (1 << BITS) if x >> (BITS - 1) else x for x in (1 << k for k in range(BITS))]
    probes = F.explode(F.array(F.struct(F.col("fp").alias("key"), F.lit(0).cast("long").alias("bit")), *[F.struct(F.col("fp").bitwiseXOR(F.lit(x)).alias("key"), F.lit(x).cast("long").alias("bit")) for x in signed]))
    table = fps.select(probes.alias("p")).groupBy("p.key").agg(F.expr("bit_or(p.bit)").alias("bits"), F.expr("bool_or(p.bit = 0)").alias("own"))
    several = table.where(F.expr("bit_count(bits) + int(own) > 1"))
    members = F.expr("array_compact(concat(if(own, array(key), array(cast(null as bigint))), transform(sequence(0, 63), k -> if(getbit(bits, k) = 1, key ^ shiftleft(1L, k), null))))")
    return several.select(members.alias("fps")).select(F.array_min("fps").alias("b"), F.explode("fps").alias("a")).where("a <> b").select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fp, component_id): the component is the smallest doc_id that links of up to 2 bits reach.

    One row per row of ``docs``. Exact copies meet in one fingerprint, which is
    grouped before any link is sought. Null, empty and blank texts have fingerprint
    0 and are linked like any other; repeated ids and rows without an id keep
    their rows (a component has a null id if none of its rows has one); an empty
    table gives no rows; other columns are not read.
    """
    rows = saved(fingerprints(docs, id_col, text_col), "fingerprints")
    fps = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(fps))
    rooted = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = saved(rooted.join(least, "root").select("fp", "component_id"), "fingerprint-components")
    return rows.join(found, "fp").select("doc_id", "fp", "component_id")
