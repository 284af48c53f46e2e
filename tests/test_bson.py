"""Dumps of documents: the format, key ranges, pushed filters, and the round trip."""

import struct
from datetime import UTC, datetime

from pyspark.sql import functions as F

from tessera.sources import bson


def test_values():
    at = datetime(2024, 2, 3, 4, 5, 6, 789000, tzinfo=UTC)
    d = {"_id": "é", "i": -5, "f": 0.5, "b": True, "n": None, "t": at, "raw": b"\0\1", "d": {"x": [1, "y", None]}, "": "empty name"}
    assert bson.decoded(bson.encoded(d)) == d
    assert bson.decoded(bson.encoded(d), 0, frozenset(["d", "f"])) == {"f": 0.5, "d": {"x": [1, "y", None]}}
    body = b"\x07_id\0" + bytes(range(12)) + b"\x10k\0" + struct.pack("<i", 7) + b"\x0br\0a\0i\0" + b"\x11ts\0" + struct.pack("<q", 9) + b"\xffmin\0" + b"\x13dec\0" + bytes(16) + b"\x02s\0\x02\0\0\0z\0"
    raw = struct.pack("<i", len(body) + 5) + body + b"\0"
    assert bson.decoded(raw) == {"_id": "000102030405060708090a0b", "k": 7, "r": None, "ts": 9, "min": None, "dec": None, "s": "z"}


def dump(spark, tmp_path, run_bytes=2000):
    rows = [(k, f"text {k}", k % 3 == 0, {"a": k}) for k in range(200)]
    df = bson.documents_of(spark.createDataFrame(rows, "k long, t string, f boolean, m struct<a: long>"), "k").repartitionByRange(3, "k").sortWithinPartitions("k")
    path, index = (tmp_path / "dump").as_uri(), (tmp_path / "index").as_uri()
    bson.write_dump(df, path)
    return path, index, bson.index_dump(spark, path, index, run_bytes)


def test_ranges_filters_and_columns(spark, tmp_path):
    path, index, runs = dump(spark, tmp_path)
    found = sorted(runs.collect(), key=lambda r: r.low)
    assert len(found) > 6 and sum(r.n for r in found) == 200 and all(a.high < b.low for a, b in zip(found, found[1:], strict=False))
    read = bson.read_dump(spark, path, index, "_id string, k long, m struct<a: long>, t int, missing double")
    assert read.rdd.getNumPartitions() == len(found)
    rows = read.orderBy("k").collect()
    assert [(r.k, r.m.a, r.t, r.missing) for r in rows] == [(k, k, None, None) for k in range(200)]
    some = read.where((F.col("_id") >= f"{150:024x}") & (F.col("k") < 160) & F.col("m").isNotNull())
    assert some.rdd.getNumPartitions() < len(found) / 2 and sorted(r.k for r in some.collect()) == list(range(150, 160))
    plan = some._jdf.queryExecution().executedPlan().toString()
    left = next(x for x in plan.splitlines() if "Filter" in x)
    assert "isnotnull(m" in left and "_id" not in left and "160" not in left  # the source took the rest
    assert [r.k for r in read.where(F.col("_id").isin(f"{7:024x}", f"{8:024x}")).collect()] == [7, 8]


def test_damaged_and_repeated(spark, tmp_path):
    """A cut last document is left out; a dump written over has only the new rows."""
    path, index, _ = dump(spark, tmp_path)
    files = sorted((tmp_path / "dump").glob("*.bson"))
    raw = files[-1].read_bytes()
    files[-1].write_bytes(raw[:-3])
    bson.index_dump(spark, path, index)
    assert bson.read_dump(spark, path, index, "k long").count() == 199
    bson.write_dump(spark.createDataFrame([(1,)], "k long"), path, "overwrite")
    bson.index_dump(spark, path, index)
    assert [tuple(r) for r in bson.read_dump(spark, path, index, "k long, _id string").collect()] == [(1, None)]
