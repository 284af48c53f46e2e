"""Progress of running, finished and failed streams, as tables and as a stream."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tessera.streaming import progress as pg
from tessera.streaming.comments import table_stream, watched

SCHEMA = "id long, v double"


def files(spark, tmp_path, n):
    for k in range(n):
        spark.createDataFrame([(k * 10 + i, float(i)) for i in range(k + 1)], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return table_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, 1)


def test_finished_and_failed(spark, tmp_path):
    log = pg.watch(spark, (tmp_path / "log").as_uri())
    try:
        rows = watched(files(spark, tmp_path, 3), "quality", F.col("v") >= 1)
        q = rows.writeStream.queryName("good").foreachBatch(lambda df, n: df.count() and None).option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert log.ended(str(q.runId))

        def broken(df, n):
            raise ValueError("no disk")

        bad = pg.ok_rows(files(spark, tmp_path, 0), "q", F.lit(True)).writeStream.queryName("bad").foreachBatch(broken).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
        with pytest.raises(StreamingQueryException):
            bad.awaitTermination()
        assert log.ended(str(bad.runId))
    finally:
        spark.streams.removeListener(log)
    folder = (tmp_path / "log").as_uri()
    table = pg.events(spark, folder)
    got = {r.batch: (r.rows, r.observed["quality"]["rows"], r.observed["quality"]["ok"]) for r in pg.of_type(table, "PROG").where("name = 'good'").collect()}
    assert got == {0: (1, 1.0, 0.0), 1: (2, 2.0, 1.0), 2: (3, 3.0, 2.0)}
    state = {r.name: r for r in pg.runs(table).collect()}
    assert (state["good"].state, state["good"].batches, state["good"].rows, state["good"].error) == ("FINISHED", 3, 6, None)
    assert state["bad"].state == "FAILED" and "no disk" in state["bad"].error
    assert [r.since_last is None for r in pg.stage_times(table).where("rows > 0").orderBy("batch").collect()] == [True, False, False]
    now = {s["name"]: s["state"] for s in json.loads((tmp_path / "log" / "status.json").read_text())}
    assert now == {"good": "FINISHED", "bad": "FAILED"} and log.lost == 0
    q = pg.of_type(pg.event_stream(spark, folder), "ed").groupBy("type").count().writeStream.format("memory").queryName("ends").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r["type"], r["count"]) for r in spark.table("ends").collect()} == {("started", 2), ("finished", 1), ("failed", 1)}


def test_refreshed_and_cached(spark, tmp_path):
    q = pg.refreshed(files(spark, tmp_path, 2).groupBy().count(), "total", every="0 seconds")
    q.processAllAvailable()
    q.stop()
    now, calls = [0.0], []

    def compute():
        calls.append(1)
        return spark.table("total")

    cached = pg.Cached(compute, 30, lambda: now[0])
    assert cached.get()[0]["count"] == 3 and cached.get() and len(calls) == 1
    now[0] = 30.0
    assert cached.get() and len(calls) == 2
