"""The stateful live path: restarts, retries, the fallback and expiry."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tessera.streaming import state
from tessera.streaming.comments import table_stream

SCHEMA = "id long, ts timestamp, texte string"


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, score, sink=None, **more):
    stream = table_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, 1)
    rows = state.scored_texts(stream, F.col("texte"), "ts", "id", "texte", score, waits=(0.0, 0.0), **more)
    sink = sink or state.changes_sink(str(tmp_path / "out"))
    rows.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()


def test_counts_and_scores_survive_a_failed_batch(spark, tmp_path):
    """The second batch fails after it was written; after the restart each message counts once, and a label stays as it was first given."""
    calls = tmp_path / "calls"
    calls.mkdir()

    def score(text):
        import uuid

        (calls / f"{text}-{uuid.uuid4().hex}").touch()
        return {"label": text.upper(), "confidence": 0.5}

    t0 = datetime(2024, 1, 1)
    for batch in ([(1, t0, "a"), (2, t0, "b"), (3, t0, "a")], [(4, t0 + timedelta(hours=1), "a"), (0, t0 - timedelta(hours=1), "b"), (5, t0, "c")], [(6, t0, "c"), (7, None, "d"), (8, t0, None)]):
        put(spark, str(tmp_path / "in"), batch)
    write = state.changes_sink(str(tmp_path / "out"))

    def failing(df, n):
        write(df, n)
        if n == 1:
            raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path, score, failing)
    run(spark, tmp_path, score)
    got = {r.key: (r.frequence, r.date_creation, r.derniere_occurrence, r.first_id, r.label, r.scored) for r in state.latest(spark, str(tmp_path / "out")).collect()}
    assert got == {"a": (3, t0, t0 + timedelta(hours=1), 1, "A", 1), "b": (2, t0 - timedelta(hours=1), t0, 0, "B", 1), "c": (2, t0, t0, 5, "C", 1)}
    names = [p.name.split("-")[0] for p in calls.iterdir()]
    assert names.count("a") == names.count("b") == 1 and 1 <= names.count("c") <= 2  # only the failed batch's new text may be asked for again


def test_expired_keys_leave_the_state(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    for batch in ([(1, t0, "a"), (2, t0, "b")], [(3, t0 + timedelta(minutes=20), "a")], [(4, t0 + timedelta(minutes=65), "c")], [(5, t0 + timedelta(minutes=66), "c")], [(6, t0 + timedelta(minutes=100), "b")]):
        put(spark, str(tmp_path / "in"), batch)
        run(spark, tmp_path, lambda text: {"label": "x", "confidence": 1}, keep_seconds=2400, late="1 minute")
    out = str(tmp_path / "out")
    alive = {r.key: (r.frequence, r.first_id) for r in state.latest(spark, out).collect()}
    gone = {r.key: r.frequence for r in state.latest(spark, out, expired=True).collect()}
    assert alive == {"c": (2, 4), "b": (1, 6)} and gone == {"a": 2}  # b left with one message and came anew
    first_b = spark.read.parquet(out).where("key = 'b' and expired").collect()
    assert [r.frequence for r in first_b] == [1]


def test_retries_and_fallback():
    waited, calls = [], []

    def flaky(text):
        calls.append(text)
        if len(calls) < 3:
            raise TimeoutError("late")
        return {"label": "POSITIF", "confidence": 0.9, "probabilities": {"POSITIF": 0.9}}

    got = state.with_retries(flaky, "t", sleep=waited.append)
    assert got["label"] == "POSITIF" and got["erreur"] is None and waited == [2.0, 4.0]

    def down(text):
        raise ConnectionError("no")

    got = state.with_retries(down, "t", sleep=waited.append)
    assert (got["label"], got["confidence"], got["probabilities"]) == ("NEUTRE", 0.0, {"NEGATIF": 0.33, "NEUTRE": 0.34, "POSITIF": 0.33}) and got["erreur"] == "ConnectionError: no" and waited == [2.0, 4.0] * 2
