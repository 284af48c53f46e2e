"""The live path with keyed state: each text is scored once, when it first comes, and counted from then on.

State lives in Spark's state store under the query's checkpoint, so a restart,
also in the middle of a batch, counts each message exactly once and scores no
text again that a finished batch has scored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

Scorer = Callable[[str], dict]

#: What a text gets when no try of the scorer succeeds.
FALLBACK = {"label": "NEUTRE", "confidence": 0.0, "probabilities": {"NEGATIF": 0.33, "NEUTRE": 0.34, "POSITIF": 0.33}}
#: Seconds before the second and the third try.
WAITS = (2.0, 4.0)

#: Times are microseconds in the state.
_STATE = "frequence long, date_creation long, derniere_occurrence long, first_at long, first_id long, texte string, label string, confidence double, probabilities map<string, double>, erreur string, scored int"
ROWS = "key string, frequence long, date_creation long, derniere_occurrence long, first_id long, texte string, label string, confidence double, probabilities map<string, double>, erreur string, scored int, expired boolean"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_retries(score: Scorer, text: str, waits: tuple[float, ...] = WAITS, sleep: Callable[[float], None] = time.sleep) -> dict:
    """What ``score`` gives, after up to ``len(waits)`` more tries; then the fallback, with the last error under ``erreur``."""
    for wait in (*waits, None):
        try:
            return FALLBACK | dict(score(text)) | {"erreur": None}
        except Exception as e:  # noqa: BLE001 -- whatever the scorer throws, the stream goes on
            error = f"{type(e).__name__}: {e}"
        if wait is not None:
            sleep(wait)
    return FALLBACK | {"erreur": error}


class ScoredTexts(StatefulProcessor):
    """State of one key: its row. A key that ``keep_ms`` of event time pass by is given out once more as expired, and forgotten."""

    def __init__(self, score: Scorer, keep_ms: int | None, waits: tuple[float, ...]):
        self.score, self.keep_ms, self.waits = score, keep_ms, waits

    def init(self, handle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", _STATE)

    def _out(self, key, s: tuple, expired: bool) -> Row:
        return Row(key=key[0], frequence=s[0], date_creation=s[1], derniere_occurrence=s[2], first_id=s[4], texte=s[5], label=s[6], confidence=s[7], probabilities=s[8], erreur=s[9], scored=s[10], expired=expired)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r["at"], r["id"], r["texte"]) for r in rows]  # of one key in one batch
        first = min(new, key=lambda x: (x[0], x[1]))
        last = max(x[0] for x in new)
        if self.row.exists():
            s = self.row.get()
            earlier = first if (first[0], first[1]) < (s[3], s[4]) else (s[3], s[4], s[5])
            state = (s[0] + len(new), min(s[1], first[0]), max(s[2], last), *earlier, *s[6:11])
        else:
            p = with_retries(self.score, first[2], self.waits)
            state = (len(new), first[0], last, *first, p["label"], float(p["confidence"]), {k: float(v) for k, v in p["probabilities"].items()}, p["erreur"], 1)
            if self.keep_ms is not None:
                self.handle.registerTimer(last // 1000 + self.keep_ms)
        self.row.update(state)
        yield self._out(key, state, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s = tuple(self.row.get())
        due = s[2] // 1000 + self.keep_ms
        if due > expiredTimerInfo.getExpiryTimeInMs():  # it came again since
            self.handle.registerTimer(due)
            return
        self.row.clear()
        yield self._out(key, s, True)

    def close(self) -> None:
        pass


def scored_texts(messages: DataFrame, key: Column, ts: str, order: str, text: str, score: Scorer, keep_seconds: int | None = None, late: str = "10 minutes", waits: tuple[float, ...] = WAITS) -> DataFrame:
    """The rows (see ``ROWS``, with timestamps) of the keys that each batch of the stream ``messages`` changes.

    A key's first row, by ``ts`` and then the number ``order``, gives its text;
    the first batch that has it gives its score. With ``keep_seconds`` the state
    of a key ends when the watermark, ``late`` behind the latest row, has passed
    its last row by that much. Rows without a key or a time are dropped.
    """
    messages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = messages.select(key.alias("key"), F.col(ts).cast("timestamp").alias("ts"), F.col(order).cast("long").alias("id"), F.col(text).alias("texte"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at")).where("key is not null and ts is not null")
    if keep_seconds is not None:
        rows = rows.withWatermark("ts", late)
    processor = ScoredTexts(score, None if keep_seconds is None else keep_seconds * 1000, waits)
    out = rows.groupBy("key").transformWithState(statefulProcessor=processor, outputStructType=ROWS, outputMode="Update", timeMode="None" if keep_seconds is None else "EventTime")
    return out.withColumns({c: F.timestamp_micros(c) for c in ("date_creation", "derniere_occurrence")})


def changes_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: batch n's rows as a folder of their own, which a repeated batch writes again."""

    def batch(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={n:09d}")

    return batch


def latest(spark: SparkSession, path: str, expired: bool = False) -> DataFrame:
    """The last row of each key of the changes at ``path``, of keys that are in the state or, if so wanted, of those that have left it."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in ("key", "batch")]
    last = rows.groupBy("key").agg(F.max_by(F.struct(*values), F.struct("batch", "expired")).alias("r")).select("key", "r.*")
    return last.where(F.col("expired") == expired).drop("expired")
