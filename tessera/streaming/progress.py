"""What streams are doing, as tables: a listener writes an event for each start, batch and end, and anything can read them."""

from __future__ import annotations

import json
import threading
import time
import uuid
from datetime import UTC, datetime

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

EVENTS = "type string, id string, run string, name string, at timestamp, batch long, rows long, rows_per_second double, milliseconds long, observed map<string, map<string, double>>, error string"


class ProgressLog(StreamingQueryListener):
    """Writes each event of the session's streams as one JSON file below ``folder`` (a URI), and ``status.json`` as it is after it.

    The names of files sort by time. An event that can't be written is counted in
    ``lost`` and doesn't disturb the stream. Kinds: ``started``, ``progress``,
    ``idle``, ``finished`` and ``failed``.
    """

    def __init__(self, folder: str):
        self.fs, self.path = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(f"{self.path}/events", recursive=True)
        self.names: dict[str, str | None] = {}
        self.status: dict[str, dict] = {}
        self.lost = 0
        self.lock = threading.Lock()

    def _put(self, name: str, text: str) -> None:
        """Under a hidden name first, so that a reader sees whole files only."""
        folder, _, leaf = f"{self.path}/{name}".rpartition("/")
        hidden = f"{folder}/.{leaf}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(hidden) as f:
            f.write(text.encode())
        self.fs.move(hidden, f"{folder}/{leaf}")

    def _tell(self, kind: str, event, at: str | None = None, **more) -> None:
        run = str(event.runId)
        row = {"type": kind, "id": str(event.id), "run": run, "name": self.names.get(run), "at": at or datetime.now(UTC).isoformat(timespec="milliseconds")} | more
        with self.lock:
            try:
                self._put(f"events/{time.time_ns():020d}-{kind}.json", json.dumps(row))
                s = self.status.setdefault(run, {"id": row["id"], "run": run, "name": row["name"], "batches": 0, "rows": 0, "error": None})
                s["state"], s["at"] = {"finished": "FINISHED", "failed": "FAILED"}.get(kind, "RUNNING"), row["at"]
                s["error"] = more.get("error")
                if kind == "progress":
                    s["batches"], s["rows"] = s["batches"] + 1, s["rows"] + (more["rows"] or 0)
                self._put("status.json", json.dumps(list(self.status.values())))
            except OSError:
                self.lost += 1

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name
        self._tell("started", event, event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {k: {c: float(v) for c, v in r.asDict().items() if isinstance(v, (int, float))} for k, r in p.observedMetrics.items()}
        self._tell("progress", p, p.timestamp, batch=p.batchId, rows=p.numInputRows, rows_per_second=_finite(p.processedRowsPerSecond), milliseconds=p.batchDuration, observed=observed)

    def onQueryIdle(self, event) -> None:
        self._tell("idle", event, event.timestamp)

    def onQueryTerminated(self, event) -> None:
        self._tell("failed" if event.exception else "finished", event, error=event.exception)

    def ended(self, run: str, seconds: float = 30.0) -> bool:
        """Waits for the end of a run to be written: events come some time after what they tell of."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            with self.lock:
                if self.status.get(run, {}).get("state") in ("FINISHED", "FAILED"):
                    return True
            time.sleep(0.05)
        return False


def _finite(x: float | None) -> float | None:
    return x if x is not None and x == x and abs(x) != float("inf") else None


def watch(spark: SparkSession, folder: str) -> ProgressLog:
    """A log of all streams of the session from now on; end it with ``spark.streams.removeListener``."""
    log = ProgressLog(folder)
    spark.streams.addListener(log)
    return log


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The events so far as a table."""
    return spark.read.schema(EVENTS).json(f"{folder}/events")


def event_stream(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """The events as a stream of their own, of running streams too."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", per_batch).json(f"{folder}/events")


def of_type(rows: DataFrame, part: str, column: str = "type") -> DataFrame:
    """Events whose type has ``part`` in it, in any case; for tables and streams."""
    return rows.where(F.contains(F.lower(column), F.lit(part.lower())))


def runs(log: DataFrame) -> DataFrame:
    """One row a run: state, batches, rows, and the error of a failed one."""
    last = F.max_by("type", F.struct(F.col("type").isin("finished", "failed"), "at"))
    state = F.when(last == "failed", "FAILED").when(last == "finished", "FINISHED").otherwise("RUNNING")
    batches = F.count_if(F.col("type") == "progress")
    return log.groupBy("id", "run").agg(F.max("name").alias("name"), state.alias("state"), batches.alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("error").alias("error"))


def stage_times(log: DataFrame) -> DataFrame:
    """Batches with the time since the one before of the same run."""
    before = F.lag("at").over(Window.partitionBy("run").orderBy("batch"))
    return of_type(log, "progress").select("id", "run", "batch", "rows", "milliseconds", (F.unix_millis("at") - F.unix_millis(before)).alias("since_last"))


def refreshed(rows: DataFrame, name: str, mode: str = "complete", every: str = "5 seconds") -> StreamingQuery:
    """A streamed result as the session's table ``name``, for reports that ask again and again; it is held in the driver, so ``rows`` has to be a small aggregate."""
    return rows.writeStream.format("memory").queryName(name).outputMode(mode).trigger(processingTime=every).start()


class Cached:
    """A result that is computed again when it is older than ``seconds``; in between ``get`` gives the rows it had."""

    def __init__(self, compute, seconds: float = 30.0, clock=time.monotonic):
        self.compute, self.seconds, self.clock, self.at, self.rows = compute, seconds, clock, None, None

    def get(self) -> list:
        now = self.clock()
        if self.at is None or now - self.at >= self.seconds:
            self.rows, self.at = self.compute().collect(), now  # a report's rows
        return self.rows


def ok_rows(df: DataFrame, name: str, ok: Column) -> DataFrame:
    """``df`` with what the log shows under ``observed``: its rows, and those that are ``ok``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("ok"))
