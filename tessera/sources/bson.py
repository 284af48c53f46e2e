"""Dumped document collections (BSON) as a Spark source with key ranges, pushed filters and the columns that are asked for, and as a sink.

A dump has no marks to split it at, so ``index_dump`` walks each file once, file
by file in parallel, and writes where runs of documents begin and which keys
they have. Reads are planned from that: each run is a task's, and runs whose
keys a filter on ``_id`` excludes are not opened. Fields that the schema does
not name are skipped by their length.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from typing import Any

import pyarrow as pa
import pyarrow.dataset as pads
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of one run of documents, and rows of one batch.
RUN_BYTES, BATCH_ROWS = 32_000_000, 2_000
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
_ID = "_id"

# The types of the format.
DOUBLE, STRING, DOCUMENT, ARRAY, BINARY, UNDEFINED, OBJECT_ID, BOOLEAN, DATETIME, NULL = range(1, 11)
REGEX, CODE, SYMBOL, INT32, TIMESTAMP, INT64, DECIMAL = 11, 13, 14, 16, 17, 18, 19
_SIZED = {DOUBLE: 8, UNDEFINED: 0, OBJECT_ID: 12, BOOLEAN: 1, DATETIME: 8, NULL: 0, INT32: 4, TIMESTAMP: 8, INT64: 8, DECIMAL: 16, 127: 0, 255: 0}


def _end(raw: bytes, kind: int, at: int) -> int:
    """Where the value of ``kind`` that begins at ``at`` ends."""
    if kind in _SIZED:
        return at + _SIZED[kind]
    size = struct.unpack_from("<i", raw, at)[0] if kind != REGEX else 0
    if kind in (STRING, CODE, SYMBOL):
        return at + 4 + size
    if kind in (DOCUMENT, ARRAY):
        return at + size
    if kind == BINARY:
        return at + 5 + size
    if kind == REGEX:
        return raw.index(0, raw.index(0, at) + 1) + 1
    raise ValueError(f"unknown type {kind}")


def _value(raw: bytes, kind: int, at: int) -> Any:
    if kind == DOUBLE:
        return struct.unpack_from("<d", raw, at)[0]
    if kind in (STRING, CODE, SYMBOL):
        return raw[at + 4 : at + 3 + struct.unpack_from("<i", raw, at)[0]].decode("utf-8", "replace")
    if kind == DOCUMENT:
        return decoded(raw, at)
    if kind == ARRAY:
        return list(decoded(raw, at).values())
    if kind == BINARY:
        return raw[at + 5 : at + 5 + struct.unpack_from("<i", raw, at)[0]]
    if kind == OBJECT_ID:
        return raw[at : at + 12].hex()
    if kind == BOOLEAN:
        return raw[at] == 1
    if kind == DATETIME:
        return _EPOCH + timedelta(milliseconds=struct.unpack_from("<q", raw, at)[0])
    if kind == INT32:
        return struct.unpack_from("<i", raw, at)[0]
    if kind in (INT64, TIMESTAMP):
        return struct.unpack_from("<q", raw, at)[0]
    return None


def decoded(raw: bytes, at: int = 0, names: frozenset[str] | None = None) -> dict[str, Any]:
    """The document at ``at``; of its fields only ``names``, if given."""
    stop, out = at + struct.unpack_from("<i", raw, at)[0] - 1, {}
    at += 4
    while at < stop:
        kind, end = raw[at], raw.index(0, at + 1)
        name = raw[at + 1 : end].decode("utf-8", "replace")
        if names is None or name in names:
            out[name] = _value(raw, kind, end + 1)
        at = _end(raw, kind, end + 1)
    return out


def encoded(document: dict[str, Any]) -> bytes:
    parts = []
    for name, v in document.items():
        if v is None:
            kind, body = NULL, b""
        elif isinstance(v, bool):
            kind, body = BOOLEAN, bytes([v])
        elif isinstance(v, int):
            kind, body = INT64, struct.pack("<q", v)
        elif isinstance(v, float):
            kind, body = DOUBLE, struct.pack("<d", v)
        elif isinstance(v, datetime):
            at = v if v.tzinfo else v.replace(tzinfo=UTC)
            kind, body = DATETIME, struct.pack("<q", (at - _EPOCH) // timedelta(milliseconds=1))
        elif isinstance(v, bytes):
            kind, body = BINARY, struct.pack("<i", len(v)) + b"\0" + v
        elif isinstance(v, dict):
            kind, body = DOCUMENT, encoded(v)
        elif isinstance(v, (list, tuple)):
            kind, body = ARRAY, encoded({str(k): x for k, x in enumerate(v)})
        else:
            raw = str(v).encode()
            kind, body = STRING, struct.pack("<i", len(raw) + 1) + raw + b"\0"
        parts.append(bytes([kind]) + name.encode() + b"\0" + body)
    body = b"".join(parts)
    return struct.pack("<i", len(body) + 5) + body + b"\0"


def _fitted(v: Any, kind: T.DataType) -> Any:
    """``v`` as a value of ``kind``, null if it is none: a field may have other types in other documents."""
    if v is None:
        return None
    if isinstance(kind, T.StringType):
        return v if isinstance(v, str) else str(v)
    if isinstance(kind, T.BooleanType):
        return v if isinstance(v, bool) else None
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        limit = {T.LongType: 63, T.IntegerType: 31, T.ShortType: 15}[type(kind)]
        return int(v) if isinstance(v, (int, float)) and not isinstance(v, bool) and v == v and -(2**limit) <= v < 2**limit else None
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
    if isinstance(kind, T.TimestampType):
        return v if isinstance(v, datetime) else None
    if isinstance(kind, T.BinaryType):
        return v if isinstance(v, bytes) else None
    if isinstance(kind, T.ArrayType):
        return [_fitted(x, kind.elementType) for x in v] if isinstance(v, list) else None
    if isinstance(kind, T.StructType):
        return {f.name: _fitted(v.get(f.name), f.dataType) for f in kind} if isinstance(v, dict) else None
    return None


def _documents(source, stop: int, names: frozenset[str] | None) -> Iterator[tuple[int, dict[str, Any]]]:
    """(place, document) of an open file from its present place on; a cut last document ends the file."""
    at = source.tell()
    while at < stop:
        head = source.read(4)
        size = struct.unpack("<i", head)[0] if len(head) == 4 else 0
        body = source.read(size - 4) if size > 4 else b""
        if len(body) != size - 4 or size < 5:
            return
        yield at, decoded(head + body, 0, names)
        at += size


def index_dump(spark: SparkSession, path: str, index: str, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Walks the files ``*.bson`` of the folder ``path`` (a URI), a task for each, and writes the runs of documents to ``index``: file, first, stop, low, high, n.

    ``low`` and ``high`` are the least and greatest ``_id`` of a run, as text; null if a document's is of another kind than text or an object id.
    """
    at, folder = fs.FileSystem.from_uri(path)
    files = sorted(f.path for f in at.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".bson"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = fs.FileSystem.from_uri(path)[0]
        for b in batches:
            for name in b["file"].to_pylist():
                size, runs = own.get_file_info(name).size, []
                with own.open_input_file(name) as f:
                    for place, d in _documents(f, size, frozenset([_ID])):
                        if not runs or place - runs[-1][0] >= run_bytes:
                            runs.append([place, place, [], 0])
                        key = d.get(_ID)
                        run = runs[-1]
                        run[2] = None if run[2] is None or not isinstance(key, str) else [min([*run[2][:1], key]), max([*run[2][1:], key])]
                        run[3] += 1
                    stops = [r[0] for r in runs[1:]] + [size]
                yield pa.RecordBatch.from_pydict({"file": pa.array([name] * len(runs), pa.string()), "first": pa.array([r[0] for r in runs], pa.int64()), "stop": pa.array(stops[: len(runs)], pa.int64()), "low": pa.array([r[2] and r[2][0] for r in runs], pa.string()), "high": pa.array([r[2] and r[2][1] for r in runs], pa.string()), "n": pa.array([r[3] for r in runs], pa.int64())})

    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(len(files), 1))
    listed.mapInArrow(walk, "file string, first long, stop long, low string, high string, n long").write.mode("overwrite").parquet(index)
    return spark.read.parquet(index)


@dataclass
class _Run(ds.InputPartition):
    file: str
    first: int
    stop: int


_TESTS = {ds.EqualTo: lambda v, x: v == x, ds.GreaterThan: lambda v, x: v > x, ds.GreaterThanOrEqual: lambda v, x: v >= x, ds.LessThan: lambda v, x: v < x, ds.LessThanOrEqual: lambda v, x: v <= x, ds.In: lambda v, x: v in x, ds.StringStartsWith: lambda v, x: v.startswith(x)}


class _Reader(ds.DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.schema, self.tests = options, schema, []

    def pushFilters(self, filters: list) -> Iterator:
        """Comparisons of top-level text and number fields are taken; what is left goes back to Spark."""
        kinds = {f.name: f.dataType for f in self.schema}
        for f in filters:
            plain = len(getattr(f, "attribute", ())) == 1 and isinstance(kinds.get(f.attribute[0]), (T.StringType, T.LongType, T.IntegerType, T.DoubleType))
            if plain and isinstance(f, (*_TESTS, ds.IsNotNull)):
                self.tests.append((f.attribute[0], type(f), getattr(f, "value", None)))
            else:
                yield f

    def _may_hold(self, low: str | None, high: str | None) -> bool:
        for name, kind, x in self.tests:
            if name == _ID and low is not None and kind is not ds.IsNotNull:
                inside = {ds.EqualTo: lambda: low <= x <= high, ds.GreaterThan: lambda: high > x, ds.GreaterThanOrEqual: lambda: high >= x, ds.LessThan: lambda: low < x, ds.LessThanOrEqual: lambda: low <= x, ds.In: lambda: any(low <= v <= high for v in x), ds.StringStartsWith: lambda: high >= x and low[: len(x)] <= x}[kind]
                if not inside():
                    return False
        return True

    def partitions(self) -> list[_Run]:
        at, path = fs.FileSystem.from_uri(self.options["index"])
        runs = pads.dataset(path, filesystem=at, format="parquet", exclude_invalid_files=True).to_table().to_pylist()
        return [_Run(r["file"], r["first"], r["stop"]) for r in sorted(runs, key=lambda r: (r["file"], r["first"])) if self._may_hold(r["low"], r["high"])]

    def _kept(self, d: dict[str, Any]) -> bool:
        return all(d[name] is not None and (kind is ds.IsNotNull or _TESTS[kind](d[name], x)) for name, kind, x in self.tests)

    def read(self, partition: _Run) -> Iterator[pa.RecordBatch]:
        own = fs.FileSystem.from_uri(self.options["path"])[0]
        names, shape, rows = frozenset(self.schema.fieldNames()), to_arrow_schema(self.schema), []
        with own.open_input_file(partition.file) as f:
            f.seek(partition.first)
            for _, d in _documents(f, partition.stop, names):
                row = {x.name: _fitted(d.get(x.name), x.dataType) for x in self.schema}
                if self._kept(row):
                    rows.append(row)
                if len(rows) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, shape)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, shape)


class _Writer(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ds.WriterCommitMessage:
        from pyspark import TaskContext

        t, (own, path) = TaskContext.get(), fs.FileSystem.from_uri(self.path)
        name = f"{path}/part-{t.partitionId():06d}-{t.taskAttemptId()}"
        own.create_dir(path, recursive=True)
        with own.open_output_stream(f"{name}.tmp") as out:
            for b in iterator:
                for row in b.to_pylist():
                    out.write(encoded(row))
        return _Written(name)

    def commit(self, messages: list) -> None:
        """The files of the attempts that count get their names; with ``overwrite`` all earlier ones go first."""
        own, path = fs.FileSystem.from_uri(self.path)
        if self.overwrite:
            for f in own.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if f.path.endswith(".bson"):
                    own.delete_file(f.path)
        for m in messages:
            if m is not None:
                own.move(f"{m.name}.tmp", f"{m.name}.bson")

    def abort(self, messages: list) -> None:
        own = fs.FileSystem.from_uri(self.path)[0]
        for m in messages:
            if m is not None:
                own.delete_file(f"{m.name}.tmp")


@dataclass
class _Written(ds.WriterCommitMessage):
    name: str


class BsonSource(ds.DataSource):
    """Options: ``path`` of the dump's folder and, for reads, ``index`` (see ``index_dump``), both as URIs."""

    @classmethod
    def name(cls) -> str:
        return "tessera_bson"

    def reader(self, schema: T.StructType) -> ds.DataSourceReader:
        return _Reader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> ds.DataSourceWriter:
        return _Writer(dict(self.options), overwrite)


def _registered(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BsonSource)
    return spark


def read_dump(spark: SparkSession, path: str, index: str, schema) -> DataFrame:
    """The documents of an indexed dump; ``schema`` names the fields that are read, and a value of another type is null."""
    return _registered(spark).read.format("tessera_bson").schema(schema).option("path", path).option("index", index).load()


def write_dump(df: DataFrame, path: str, mode: str = "append") -> None:
    """Rows as documents, a file for each partition; times lose what is below a millisecond."""
    _registered(df.sparkSession)
    df.write.format("tessera_bson").option("path", path).mode(mode).save()


def documents_of(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``key`` as the 24 hexadecimal digits of an ``_id``, in the order of the keys."""
    return df.withColumn(_ID, F.lpad(F.lower(F.hex(F.col(key))), 24, "0"))
