"""Workbooks (.xlsx) as a Spark source, one task a sheet, and as a sink, one workbook a partition.

Sheets are read as streams of rows, so a task holds its sheet's shared texts and
one batch. All cells are texts at first; ``read_workbook`` then casts them, and
what can't be cast is null.
"""

from __future__ import annotations

import json
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_ROWS = 2_000
#: The header is sought in so many rows; it is the first that has half of the titles.
HEADER_ROWS = 20
#: The most rows of a sheet, and the names of the format.
SHEET_ROWS = 1_048_576
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
_TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
_CODED = re.compile(r"_x([0-9A-Fa-f]{4})_")
_UNWRITABLE = re.compile("[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")


def _plain(text: str) -> str:
    return _CODED.sub(lambda m: chr(int(m[1], 16)), text)


def _text(element: ET.Element) -> str:
    """The runs of a text in a row; a reading aid beside it is none of them."""
    return _plain("".join(t.text or "" for p in element.iter() if p.tag != f"{{{_MAIN}}}rPh" for t in p.findall(f"{{{_MAIN}}}t")))


def _place(ref: str) -> int:
    """The column of a cell's name, from 0."""
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, member) of each sheet in the workbook's order."""
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    out = []
    for s in ET.fromstring(book.read("xl/workbook.xml")).iter(f"{{{_MAIN}}}sheet"):
        target = targets.get(s.get(f"{{{_REL}}}id"), "")
        out.append((s.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return out


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, e in ET.iterparse(f):
            if e.tag == f"{{{_MAIN}}}si":
                out.append(_text(e))
                e.clear()
    return out


def _rows(book: zipfile.ZipFile, member: str) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number, cells by column) of a sheet; a damaged end of the file ends the rows."""
    shared = _shared(book)
    with book.open(member) as f:
        number = 0
        try:
            for _, row in ET.iterparse(f):
                if row.tag != f"{{{_MAIN}}}row":
                    continue
                number, cells, at = int(row.get("r", number + 1)), {}, -1
                for c in row.findall(f"{{{_MAIN}}}c"):
                    at = _place(c.get("r")) if c.get("r") else at + 1
                    v, kind = c.find(f"{{{_MAIN}}}v"), c.get("t", "n")
                    if kind == "inlineStr":
                        value = _text(c.find(f"{{{_MAIN}}}is")) if c.find(f"{{{_MAIN}}}is") is not None else None
                    elif v is None or v.text is None or kind == "e":
                        value = None
                    elif kind == "s":
                        k = int(v.text)
                        value = shared[k] if k < len(shared) else None
                    else:
                        value = {"0": "false", "1": "true"}.get(v.text, v.text) if kind == "b" else _plain(v.text)
                    if value not in (None, ""):
                        cells[at] = value
                row.clear()
                yield number, cells
        except (ET.ParseError, zipfile.BadZipFile, EOFError):
            return


@dataclass
class _Sheet(ds.InputPartition):
    file: str
    name: str
    member: str


class _Reader(ds.DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.wanted = options["path"], options.get("sheet")
        self.titles = json.loads(options["titles"]) if "titles" in options else {}
        self.columns = schema.fieldNames()

    def partitions(self) -> list[_Sheet]:
        own, path = fs.FileSystem.from_uri(self.path)
        found = own.get_file_info(path)
        files = [path] if found.type == fs.FileType.File else sorted(f.path for f in own.get_file_info(fs.FileSelector(path)) if f.path.endswith(".xlsx"))
        out = []
        for name in files:
            with own.open_input_file(name) as f, zipfile.ZipFile(f) as book:
                out += [_Sheet(name, title, member) for title, member in _sheets(book) if self.wanted in (None, title)]
        return out

    def _header(self, cells: dict[int, str]) -> dict[str, int] | None:
        """The place of each column, if this is the header's row."""
        found = {v.strip().casefold(): k for k, v in reversed(cells.items())}
        places = {c: found[t] for c in self.columns if (t := self.titles.get(c, c).strip().casefold()) in found}
        return places if places and 2 * len(places) >= len([c for c in self.columns if c not in ("_sheet", "_row")]) else None

    def read(self, partition: _Sheet) -> Iterator[pa.RecordBatch]:
        own = fs.FileSystem.from_uri(self.path)[0]
        shape = pa.schema([(c, pa.string()) for c in self.columns])
        with own.open_input_file(partition.file) as f, zipfile.ZipFile(f) as book:
            places, rows = None, []
            for k, (number, cells) in enumerate(_rows(book, partition.member)):
                if places is None:
                    if k >= HEADER_ROWS:
                        return
                    places = self._header(cells)
                elif any(p in cells for p in places.values()):
                    rows.append({c: cells.get(p) for c, p in places.items()} | {"_sheet": partition.name, "_row": str(number)})
                if len(rows) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, shape)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, shape)


def _escaped(text: str) -> str:
    coded = _UNWRITABLE.sub(lambda m: f"_x{ord(m[0]):04X}_", text)
    return coded.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _cell(v: Any) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, bool):
        return f'<c t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)) and v == v and abs(v) < 1e15:
        return f"<c><v>{v!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{_escaped(str(v))}</t></is></c>'


def _row(values: list) -> bytes:
    return f"<row>{''.join(map(_cell, values))}</row>".encode()


class _Writer(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.sheet, self.column = options.get("sheet", "Feuil1"), options.get("sheetcolumn")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ds.WriterCommitMessage:
        """One workbook; rows go to the sheets that their column names, and a full sheet is continued on another."""
        from pyspark import TaskContext

        t, (own, path) = TaskContext.get(), fs.FileSystem.from_uri(self.path)
        name, sheets, full = f"{path}/part-{t.partitionId():06d}-{t.taskAttemptId()}", {}, {}
        for b in iterator:
            titles = [c for c in b.schema.names if c != self.column]
            for r in b.to_pylist():
                base = str(r[self.column]) if self.column and r[self.column] is not None else self.sheet
                sheet = f"{base} {full[base] + 1}" if full.get(base) else base
                rows = sheets.setdefault(sheet, [])
                if not rows:
                    rows.append(_row(titles))
                rows.append(_row([r[c] for c in titles]))
                if len(rows) == SHEET_ROWS:
                    full[base] = full.get(base, 0) + 1
        if sheets:
            own.create_dir(path, recursive=True)
            with own.open_output_stream(f"{name}.tmp") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
                _write_book(book, sheets)
        return _Written(name if sheets else None)

    def commit(self, messages: list) -> None:
        own, path = fs.FileSystem.from_uri(self.path)
        if self.overwrite:
            for f in own.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if f.path.endswith(".xlsx"):
                    own.delete_file(f.path)
        for m in messages:
            if m is not None and m.name:
                own.move(f"{m.name}.tmp", f"{m.name}.xlsx")

    def abort(self, messages: list) -> None:
        own = fs.FileSystem.from_uri(self.path)[0]
        for m in messages:
            if m is not None and m.name:
                own.delete_file(f"{m.name}.tmp")


@dataclass
class _Written(ds.WriterCommitMessage):
    name: str | None


def _write_book(book: zipfile.ZipFile, sheets: dict[str, list[bytes]]) -> None:
    names, head = _sheet_names(list(sheets)), '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k + 1}.xml" ContentType="{kind}.worksheet+xml"/>' for k in range(len(names)))
    book.writestr("[Content_Types].xml", f'{head}<Types xmlns="{_TYPES}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>')
    book.writestr("_rels/.rels", f'{head}<Relationships xmlns="{_PACKAGE}"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
    listed = "".join(f'<sheet name="{_escaped(n)}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, n in enumerate(names))
    book.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{listed}</sheets></workbook>')
    links = "".join(f'<Relationship Id="rId{k + 1}" Type="{_REL}/worksheet" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(names)))
    book.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{_PACKAGE}">{links}</Relationships>')
    for k, rows in enumerate(sheets.values()):
        with book.open(f"xl/worksheets/sheet{k + 1}.xml", "w") as out:
            out.write(f'{head}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            for r in rows:
                out.write(r)
            out.write(b"</sheetData></worksheet>")


def _sheet_names(wanted: list[str]) -> list[str]:
    """Names that the format allows: 31 letters, some signs replaced, each once in any case."""
    out: list[str] = []
    for w in wanted:
        base = re.sub(r"[\[\]:*?/\\]", "_", w).strip("'")[:31] or "_"
        name, k = base, 1
        while name.casefold() in {x.casefold() for x in out}:
            k += 1
            name = f"{base[: 30 - len(str(k))]}~{k}"
        out.append(name)
    return out


class WorkbookSource(ds.DataSource):
    """Options: ``path`` of a workbook or a folder of them, as a URI; reads: ``sheet``, and ``titles`` as JSON, the header's title of each column; writes: ``sheet``, or ``sheetcolumn``, whose values name the sheets."""

    @classmethod
    def name(cls) -> str:
        return "tessera_workbook"

    def reader(self, schema: T.StructType) -> ds.DataSourceReader:
        return _Reader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> ds.DataSourceWriter:
        return _Writer(dict(self.options), overwrite)


def read_workbook(spark: SparkSession, path: str, schema: T.StructType | str, titles: dict[str, str] | None = None, sheet: str | None = None) -> DataFrame:
    """The rows below the header of one sheet or of all; ``_sheet`` and ``_row`` may be among the columns.

    The header is the first of the first rows that has half of the titles; rows
    without a value in any of them are left out, and a column without a title in
    the header is null.
    """
    spark.dataSource.register(WorkbookSource)
    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    read = spark.read.format("tessera_workbook").schema(T.StructType([T.StructField(f.name, T.StringType()) for f in kinds])).option("path", path)
    if titles:
        read = read.option("titles", json.dumps(titles))
    if sheet is not None:
        read = read.option("sheet", sheet)
    return read.load().select(*[_cast(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in kinds])


def _cast(c: Column, kind: T.DataType) -> Column:
    """Whole numbers may be written as 3.0."""
    return c.try_cast("double").try_cast(kind) if isinstance(kind, (T.IntegerType, T.ShortType)) else F.coalesce(c.try_cast(kind), c.try_cast("double").try_cast(kind)) if isinstance(kind, T.LongType) else c.try_cast(kind)


def serial_date(c: Column) -> Column:
    """The moment that a sheet's day number means: days since 30 December 1899."""
    return F.timestamp_micros(((c.cast("double") - 25569) * 86_400_000_000).cast("long"))


def write_workbook(df: DataFrame, path: str, sheet: str = "Feuil1", sheet_column: str | None = None, mode: str = "overwrite") -> None:
    """A folder of workbooks, one a partition; times, lists and structs are written as text."""
    df.sparkSession.dataSource.register(WorkbookSource)
    plain = [F.col(f"`{c}`") if k in ("string", "boolean", "int", "bigint", "smallint", "tinyint", "double", "float") else F.to_json(f"`{c}`").alias(c) if k.startswith(("array", "map", "struct")) else F.col(f"`{c}`").cast("string").alias(c) for c, k in df.dtypes]
    write = df.select(*plain).write.format("tessera_workbook").option("path", path).option("sheet", sheet).mode("overwrite" if mode == "overwrite" else "append")
    (write.option("sheetcolumn", sheet_column) if sheet_column else write).save()
