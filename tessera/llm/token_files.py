"""Token ids as Arrow files of equal-length sequences, with random access (operator 5)."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import new_folder, saved
from tessera.llm.pieces import Pieces, gathered, slices

SEQUENCE = 2048
END_ID = 0
#: Sequences in one batch of a file.
BATCH_ROWS = 256
CACHE_WORDS = 600_000
CACHE_CHARS = 64


class WordEncoder:
    """Ids of whole texts as the tokenizers library gives them, as little-endian unsigned 16- or 32-bit numbers.

    For a byte-level model without normalizer. Its splitter never joins what
    stands on the two sides of one space between non-spaces, so a text is cut
    there and each distinct piece is encoded once. A
    piece that begins or ends with other white space, or is empty, would see a
    run of white space cut short: such a text is cut by a pattern that leaves
    the runs whole. Plain pieces (ASCII and Latin letters) are split by the
    splitter's published pattern and handed to the library's model; any other
    piece goes through the whole library.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.cut = regex.compile(r"(?<=\S) (?=\S)").split
        spec = json.loads(self.tokenizer.to_str())
        splitter = spec["pre_tokenizer"]
        byte_level = splitter == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": splitter.get("trim_offsets"), "use_regex": True}
        if spec["normalizer"] is not None or not byte_level:
            raise ValueError("not a plain byte-level tokenizer")
        # Fixed: the byte-level splitter's pattern.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        special = [regex.escape(x["content"]) for x in spec["added_tokens"]]
        self.special = regex.compile("|".join(special)).search if special else None
        self.plain = regex.compile(rf" ?[\x21-\x7e\n\u00c0-\u024f]{{0,{CACHE_CHARS}}}").fullmatch
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = dict(zip(shown, map(chr, shown), strict=True)) | {b: chr(256 + k) for k, b in enumerate(hidden)}

    def _whole(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, self.dtype).tobytes()

    def _part(self, part: str) -> bytes:
        if (ids := self.parts.get(part)) is None:
            if len(self.parts) > CACHE_WORDS:
                self.parts.clear()
            spelled = part.encode().decode("latin-1").translate(self.letters)
            ids = self.parts[part] = array(self.code, [x.id for x in self.model.tokenize(spelled)]).tobytes()
        return ids

    def _piece(self, piece: str) -> bytes:
        if not self.plain(piece) or self.special is not None and self.special(piece):
            return self._whole(piece)
        return b"".join(map(self._part, self.split(piece)))

    def _after_space(self, word: str) -> bytes | None:
        """The ids of ' ' + word, kept for later; None where a text can't be cut: next to other white space, or between spaces."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        if len(word) > CACHE_CHARS:
            return self._whole(f" {word}")
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        ids = self.cache[word] = self._piece(f" {word}")
        return ids

    def _cut(self, text: str) -> bytes:
        return b"".join([self._piece(p if k == 0 else f" {p}") for k, p in enumerate(self.cut(text))])

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, ``end_id`` after each, and how many each has, that one included.

        Distinct pieces of all texts are encoded once; the ids are then put
        together by whole arrays. The first piece of a text has no space before
        it; a text that can't be cut at its spaces is one piece.
        """
        pieces = Pieces(texts)
        found = list(map(self.cache.get, pieces.distinct))
        uncut = np.zeros(len(found), bool)
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = self._after_space(pieces.distinct[k])
                if found[k] is None:
                    found[k], uncut[k] = b"", True
        none, end = len(found), len(found) + 1
        found += [b"", np.array([end_id], self.dtype).tobytes()]
        firsts = np.array([not w or w[-1].isspace() for w in pieces.distinct], bool)[pieces.codes[pieces.starts]]
        whole = set(pieces.texts_with(uncut, but_first=True).tolist()) | set(np.flatnonzero(firsts).tolist())
        codes = np.empty(len(pieces.codes) + len(texts), np.int64)
        text_number = np.arange(len(texts))
        codes[np.arange(len(pieces.codes)) + np.repeat(text_number, pieces.sizes)] = pieces.codes
        codes[pieces.ends + text_number] = end
        for k, first in enumerate(pieces.codes[pieces.starts].tolist()):
            at = pieces.starts[k] + k
            if k in whole:
                codes[at : at + pieces.sizes[k]] = none
                ids = self._cut(texts[k].as_py())
            else:
                ids = self._piece(pieces.distinct[first])
            codes[at] = len(found)
            found.append(ids)
        ends = np.cumsum([len(x) for x in found]) // self.dtype.itemsize
        ids, n = gathered(np.frombuffer(b"".join(found), self.dtype), ends, codes)
        return ids, np.add.reduceat(n, pieces.starts + text_number)


class SequenceFile:
    """Writes ids into an Arrow file of fixed-size lists: ``ids``, and ``mask``, true where an id stands."""

    def __init__(self, uri: str, dtype: np.dtype, sequence: int):
        self.fs, self.path = fs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.dtype, self.sequence, self.n, self.buffer, self.held = dtype, sequence, 0, [], 0
        kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self.sink = self.fs.open_output_stream(self.path)
        self.writer = pa.ipc.new_file(self.sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.buffer.append(ids)
        self.held += len(ids)
        self.n += len(ids)
        if self.held >= BATCH_ROWS * self.sequence:
            self._write(False)

    def _write(self, last: bool) -> None:
        ids = np.concatenate([*self.buffer, np.zeros(0, self.dtype)])
        size = self.sequence * BATCH_ROWS
        end = len(ids) if last else len(ids) // size * size
        for at in range(0, end, size):
            part = ids[at : min(at + size, end)]
            rows = -(-len(part) // self.sequence)
            mask = np.arange(rows * self.sequence) < len(part)
            part = np.concatenate([part, np.zeros(len(mask) - len(part), self.dtype)])
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (part, mask)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.buffer, self.held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        if self.held:
            self._write(True)
        self.writer.close()
        self.sink.close()


class SequenceReader:
    """Random access to a file of ``SequenceFile``; local files are mapped, and ids are views of the map."""

    def __init__(self, uri: str):
        where, path = fs.FileSystem.from_uri(uri)
        self.source = pa.memory_map(path) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.sequence = self.file.schema.field("ids").type.list_size
        self.last: tuple[int, np.ndarray] | None = None

    def _batch(self, k: int) -> np.ndarray:
        if self.last is None or self.last[0] != k:
            self.last = k, self.file.get_batch(k).column("ids").flatten().to_numpy()
        return self.last[1]

    def sequence_and_mask(self, row: int) -> tuple[pa.Array, pa.BooleanArray]:
        """Both are views of the file, of numbers and of bits; nothing is copied."""
        batch, k = self.file.get_batch(row // BATCH_ROWS), row % BATCH_ROWS
        return batch.column("ids")[k].values, batch.column("mask")[k].values

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Ids ``start`` to ``start + n`` of the file, as one view for each batch they touch."""
        size = self.sequence * BATCH_ROWS
        while n > 0:
            k, at = divmod(start, size)
            part = self._batch(k)[at : at + n]
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self.source.close()


def write_files(docs: DataFrame, out: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Writes the token ids of ``docs`` in ascending id order and returns the index (doc_id, path, at, n_tokens).

    Texts are dealt out by ranges of the id, and each task writes one file of
    its range: ``at`` is where the document's ids begin there. A file's name has
    the number of the task attempt, and only what a successful attempt returns
    comes into the index, so files of failed or doubled attempts are never read.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encoder, file, path = TaskContext.get(), _encoder(tokenizer_file), None, None
        for b in batches:
            at, n_tokens = [], []
            for texts in slices(b.column(1)):
                if file is None:
                    path = f"{out}/part-{task.partitionId():06d}-{task.taskAttemptId()}.arrow"
                    file = SequenceFile(path, encoder.dtype, sequence)
                ids, n = encoder.encode(texts, end_id)
                at.append(file.n + np.cumsum(n) - n)
                n_tokens.append(n)
                file.add(ids)
            if at:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([path] * b.num_rows, pa.string()), pa.array(np.concatenate(at)), pa.array(np.concatenate(n_tokens))], ["doc_id", "path", "at", "n_tokens"])
        if file is not None:
            file.close()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return saved(dealt.mapInArrow(of, "doc_id long, path string, at long, n_tokens long"), "token-index")


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(tokenizer_file: str) -> WordEncoder:
    """One for each Python worker, which serves many tasks."""
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


def read_files(index: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) from the files of ``index``.

    ``start`` counts the ids of all documents before. It is ``at`` plus the sizes
    of earlier files; one row for each file meets in that window. Each file's
    part of the index goes to one task, which maps the file and walks through it.
    """
    files = index.groupBy("path").agg(F.min("doc_id").alias("first_id"), F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("first_id", "path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = index.join(files.select("path", before.alias("before")), "path").repartition("path").sortWithinPartitions("path", "at")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, path = None, None
        for b in batches:
            crcs = []
            for p, at, n in zip(b.column("path").to_pylist(), b.column("at").to_pylist(), b.column("n_tokens").to_pylist(), strict=True):
                if p != path:
                    if reader:
                        reader.close()
                    reader, path = SequenceReader(p), p
                crc = 0
                for part in reader.ids(at, n):
                    crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
        if reader:
            reader.last = None
            reader.close()

    rows = placed.select("doc_id", "path", "at", (F.col("before") + F.col("at")).alias("start"), "n_tokens")
    return rows.mapInArrow(of, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_file: str, out: str | None = None) -> DataFrame:
    """Writes the files of ``docs`` and reads them back: one row (doc_id, start, n_tokens, ids_crc32) per row.

    A null or empty text has its end id only. Rows that share an id follow one
    another, ordered by text; a null id comes first. An empty table gives no
    rows and no files. ``out`` is a folder that all executors reach; by default
    one in the shared folder.
    """
    return read_files(write_files(docs, out or new_folder(docs.sparkSession, "token-files"), tokenizer_file))
