"""Removal of byte strings that a document with a smaller id has too, by sharded suffix arrays (operator 12).

Every window of ``width`` bytes has an anchor, the least (by a hash) of the
strings of ``ANCHOR`` bytes in it, so equal windows have equal anchors wherever
they are. Successive windows with one anchor are one string. The steps:

1. Documents are packed into blocks of about ``BLOCK_BYTES``, written once.
2. Blocks tell the hashes of their anchors, and learn which of them a second
   document has. Windows of other anchors repeat nowhere.
3. The strings of shared anchors, once for each block and with the least id
   that has them there, go to shards by anchor. A shard builds the suffix array
   of its strings by induced sorting and their permuted common prefixes: runs
   of suffixes that share ``width`` bytes are one window's holders, and the
   least of them goes back to the blocks, where it is news.
4. Blocks mark the windows that a smaller id has, and cut them out.

An anchor with more than ``HOT`` occurrences could make its shard large. Its
windows get an anchor of ``FINER`` bytes instead, and steps 2 and 3 are taken
again with these: what stands around a common anchor differs, so most windows
drop out, and the rest is a few strings. Windows of finer anchors that are hot
again are grouped by their bytes, with the least id combined before the
shuffle; of a block's copies only one takes part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved
from tessera.llm.shingles import mix
from tessera.llm.suffix_array import least_holders

WIDTH = 50
ANCHOR, FINER = 16, 32
BLOCK_BYTES = 2_000_000
SHARD_BYTES = 4_000_000
#: Text in one bucket of anchors.
BUCKET_BYTES = 32_000_000
HOT = 4096
#: Windows that are looked at together, and of one string at most.
CHUNK, RUN = 1 << 17, 1 << 10  # a string has less than 2 ** 16 bytes
LAST = np.iinfo(np.int64).max

_SHARED = "block long, bucket int, mask binary, n long, n_hot long"
_TOLD = "bucket int, block long, low binary, times binary, twice binary"
_STRINGS = "shard int, block long, kind int, sid binary, size binary, holder binary, z binary"
_FOUND = "block long, kind int, sid array<int>, at array<int>, holder array<long>"
#: Strings of anchors and of finer anchors, and windows of their own.
STRING, FINER_STRING, WINDOW = 1, 2, 3
_Z = pa.Codec("zstd")


def _squeezed(a: np.ndarray | bytes) -> bytes:
    raw = a if isinstance(a, bytes) else a.tobytes()
    return len(raw).to_bytes(8, "little") + _Z.compress(raw, asbytes=True)


def _restored(z: bytes, dtype: type = np.uint8) -> np.ndarray:
    n = int.from_bytes(z[:8], "little")
    return np.frombuffer(_Z.decompress(z[8:], n, asbytes=True) if n else b"", dtype)


def blocks(docs: DataFrame) -> DataFrame:
    """Rows (block, ids, sizes, bytes, z): whole documents in packs, the bytes of their texts compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def row() -> pa.RecordBatch:
            sizes = [len(t) for t in texts]
            return pa.RecordBatch.from_pydict({"block": pa.array([(part << 32) + k], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([sizes], pa.list_(pa.int64())), "bytes": pa.array([sum(sizes)], pa.int64()), "z": pa.array([_squeezed(b"".join(texts))], pa.binary())})

        for b in batches:
            for i, t in zip(b["doc_id"].to_pylist(), b["text"].cast(pa.binary()).to_pylist(), strict=True):
                if ids and held + len(t or b"") > BLOCK_BYTES:
                    yield row()
                    k, ids, texts, held = k + 1, [], [], 0
                ids.append(i)
                texts.append(t or b"")
                held += len(texts[-1])
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(pack, "block long, ids array<long>, sizes array<long>, bytes long, z binary")


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` successive values."""
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if width > size else h


def _spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of both: anchors only need that the leading bits tell strings apart."""
    x = b >> np.uint64(31)
    x ^= b
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x += a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    return x


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on, of ``ANCHOR`` to twice as many."""
    n = len(data)
    padded = np.zeros((n + 23) // 8 * 8, np.uint8)
    padded[:n] = data
    words = np.ndarray((len(padded) - 8,), "<u8", padded, strides=(1,)).astype(np.uint64)
    m = n - ANCHOR + 1
    one = _spread(words[:m], words[8 : 8 + m])
    return _spread(one[: n - size + 1], one[size - ANCHOR :]) if size > ANCHOR else one


def runs(data: np.ndarray, ends: np.ndarray, width: int, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings of windows with one anchor: the first window's place, the number of windows, and the anchor's hash; none crosses the end of a document."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    closed = np.zeros(len(data) + 1, np.int32)  # places where a window would cross the end of its document
    begins = ends - np.diff(ends, prepend=0)
    np.add.at(closed, np.maximum(begins, ends - width + 1), 1)
    np.add.at(closed, ends, -1)
    closed = np.cumsum(closed[:-1]) > 0
    out: list[tuple[np.ndarray, ...]] = []
    for lo in range(0, n, CHUNK):
        hi = min(lo + CHUNK, n)
        anchor = _least(_grams(data[lo : hi + width - 1], size), width - size + 1)
        valid = ~closed[lo:hi]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | ~valid[:-1])
        first = np.flatnonzero(new & valid)
        border = np.flatnonzero(new | ~valid)
        stop = np.append(border, hi - lo)[np.searchsorted(border, first, side="right")]
        parts = -(-(stop - first) // RUN)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(first, parts) + step * RUN
        out.append((start + lo, np.minimum(np.repeat(stop, parts) - start, RUN), mix(anchor[start] ^ np.uint64(0x5851F42D4C957F2D))))  # the least hashes are small: mixed again, they spread
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def _bucket(anchors: np.ndarray, bits: int) -> np.ndarray:
    return (anchors >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(anchors), np.int64)


class _Runs:
    """Strings of windows with one anchor, and the document of each."""

    def __init__(self, place: np.ndarray, count: np.ndarray, anchor: np.ndarray, doc: np.ndarray):
        self.place, self.count, self.anchor, self.doc = place, count, anchor, doc
        self.kinds: np.ndarray | None = None

    def of(self, mask: np.ndarray, kind: int) -> np.ndarray:
        """The runs whose anchors ``mask``, which goes with the distinct anchors in order, calls normal (1) or hot (2)."""
        if self.kinds is None:
            self.kinds = mask[np.unique(self.anchor, return_inverse=True)[1]] if len(self.anchor) else np.zeros(0, np.uint8)
        return np.flatnonzero(self.kinds == kind)


class _Block:
    """A block's texts and their strings; ``masks`` are what it was told about its anchors and about its finer ones."""

    def __init__(self, ids: list, sizes: list[int], z: bytes, width: int, masks: tuple[np.ndarray, ...] = ()):
        self.ids, self.width, self.masks = ids, width, masks
        self.data = _restored(z)
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        place, count, anchor = runs(self.data, self.ends, width)
        self.rank = np.array([LAST if i is None else i for i in ids], np.int64)
        self.runs = _Runs(place, count, anchor, np.searchsorted(self.ends, place, side="right"))
        self.finer = self._finer() if masks else None

    def _finer(self) -> _Runs:
        """The windows of hot anchors as runs of finer ones."""
        hot = self.runs.of(self.masks[0], 2)
        place, size = self.runs.place[hot], self.runs.count[hot] + self.width - 1
        ends = np.cumsum(size)
        begins = ends - size
        at, count, anchor = runs(self.data[np.arange(size.sum()) + np.repeat(place - begins, size)], ends, self.width, min(FINER, self.width))
        run = np.searchsorted(ends, at, side="right")
        return _Runs(place[run] + at - begins[run], count, anchor, self.runs.doc[hot][run])

    def cut(self, kind: int) -> _Part:
        """The strings of one kind."""
        of = self.runs if kind == STRING else self.finer
        runs = of.of(self.masks[kind != STRING], 2 if kind == WINDOW else 1)
        place, count = of.place[runs], of.count[runs]
        if kind == WINDOW:
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            runs, place = np.repeat(runs, count), np.repeat(place, count) + within
            count = np.ones(len(place), np.int64)
        return _Part(self.data, place, count, self.rank[of.doc[runs]], of.anchor[runs], self.width)


class _Part:
    """Strings of a block by their places, and the distinct ones by number, with the least id that has each."""

    def __init__(self, data: np.ndarray, at: np.ndarray, windows: np.ndarray, owner: np.ndarray, anchor: np.ndarray, width: int):
        self.at, self.windows, self.owner = at, windows, owner
        raw, known = data.tobytes(), {}
        sid = [known.setdefault(raw[a : a + n], len(known)) for a, n in zip(at.tolist(), (windows + width - 1).tolist(), strict=True)]
        self.strings: list[bytes] = list(known)
        self.sid = np.array(sid, np.int64)
        first = np.unique(self.sid, return_index=True)[1]
        self.anchor, self.n_windows = anchor[first], windows[first]
        self.holder = np.full(len(known), LAST, np.int64)
        np.minimum.at(self.holder, self.sid, owner)

    def hits(self, sid: np.ndarray, at: np.ndarray, holder: np.ndarray) -> np.ndarray:
        """The places of windows that a smaller id than their owner's has, by news of where the least holder of a string changes."""
        if not len(self.at):
            return self.at
        base = np.cumsum(self.n_windows) - self.n_windows
        value = np.repeat(self.holder, self.n_windows)
        known = np.zeros(len(value), bool)
        known[base] = True
        value[base[sid] + at], known[base[sid] + at] = holder, True
        value = value[np.maximum.accumulate(np.where(known, np.arange(len(value)), 0))]
        step = np.arange(self.windows.sum()) - np.repeat(np.cumsum(self.windows) - self.windows, self.windows)
        smaller = value[np.repeat(base[self.sid], self.windows) + step] < np.repeat(self.owner, self.windows)
        return (np.repeat(self.at, self.windows) + step)[smaller]


def _telling(block: int, runs: _Runs, bits: int) -> pa.Table:
    """The anchors of a block, in buckets."""
    out = {"bucket": [], "block": [], "low": [], "times": [], "twice": []}
    order = np.argsort(runs.anchor, kind="stable")
    anchors, doc = runs.anchor[order], runs.doc[order]
    if len(anchors):
        first = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        last = np.append(first[1:], len(anchors)) - 1
        names, times, twice = anchors[first], (last - first + 1).astype(np.uint32), doc[first] != doc[last]
        low = ((names << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
        buckets, at = np.unique(_bucket(names, bits), return_index=True)
        for k, lo, hi in zip(buckets.tolist(), at.tolist(), [*at[1:].tolist(), len(names)], strict=True):
            one = (k, block, _squeezed(np.diff(low[lo:hi], prepend=np.uint32(0))), _squeezed(times[lo:hi]), _squeezed(twice[lo:hi]))
            for c, v in zip(out, one, strict=True):
                out[c].append(v)
    return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), (pa.int32(), pa.int64(), *[pa.binary()] * 3), strict=True)})


def _anchors(width: int, bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield from _telling(r["block"], _Block(r["ids"], r["sizes"], r["z"], width).runs, bits).to_batches()

    return work


def _finer_anchors(width: int, bits: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        return _telling(left["block"][0].as_py(), _block_of(left, right, width).finer, bits)

    return work


def _sharing(hot: int):
    def work(table: pa.Table) -> pa.Table:
        lows = [np.cumsum(_restored(z, np.uint32), dtype=np.uint32) for z in table["low"].to_pylist()]
        low = np.concatenate(lows)
        times = np.concatenate([_restored(z, np.uint32) for z in table["times"].to_pylist()]).astype(np.int64)
        twice = np.concatenate([_restored(z, np.bool_) for z in table["twice"].to_pylist()])
        order = np.argsort(low, kind="stable")
        first = np.flatnonzero(np.append(True, low[order][1:] != low[order][:-1]))
        size = np.diff(np.append(first, len(low)))
        shared = (size > 1) | np.logical_or.reduceat(twice[order], first)
        kind = np.where(shared, np.where(np.add.reduceat(times[order], first) > hot, 2, 1), 0).astype(np.uint8)
        mask = np.empty(len(low), np.uint8)
        mask[order] = np.repeat(kind, size)
        ends = np.cumsum([len(x) for x in lows]).tolist()
        parts = [(mask[e - len(x) : e], times[e - len(x) : e]) for e, x in zip(ends, lows, strict=True)]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "mask": pa.array([_squeezed(m) for m, _ in parts], pa.binary()), "n": pa.array([int(t[m == 1].sum()) for m, t in parts], pa.int64()), "n_hot": pa.array([int((m == 2).sum()) for m, _ in parts], pa.int64())})

    return work


def _block_of(left: pa.Table, right: pa.Table, width: int) -> _Block:
    r = left.to_pylist()[0]
    told = right.filter(pc.is_valid(right["bucket"])).sort_by("bucket")
    masks = [told.filter(pc.equal(told["level"], k))["mask"].to_pylist() for k in (1, 2)]
    return _Block(r["ids"], r["sizes"], r["z"], width, tuple(np.concatenate([np.zeros(0, np.uint8), *map(_restored, m)]) for m in masks))


def _strings(width: int, shards: int):
    """The distinct strings of a block's shared anchors and finer anchors, by shard."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"shard": [], "block": [], "kind": [], "sid": [], "size": [], "holder": [], "z": []}
        block = _block_of(left, right, width) if left.num_rows else None
        for kind in (STRING, FINER_STRING) if block else ():
            x = block.cut(kind)
            shard = (x.anchor % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            names, first = np.unique(shard[order], return_index=True)
            for k, at in zip(names.tolist(), np.split(order, first[1:]), strict=False):
                own = [x.strings[i] for i in at.tolist()]
                row = (k, left["block"][0].as_py(), kind, _squeezed(np.diff(at.astype(np.int32), prepend=np.int32(0))), _squeezed((x.n_windows[at] + width - 1).astype(np.uint16)), _squeezed(x.holder[at]), _squeezed(b"".join(own)))
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)
        kinds = (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4)
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})

    return work


def _hot_windows(width: int):
    """The distinct windows of a block's finer anchors that are hot, one a row."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        x = _block_of(left, right, width).cut(WINDOW)
        n = len(x.strings)
        return pa.table({"w": pa.array(x.strings, pa.binary()), "block": pa.array(np.full(n, left["block"][0].as_py(), np.int64)), "sid": pa.array(np.arange(n, dtype=np.int32)), "holder": pa.array(x.holder)})

    return work


def _news(block: list[int], kind: list[int], sid: list, at: list, holder: list) -> pa.Table:
    return pa.table({"block": pa.array(block, pa.int64()), "kind": pa.array(kind, pa.int32()), "sid": pa.array(sid, pa.list_(pa.int32())), "at": pa.array(at, pa.list_(pa.int32())), "holder": pa.array(holder, pa.list_(pa.int64()))})


def _shard(width: int):
    """The suffix array of a shard; for each block, where the least holder of a string's windows changes, if it isn't the block's own."""

    def work(table: pa.Table) -> pa.Table:
        column = lambda c, kind: [_restored(z, kind) for z in table[c].to_pylist()]
        blocks, kinds, rows = table["block"].to_pylist(), table["kind"].to_pylist(), [np.cumsum(x) for x in column("sid", np.int32)]
        n_rows, sids, raw = [len(x) for x in rows], np.concatenate(rows), np.concatenate(column("z", np.uint8)).tobytes()
        size, holder = np.concatenate(column("size", np.uint16)).astype(np.int64), np.concatenate(column("holder", np.int64))
        known: dict[bytes, int] = {}
        ends = np.cumsum(size).tolist()
        content = np.array([known.setdefault(raw[b - n : b], len(known)) for b, n in zip(ends, size.tolist(), strict=True)], np.int64)  # equal strings of several blocks once
        sizes = np.array([len(s) for s in known], np.int64)
        holders = np.full(len(known), LAST, np.int64)
        np.minimum.at(holders, content, holder)
        least, starts = least_holders(np.frombuffer(b"".join(known), np.uint8), sizes, holders, width)
        n = size - width + 1
        string = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(string)) - np.repeat(np.cumsum(n) - n, n)
        value = least[starts[content[string]] + at]
        before = np.append(LAST, value[:-1])
        before[at == 0] = holder
        change = np.flatnonzero(value != before)
        ends = np.searchsorted(string[change], np.cumsum(n_rows))
        cut = [slice(a, b) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        some = [k for k, c in enumerate(cut) if c.stop > c.start]
        sids = sids[string[change]]
        return _news([blocks[k] for k in some], [kinds[k] for k in some], [sids[cut[k]] for k in some], [at[change[cut[k]]] for k in some], [value[change[cut[k]]] for k in some])

    return work


def _removal(width: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_bytes": [], "spans": [], "kept": []}
        if left.num_rows:
            x = _block_of(left, right, width)
            found = []
            for kind in (STRING, FINER_STRING, WINDOW):
                own = right.filter(pc.equal(right["kind"], kind))
                sid, at, holder = (own[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("sid", "at", "holder"))
                found.append(x.cut(kind).hits(sid, at, holder))
            at = np.concatenate(found)
            delta = np.zeros(len(x.data) + 1, np.int32)
            delta[at] += 1
            delta[at + width] -= 1
            gone = np.cumsum(delta[:-1]) > 0
            begins = x.ends - x.sizes
            edge = np.zeros(len(x.data) + 1, bool)
            edge[begins] = True
            first = np.flatnonzero(gone & (edge[:-1] | ~np.append(False, gone[:-1])))
            last = np.flatnonzero(gone & (edge[1:] | ~np.append(gone[1:], False) | (np.arange(1, len(gone) + 1) == len(gone)))) + 1
            raw = x.data.tobytes()
            for i, begin, end in zip(x.ids, begins.tolist(), x.ends.tolist(), strict=True):
                lo, hi = np.searchsorted(first, [begin, end]).tolist() if end > begin else (0, 0)
                spans = [(a - begin, b - begin) for a, b in zip(first[lo:hi].tolist(), last[lo:hi].tolist(), strict=True)]
                cuts = [0, *[p for s in spans for p in s], end - begin]
                out["doc_id"].append(i)
                out["n_bytes"].append(end - begin)
                out["spans"].append([{"start": a, "stop": b} for a, b in spans])
                out["kept"].append(b"".join(raw[begin + a : begin + b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.binary())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})

    return work


def without_repeats(docs: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, spans (start, stop of each maximal removed run of bytes), kept (the bytes that stay).

    A byte goes if a string of ``width`` bytes covers it that also starts in a
    row with a smaller id, judged on the whole input. Rows of one id don't
    remove each other; a null id is larger than all, and rows without an id
    don't remove each other either. Null text is empty. Other columns are
    ignored, whatever their names. An empty table has no rows.
    """
    if width < ANCHOR:
        raise ValueError(f"width below {ANCHOR}")
    packed = saved(blocks(docs), "blocks")
    total = packed.agg(F.sum("bytes")).first()[0] or 0
    bits = max(0, int(total // BUCKET_BYTES).bit_length())
    sharing = lambda told: told.groupBy("bucket").applyInArrow(_sharing(hot), _SHARED)
    met = lambda work, schema: packed.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(work, schema)
    shared = saved(sharing(packed.mapInArrow(_anchors(width, bits), _TOLD)).withColumn("level", F.lit(1)), "shared-anchors")
    if shared.where("n_hot > 0").limit(1).count():
        shared = shared.unionByName(saved(sharing(met(_finer_anchors(width, bits), _TOLD)).withColumn("level", F.lit(2)), "shared-finer-anchors"))
    sums = shared.agg(F.sum("n").alias("n"), F.count_if(F.expr("level = 2 and n_hot > 0")).alias("hot")).first()
    shards = 1 + (sums["n"] or 0) * 3 * width // 2 // SHARD_BYTES
    news = met(_strings(width, shards), _STRINGS).groupBy("shard").applyInArrow(_shard(width), _FOUND)
    if sums["hot"]:
        windows = saved(met(_hot_windows(width), "w binary, block long, sid int, holder long"), "hot-windows")
        least = windows.groupBy("w").agg(F.min("holder").alias("least"))
        told = windows.join(least, "w").where(F.col("least") < F.col("holder"))
        news = news.unionByName(told.select("block", F.lit(WINDOW).alias("kind"), F.array("sid").alias("sid"), F.array(F.lit(0)).alias("at"), F.array("least").alias("holder")))
    found = saved(news, "holders")
    known = shared.select("block", "level", "bucket", "mask").unionByName(found, allowMissingColumns=True)
    return packed.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_removal(width), "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of ``without_repeats``."""
    found = without_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
