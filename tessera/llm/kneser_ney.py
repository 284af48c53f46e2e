"""Perplexity under an interpolated modified Kneser-Ney model, as a quality classifier (operator 10).

Model and documents both grow with the input, so no task holds the whole of
either. Texts are packs of word numbers; a pack sends its distinct trigrams,
each with its count in training texts, to shards by their middle word. There a
trigram's counts, those of its bigram and of both contexts meet, since they all
share that word, and the pack gets them back: whole numbers, small ones mostly,
from which it works out probabilities. No model is written. Packs lie in
buckets, so they are never shuffled themselves.

``fit`` makes the same model as a table of its own, to be kept for later texts.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, new_folder, saved
from tessera.operators.ranking import global_rank
from tessera.operators.work import shuffles_dropped

#: The share of trusted documents that the model is fitted on; the others are held out.
TRAIN_SHARE = 0.8
MIN_WORD_COUNT = 2
#: A document is kept up to this quantile of the perplexity of held-out trusted texts in its language.
QUANTILE = 0.995
#: Languages with fewer held-out trusted texts take the threshold of all languages together.
MIN_HELD_OUT = 100
SHARDS = 16
#: Trusted ids are broadcast up to so many.
MAX_TRUSTED = 1_000_000
#: Known words are sent to the workers up to so many; beyond, packs ask for theirs by joins.
MAX_WORDS = 1_000_000
#: Text in a pack, and tokens of all packs to one shard of what they ask.
PACK_BYTES, SHARD_TOKENS = 4_000_000, 8_000_000
#: Packs ask in so many rounds, each time a part of the shards, and are scored in as many, each time a part of the packs, so that only these questions and answers are shuffled at once.
ROUNDS = 2
#: Texts that a task has in Python at once.
SLICE = 1024
CACHE_WORDS = 400_000
#: Tokens that are scored at once.
STRETCH = 1 << 18

#: A token: a run of word characters, or of other signs, of the lower-cased text.
TOKEN = re.compile(r"\w+|[^\w\s]+")
UNKNOWN, START = 0, 1
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
#: Kinds of model rows: log10 p of seen n-grams of order 1 to 3, and log10 backoff weight of contexts of 1 and 2 words.
P1, P2, P3, B1, B2 = 1, 2, 3, 4, 5
NONE, TRAIN, HELD = 0, 1, 2
_Z = pa.Codec("zstd")
_LOW = np.uint64(0xFFFFFFFF)
_WORD, _SHORT = np.uint64(32), np.uint64(21)
_PACK = "block long, part array<int>, lang array<string>, size array<long>, "
_ASKED = "shard int, block long, b binary, c binary, many binary, a binary, n binary, more binary"
_TOLD = "block long, shard int, n3 binary, n2 binary, t3 binary, t2 binary, of_counts array<long>, id array<long>, n array<long>"


def word_id(word: str) -> int:
    """The 64-bit number of a token."""
    return max(xxhash.xxh64_intdigest(word, 7), 2)


def mixed(*words: np.ndarray) -> np.ndarray:
    """One 64-bit key of a run of word numbers."""
    key = words[0].copy()
    for w in words[1:]:
        key = (key ^ (key >> np.uint64(29))) * _MUL[0] + w * _MUL[1]
    key ^= key >> np.uint64(32)
    return key * _MUL[0]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _squeezed(a: np.ndarray) -> bytes:
    """The bytes of ``a``, compressed, those of one weight together."""
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return len(a).to_bytes(8, "little") + _Z.compress(raw, asbytes=True)


def _restored(z: bytes, dtype: type) -> np.ndarray:
    n, size = int.from_bytes(z[:8], "little"), np.dtype(dtype).itemsize
    raw = _Z.decompress(z[8:], n * size, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).reshape(-1).view(dtype)


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``part``: ``TRAIN`` or ``HELD`` for trusted texts, else ``NONE``.

    Trusted are documents labelled quality 1 and not toxic. Of these a hash of
    the id puts ``TRAIN_SHARE`` into training, however many there are, so that
    reruns agree and no table meets in one task.
    """
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id", F.lit(True).alias("good")).distinct()
    train = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(1_000_000)) < int(TRAIN_SHARE * 1e6)
    rows = docs.join(broadcast_if_small(good, good.count(), MAX_TRUSTED), "doc_id", "left")
    return rows.withColumn("part", F.when(F.col("good").isNull() | F.col("text").isNull(), NONE).when(train, TRAIN).otherwise(HELD)).drop("good")


def _pack_schema(kind: str, rest: str) -> str:
    return _PACK.replace("part", f"doc_id array<{kind}>, part", 1) + rest


def _ids(words: np.ndarray, codes: np.ndarray, size: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> tuple[bytes, list[int], list[int]]:
    """The tokens of a pack as the ids of their words (``keys``, in order, with ``ids``), ``UNKNOWN`` for others, and those that are a thousandth of all and more, start marks included, with their counts."""
    own = np.full(len(words), UNKNOWN, np.uint64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
        own = np.where(keys[at] == words, ids[at], own)
    n = np.bincount(codes, minlength=len(words))
    often, which = np.unique(np.append(own, np.uint64(START)), return_inverse=True)
    n = np.bincount(which, np.append(n, 2 * len(size))).astype(np.int64)
    common = np.flatnonzero(n * 1000 >= n.sum())
    return _squeezed(own[codes]), _signed(often[common]).tolist(), n[common].tolist()


def _packed(rows: DataFrame, made: Callable[[dict, np.ndarray, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``made`` makes of the texts of ``rows`` (doc_id, lang, text, part) in packs of about ``PACK_BYTES``: of a pack's columns, its distinct words by number, and the place among them of each token."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k, held = TaskContext.get().partitionId(), 0, 0
        meta, size, codes, seen = [], [], [], defaultdict(count().__next__)

        def row() -> pa.RecordBatch:
            t = pa.Table.from_batches(meta)
            one = {"block": pa.array([(task << 32) + k], pa.int64())}
            one |= {c: pa.array([t[c].to_pylist()], pa.list_(t.schema.field(c).type)) for c in t.column_names}
            one |= {"size": pa.array([size], pa.list_(pa.int64()))}
            return made(one, np.array([word_id(w) for w in seen], np.uint64), np.concatenate([*codes, np.zeros(0, np.uint32)]))

        for b in (x.slice(at, SLICE) for x in batches for at in range(0, x.num_rows, SLICE)):
            first = 0
            for i, text in enumerate(b["text"].to_pylist()):
                words = TOKEN.findall((text or "").lower())
                codes.append(np.fromiter(map(seen.__getitem__, words), np.uint32, len(words)))
                size.append(len(words))
                held += len(text or "")
                if held >= PACK_BYTES:
                    meta.append(b.select(["doc_id", "part", "lang"]).slice(first, i + 1 - first))
                    yield row()
                    k, held, first = k + 1, 0, i + 1
                    meta, size, codes, seen = [], [], [], defaultdict(count().__next__)
            if first < b.num_rows:
                meta.append(b.select(["doc_id", "part", "lang"]).slice(first))
        if size:
            yield row()

    return rows.select("doc_id", F.col("part").cast("int").alias("part"), "lang", "text").mapInArrow(of, schema)


def word_counts(rows: DataFrame) -> DataFrame:
    """Rows (w, n): the words of all texts of ``rows``, by number."""

    def made(pack: dict, words: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(_signed(words)), pa.array(np.bincount(codes, minlength=len(words)), pa.int64())], ["w", "n"])

    return _packed(rows, made, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def learnt_words(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows (w, n) for the words that come ``MIN_WORD_COUNT`` times or more, and how many others there are."""
    known = F.when(F.col("n") >= MIN_WORD_COUNT, F.col("w"))
    words = saved(word_counts(rows).groupBy(known.alias("w")).agg(F.sum("n").alias("n"), F.count("*").alias("words")), "words")
    rare = words.where("w is null").first()
    return words.where("w is not null").select("w", "n"), rare["words"] if rare else 0


def numbered(rows: DataFrame, known: DataFrame, size: int) -> DataFrame:
    """Rows (block, doc_id, part, lang, size, ids, common, times): the texts of ``rows`` (doc_id, lang, text, part) in packs, their tokens as the ids of the ``size`` words in ``known`` (w, id), and the ids that are common with their counts."""
    spark, lists = rows.sparkSession, pa.list_(pa.int64())
    kind = dict(rows.dtypes)["doc_id"]
    schema = _pack_schema(kind, "ids binary, common array<long>, times array<long>")
    if size <= MAX_WORDS:
        t = known.toArrow()
        keys, ids = (t[c].to_numpy().view(np.uint64) for c in ("w", "id"))
        order = np.argsort(keys)
        sent = spark.sparkContext.broadcast((keys[order], ids[order].astype(np.uint32 if size and ids.max() <= _LOW else np.uint64)))

        def made(pack: dict, words: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
            ids, common, times = _ids(words, codes, pack["size"].values.to_numpy(), *sent.value)
            return pa.RecordBatch.from_pydict(pack | {"ids": pa.array([ids], pa.binary()), "common": pa.array([common], lists), "times": pa.array([times], lists)})

        return _packed(rows, made, schema)

    def apart(pack: dict, words: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(pack | {"words": pa.array([_squeezed(words)], pa.binary()), "codes": pa.array([_squeezed(codes)], pa.binary())})

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, z in zip(b["block"].to_pylist(), b["words"].to_pylist(), strict=True):
                w = _signed(_restored(z, np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), block)), pa.array(w)], ["block", "w"])

    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, ids = (right[c].to_numpy().view(np.uint64) for c in ("w", "id"))
        order = np.argsort(keys)
        found = []
        for r in left.select(["words", "codes", "size"]).to_pylist():
            found.append(_ids(_restored(r["words"], np.uint64), _restored(r["codes"], np.uint32), np.array(r["size"]), keys[order], ids[order]))
        out = left.drop_columns(["words", "codes"])
        for c, kind, v in zip(("ids", "common", "times"), (pa.binary(), lists, lists), zip(*found, strict=True) if found else ([], [], []), strict=True):
            out = out.append_column(c, pa.array(list(v), kind))
        return out

    packed = saved(_packed(rows, apart, _pack_schema(kind, "words binary, codes binary")), "packs-of-words")
    told = packed.select("block", "words").mapInArrow(words, "block long, w long").join(known, "w").select("block", "w", "id")
    return packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(of, schema)


def _stream(ids: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ids of all tokens, two start marks before each text."""
    out = np.full(len(ids) + 2 * len(size), START, np.uint64)
    out[np.arange(len(ids)) + 2 * (np.repeat(np.arange(len(size)), size) + 1)] = ids
    return out


def _trigrams(ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token with the two before it."""
    w = _stream(ids, size)
    at = np.flatnonzero(w[2:] != START)
    return w[at], w[at + 1], w[at + 2]


def trigram_counts(packed: DataFrame) -> DataFrame:
    """Rows (w1, w2, w3, n): counts of word trigrams of all texts in packs.

    A text begins with two start marks. Words seen once are one unknown word.

    Python only counts within its pack; counts are added up by Spark.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for size, ids in zip(b["size"].to_pylist(), b["ids"].to_pylist(), strict=True):
                w = _trigrams(_restored(ids, np.uint64), np.array(size, np.int64))
                _, first, n = np.unique(mixed(*w), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(_signed(x[first])) for x in w], pa.array(n, pa.int64())], ["w1", "w2", "w3", "n"])

    return packed.select("size", "ids").mapInArrow(of, "w1 long, w2 long, w3 long, n long").groupBy("w1", "w2", "w3").agg(F.sum("n").alias("n"))


def _discount(counts: list[int | None]) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more, by how many counts are 1, 2, 3 and 4."""
    n = [float(x or 0) for x in counts]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else y for k in range(3)]
    return [min(max(d, 0.01), k + 0.99) for k, d in enumerate(found)]


def _of_counts(counts: DataFrame) -> list[int]:
    return list(counts.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first())


def fit(texts: DataFrame) -> tuple[DataFrame, tuple[float, float]]:
    """The model of all of ``texts`` (text), see ``interpolated``."""
    rows = texts.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("lang"), "text", F.lit(TRAIN).alias("part"))
    words, rare = learnt_words(rows)
    return interpolated(trigram_counts(numbered(rows, words.select("w", F.col("w").alias("id")), words.count())), rare)


def interpolated(c3: DataFrame, rare: int) -> tuple[DataFrame, tuple[float, float]]:
    """The model's rows (kind, key parts, value) from counts of trigrams, with log10 p of the unseen unknown word, and log10 of its share for one of the rare words it stands for.

    Order 3 uses counts, lower orders the number of distinct words to the left
    (at the start of a text, where there are none, counts). Each order is
    interpolated with the one below by joins on the shorter n-gram.
    """
    c3 = saved(c3, "trigrams")
    start = F.col("w2") == START
    c2 = saved(c3.groupBy("w2", "w3").agg(F.when(F.first("w2") == START, F.sum("n")).otherwise(F.count("*")).alias("n")), "bigrams")
    c1 = saved(c2.where(~start).groupBy("w3").agg(F.count("*").alias("n")), "unigrams")

    def levels(counts: DataFrame, context: list[str]) -> tuple[DataFrame, DataFrame]:
        d = _discount(_of_counts(counts))
        less = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        sums = counts.groupBy(*context).agg(F.sum("n").alias("total"), F.sum(less).alias("given"))
        seen = counts.join(sums, context) if context else counts.crossJoin(F.broadcast(sums))
        return seen.withColumn("own", F.greatest(F.col("n") - less, F.lit(0.0)) / F.col("total")).withColumn("gamma", F.col("given") / F.col("total")), sums.withColumn("gamma", F.col("given") / F.col("total"))

    size = c1.count() + 1
    s1, all1 = levels(c1, [])
    gamma1 = (all1.first() or {"gamma": None})["gamma"] or 1.0
    p1 = s1.select("w3", (F.col("own") + F.lit(gamma1) / size).alias("p1"))
    unseen = float(np.log10(gamma1 / size))
    s2, b1 = levels(c2, ["w2"])
    p2 = saved(s2.join(p1, "w3", "left").select("w2", "w3", (F.col("own") + F.col("gamma") * F.coalesce("p1", F.lit(gamma1 / size))).alias("p2")), "p2")
    s3, b2 = levels(c3, ["w1", "w2"])
    p3 = s3.join(p2, ["w2", "w3"]).select("w1", "w2", "w3", (F.col("own") + F.col("gamma") * F.col("p2")).alias("p3"))
    none = F.lit(None).cast("long")
    row = lambda df, kind, keys, value: df.select(F.lit(kind).alias("kind"), *[k.alias(f"k{i}") for i, k in enumerate(keys)], F.log10(value).alias("value"))
    rows = [
        row(p1, P1, [F.col("w3"), none, none], F.col("p1")),
        row(p2, P2, [F.col("w2"), F.col("w3"), none], F.col("p2")),
        row(p3, P3, [F.col("w1"), F.col("w2"), F.col("w3")], F.col("p3")),
        row(b1, B1, [F.col("w2"), none, none], F.col("gamma")),
        row(b2, B2, [F.col("w1"), F.col("w2"), none], F.col("gamma")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out, (unseen, -float(np.log10(rare + 1)))


class KeyTable:
    """Values by 64-bit key: sorted keys, and for each value of their leading bits where they begin, so a look-up reads one or two places."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = np.append(keys[order], np.uint64(0)), np.append(values[order], np.float32(0))
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted(keys[order] >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def look(self, keys: np.ndarray, missing: float) -> tuple[np.ndarray, np.ndarray]:
        """The value of each key, ``missing`` where there is none, and where there is one."""
        bucket = keys >> self.shift
        at, end = self.start[bucket], self.start[bucket + np.uint64(1)]
        found = (self.keys[at] == keys) & (at < end)
        more = np.flatnonzero(~found & (at + 1 < end))
        while len(more):
            at[more] += 1
            found[more] = self.keys[at[more]] == keys[more]
            more = more[~found[more] & (at[more] + 1 < end[more])]
        return np.where(found, self.values[at], missing), found


class Model:
    """A model in memory: one pack's part of it, as keys and values by kind, or a small one as a whole, from the files of ``save_model``."""

    def __init__(self, source: str | dict[int, tuple[np.ndarray, np.ndarray]], unseen: tuple[float, float]):
        tables = self._read(source) if isinstance(source, str) else source
        (self.unseen, self.rare), self.words = unseen, {}
        self.table = {k: KeyTable(*tables[k]) for k in (P1, P2, P3, B1, B2)}

    @staticmethod
    def _read(uri: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        where, path = fs.FileSystem.from_uri(uri)
        keys: dict[int, list] = {k: [] for k in (P1, P2, P3, B1, B2)}
        values: dict[int, list] = {k: [] for k in keys}
        for info in sorted(where.get_file_info(fs.FileSelector(path, recursive=True)), key=lambda i: i.path):
            if info.path.endswith(".parquet"):
                t = pq.read_table(info.path, filesystem=where)
                kind = t["kind"].to_numpy()
                for k in keys:
                    keys[k].append(t["key"].to_numpy()[kind == k].view(np.uint64))
                    values[k].append(t["value"].to_numpy()[kind == k])
        return {k: (np.concatenate([*keys[k], np.zeros(0, np.uint64)]), np.concatenate([*values[k], np.zeros(0, np.float32)])) for k in keys}

    def ids(self, text: str) -> np.ndarray:
        """Word numbers as the model knows them: ``UNKNOWN`` for words without a count of their own."""
        words = TOKEN.findall(text.lower())
        found = list(map(self.words.get, words))
        if None in found:
            new = list({w for w, i in zip(words, found, strict=True) if i is None})
            numbers = np.array([word_id(w) for w in new], np.uint64)
            known = np.where(self.table[P1].look(mixed(numbers), 0)[1], numbers, np.uint64(UNKNOWN)).tolist()
            own = dict(zip(new, known, strict=True))
            if len(self.words) > CACHE_WORDS:
                self.words.clear()
            self.words |= {w: i for w, i in own.items() if len(w) < 64}
            found = [own[w] if i is None else i for w, i in zip(words, found, strict=True)]
        return np.array(found, np.uint64)

    def log10_p(self, w: np.ndarray) -> np.ndarray:
        """log10 p of each word but the first two, given the two before; 0 for start marks."""
        a, b, c = w[:-2], w[1:-1], w[2:]
        out, found = self.table[P3].look(mixed(a, b, c), 0.0)
        found |= c == START
        if len(rest := np.flatnonzero(~found)):
            b, c = b[rest], c[rest]
            back = self.table[B2].look(mixed(a[rest], b), 0.0)[0]
            p2, found2 = self.table[P2].look(mixed(b, c), 0.0)
            if len(more := np.flatnonzero(~found2)):
                p2[more] = self.table[B1].look(mixed(b[more]), 0.0)[0] + self.table[P1].look(mixed(c[more]), self.unseen)[0]
            out[rest] = back + p2
        return np.where(w[2:] == START, 0.0, out + np.where(w[2:] == UNKNOWN, self.rare, 0.0))

    def perplexities(self, texts: Iterator[str | None]) -> Iterator[tuple[int, float | None]]:
        """The number of tokens and the perplexity of each text; None without a token. Texts are scored together, in stretches of bounded size."""
        held: list[np.ndarray] = []
        size = 0
        for text in texts:
            held.append(self.ids(text or ""))
            size += len(held[-1])
            if size >= STRETCH:
                yield from self.scored(held)
                held, size = [], 0
        yield from self.scored(held)

    def scored(self, held: list[np.ndarray]) -> Iterator[tuple[int, float | None]]:
        """``perplexities`` of texts as numbers of words."""
        if not held:
            return
        marks = np.full(2, START, np.uint64)
        w = np.concatenate([x for ids in held for x in (marks, ids)])
        sums = np.concatenate([[0.0], *[self.log10_p(w[at : at + STRETCH + 2]) for at in range(0, len(w) - 2, STRETCH)]]).cumsum()
        at = 0
        for ids in held:
            n = len(ids)
            yield n, float(10 ** -((sums[at + n] - sums[at]) / n)) if n else None
            at += n + 2


def _keyed(rows: DataFrame) -> DataFrame:
    """The model's rows as (kind, key, value): word runs become one 64-bit key."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = [b.column(f"k{i}").fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3)]
            kind = b.column("kind").to_numpy()
            key = np.where(np.isin(kind, (P1, B1)), mixed(k[0]), np.where(np.isin(kind, (P2, B2)), mixed(k[0], k[1]), mixed(*k)))
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(_signed(key)), b.column("value").cast(pa.float32())], ["kind", "key", "value"])

    return rows.mapInArrow(of, "kind int, key long, value float")


def save_model(rows: DataFrame, path: str) -> str:
    """Writes the model's rows as ``SHARDS`` Parquet shards by key."""
    _keyed(rows.repartition(SHARDS, "kind", "k0", "k1", "k2")).write.parquet(path)
    return path


def _distinct(bc: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ``bc`` in order; for each distinct pair (bc, a), in order, the place of its ``bc``, and its ``a``; for each row the place of its pair."""
    b, c = bc >> _WORD, bc & _LOW
    if not len(bc) or max(x.max() for x in (a, b, c)) >> _SHORT:
        two, i = np.unique(bc, return_inverse=True)
        pairs, of = np.unique(i.astype(np.uint64) << _WORD | a, return_inverse=True)
        return two, (pairs >> _WORD).astype(np.int64), pairs & _LOW, of
    low = (np.uint64(1) << _SHORT) - np.uint64(1)
    pairs, of = np.unique((b << _SHORT | c) << _SHORT | a, return_inverse=True)
    two = pairs >> _SHORT
    new = _changes(two)
    return two[new] >> _SHORT << _WORD | two[new] & low, np.cumsum(new) - 1, pairs & low, of


class _Grams:
    """The distinct trigrams of a pack, ordered by their middle word, last word and first word, and what they ask of shards."""

    def __init__(self, ids: np.ndarray, size: np.ndarray):
        a, b, c = _trigrams(ids, size)
        #: Bigrams of the last two words; for each trigram the place of its bigram and its first word; for each token its trigram.
        self.bc, self.i, self.a, self.of = _distinct(b << _WORD | c, a)
        #: Each trigram's context, and the distinct ones.
        self.ba = self.bc[self.i] >> _WORD << _WORD | self.a
        self.contexts = _ordered(self.ba)

    def parts(self, shards: range, often: np.ndarray, pieces: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each of ``shards`` (of as many as its end) its bigrams and trigrams, by places, and contexts (middle word, first word) of which it has a piece besides.

        A middle word in ``often`` is dealt out by its last words into
        ``pieces`` pieces, as it would be too much for one shard; all of them
        are asked for its contexts, and what they tell is added up.
        """
        b = self.bc >> _WORD
        k = np.ones(len(b), np.uint64)
        more: dict[int, list] = defaultdict(list)
        contexts = self.contexts
        for word, n in zip(often, pieces, strict=True):
            k[b == word] = n
            own = contexts[np.searchsorted(contexts, word << _WORD) : np.searchsorted(contexts, word << _WORD | _LOW, side="right")]
            for s in np.unique(_shard(np.full(int(n), word), np.arange(int(n), dtype=np.uint64), shards.stop)).tolist() if len(own) else ():
                more[s].append(own)
        two = _shard(b, (self.bc & _LOW) % k, shards.stop)
        three = two[self.i]
        for s in sorted({*_ordered(two).tolist(), *more} & {*shards}):
            yield s, np.flatnonzero(two == s), np.flatnonzero(three == s), _ordered(np.concatenate([np.zeros(0, np.uint64), *more[s]]))


def _shard(word: np.ndarray, piece: np.ndarray, shards: int) -> np.ndarray:
    return ((mixed(word, piece) >> _WORD) * np.uint64(shards) >> _WORD).astype(np.int32)


def _steps(x: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Differences of ``x``, which ascends in each run that begins at ``new``; the first of a run as it is."""
    return np.where(new, x, np.diff(x, prepend=np.uint64(0)))


def _summed(steps: np.ndarray, new: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps, dtype=np.uint64)
    first = np.flatnonzero(new)
    return total - np.repeat((total - steps)[first], np.diff(np.append(first, len(steps))))


def _ordered(x: np.ndarray) -> np.ndarray:
    """The distinct values in order; by sorting, where ``np.unique`` hashes, which takes ten times as long."""
    x = np.sort(x)
    return x[_changes(x)]


def _changes(x: np.ndarray) -> np.ndarray:
    return np.append(np.ones(min(len(x), 1), bool), x[1:] != x[:-1])


def _asks(r: dict, shards: range, often: np.ndarray, pieces: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A pack's trigrams for each shard, with their counts in training texts."""
    size = np.array(r["size"], np.int64)
    g = _Grams(_restored(r["ids"], np.uint64), size)
    train = np.repeat(np.array(r["part"]) == TRAIN, size)
    n = np.bincount(g.of[train], minlength=len(g.a)).astype(np.uint32)
    names = [x.split()[0] for x in _ASKED.split(", ")]
    for s, two, three, more in g.parts(shards, often, pieces):
        b, c = g.bc[two] >> _WORD, g.bc[two] & _LOW
        new = _changes(g.i[three])
        many = np.diff(np.append(np.flatnonzero(new), len(three)))
        binary = (_steps(b, np.zeros(len(b), bool)), _steps(c, _changes(b)), many.astype(np.uint32), _steps(g.a[three], new), n[three], _steps(more, np.zeros(len(more), bool)))
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([r["block"]], pa.int64()), *[pa.array([_squeezed(x)], pa.binary()) for x in binary]], names)


def _asked(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bigrams, the place of each trigram's bigram, its first word, and the contexts besides."""
    b = np.cumsum(_restored(r["b"], np.uint64), dtype=np.uint64)
    bc = b << _WORD | _summed(_restored(r["c"], np.uint64), _changes(b))
    i = np.repeat(np.arange(len(bc)), _restored(r["many"], np.uint32))
    return bc, i, _summed(_restored(r["a"], np.uint64), _changes(i)), np.cumsum(_restored(r["more"], np.uint64), dtype=np.uint64)


def _classes(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``keys``, and four rows of them: the sum of their ``n``, less 1, 2 and 3 for those that are 1, 2, and 3 or more, and how many of these there are."""
    own, which = np.unique(keys, return_inverse=True)
    return own, np.stack([np.bincount(which, w, len(own)) for w in (n - np.minimum(n, 3), n == 1, n == 2, n > 2)]).astype(np.uint32)


def _found(keys: np.ndarray, asked: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The ``values`` of ``keys``, which are in order, for ``asked``; 0 for others."""
    if not len(keys):
        return np.zeros((*values.shape[:-1], len(asked)), values.dtype)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[..., at], 0).astype(values.dtype)


def _contexts(bc: np.ndarray, i: np.ndarray, a: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of two words and of one that a pack asks one shard."""
    two = _ordered(np.append(bc[i] >> _WORD << _WORD | a, more))
    return two, _ordered(two >> _WORD)


def _counts(key: tuple, asked: pa.Table) -> pa.Table:
    """One shard: tells each pack its counts of trigrams, bigrams (words to the left) and contexts, and has a row without a pack of how many counts are 1 to 4, of trigrams and of bigrams, and the words' counts of words to the left."""
    rows = asked.to_pylist()
    trained = []
    for r in rows:
        n = _restored(r["n"], np.uint32)
        at = np.flatnonzero(n)
        if len(at):
            bc, i, a, _ = _asked(r)
            trained.append((bc[i[at]], a[at], n[at]))
    bc, a, n = (np.concatenate([np.zeros(0, t), *x]) for t, x in zip((np.uint64, np.uint64, np.uint32), zip(*trained, strict=True) if trained else ((), (), ()), strict=True))
    del trained
    two, i, a, of = _distinct(bc, a)
    n3 = np.bincount(of, n, len(a)).astype(np.uint32)
    del bc, of, n
    three = i.astype(np.uint64) << _WORD | a
    start = two >> _WORD == START
    n2 = np.where(start, np.bincount(i, n3, len(two)), np.bincount(i, minlength=len(two))).astype(np.uint32)
    c3, t3 = _classes(two[i] >> _WORD << _WORD | a, n3)
    c2, t2 = _classes(two >> _WORD, n2)
    word, left = np.unique(two[~start] & _LOW, return_counts=True)
    out: dict[str, list] = {c.split()[0]: [] for c in _TOLD.split(", ")}
    told = [None, key[0].as_py(), *[None] * 4, [int((x == k).sum()) for x in (n3, n2) for k in (1, 2, 3, 4)], word.astype(np.int64).tolist(), left.tolist()]
    for c, v in zip(out, told, strict=True):
        out[c].append(v)
    for r in rows:
        bc, i, a, more = _asked(r)
        at = np.minimum(np.searchsorted(two, bc), max(len(two) - 1, 0))
        known = two[at] == bc if len(two) else np.zeros(len(bc), bool)
        own = np.where(known[i], _found(three, at[i].astype(np.uint64) << _WORD | a, n3), 0).astype(np.uint32)
        both, one = _contexts(bc, i, a, more)
        told = [r["block"], r["shard"], _squeezed(own), _squeezed(_found(two, bc, n2)), _squeezed(_found(c3, both, t3).reshape(-1)), _squeezed(_found(c2, one, t2).reshape(-1)), None, None, None]
        for c, v in zip(out, told, strict=True):
            out[c].append(v)
    lists = pa.list_(pa.int64())
    return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), (pa.int64(), pa.int32(), *[pa.binary()] * 4, *[lists] * 3), strict=True)})


def _share(n: np.ndarray, classes: np.ndarray, d: list[float], lower: np.ndarray | float) -> np.ndarray:
    """p by counts ``n`` in contexts with ``classes``, interpolated with ``lower``; ``lower`` alone in contexts that training does not have."""
    all_n = classes[0] + classes[1] + 2 * classes[2] + 3 * classes[3]
    total = np.maximum(all_n, 1).astype(float)
    less = np.array([0.0, *d])[np.minimum(n, 3)]
    gamma = (d[0] * classes[1] + d[1] * classes[2] + d[2] * classes[3]) / total
    return np.where(all_n > 0, np.maximum(n - less, 0.0) / total + gamma * lower, lower)


def _in_blocks(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once in buckets by ``block``, which joins by block read as they are, and the table's name."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").option("path", new_folder(spark, name)).saveAsTable(table)
    return spark.table(table), table


def scores(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, lang, part, n_tokens, perplexity), one for each of ``rows`` (doc_id, lang, text, part), by the model of the texts whose part is ``TRAIN``."""
    spark, kind = rows.sparkSession, dict(rows.dtypes)["doc_id"]
    words, rare = learnt_words(rows.where(F.col("part") == TRAIN))
    unknown = -float(np.log10(rare + 1))
    # frequent words have small ids, which take little room
    known = saved(global_rank(words, [F.col("n").desc(), F.col("w")], "id").select("w", (F.col("id") + START).cast("long").alias("id")), "vocabulary")
    n_known = known.count()
    packed, table = _in_blocks(numbered(rows, known, n_known), "packs")
    tokens = packed.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    shards, half = 1 + tokens // SHARD_TOKENS, SHARD_TOKENS // 2
    hot = packed.select(F.explode(F.arrays_zip("common", "times")).alias("x")).groupBy("x.common").agg(F.sum("x.times").alias("n")).where(F.col("n") > half).orderBy("common").collect()
    often, pieces = np.array([r[0] for r in hot], np.uint64), np.array([1 + r[1] // half for r in hot], np.uint64)

    def told_by(some: range) -> DataFrame:
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    yield from _asks(r, some, often, pieces)

        return packed.select("block", "part", "size", "ids").mapInArrow(ask, _ASKED).groupBy("shard").applyInArrow(_counts, _TOLD)

    told = reduce(DataFrame.unionByName, [saved(told_by(range(k, shards, ROUNDS)), "counts") for k in range(min(ROUNDS, shards))])
    of_counts = told.where("block is null").agg(*[F.sum(F.col("of_counts")[k]) for k in range(8)]).first()
    d3, d2 = _discount(list(of_counts)[:4]), _discount(list(of_counts)[4:])
    left = saved(told.where("block is null").select(F.explode(F.arrays_zip("id", "n")).alias("x")).groupBy("x.id").agg(F.sum("x.n").alias("n")), "unigrams")
    n1 = _of_counts(left)
    d1 = _discount(n1)
    size, total = left.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    gamma1 = (d1[0] * n1[0] + d1[1] * n1[1] + d1[2] * (size - n1[0] - n1[1])) / total if total else 1.0
    unseen = gamma1 / (size + 1)
    answers = told.where("block is not null").select("block", "shard", "n3", "n2", "t3", "t2", F.lit(None).cast("array<long>").alias("id"), F.lit(None).cast("array<long>").alias("n"))
    sent = None
    if n_known <= MAX_WORDS:
        t = left.toArrow()
        every = np.zeros(n_known + 2, np.uint32)
        every[t["id"].to_numpy()] = t["n"].to_numpy()
        sent = spark.sparkContext.broadcast(every)
    else:

        def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for block, z in zip(b["block"].to_pylist(), b["ids"].to_pylist(), strict=True):
                    own = _signed(np.unique(_restored(z, np.uint64)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own)], ["block", "id"])

        asked = packed.select("block", "ids").mapInArrow(last, "block long, id long").join(left, "id").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("x"))
        none = [F.lit(None).cast("binary").alias(c) for c in ("n3", "n2", "t3", "t2")]
        answers = answers.unionByName(asked.select("block", F.lit(None).cast("int").alias("shard"), *none, F.col("x.id").alias("id"), F.col("x.n").alias("n")))
    names = ["doc_id", "lang", "part", "n_tokens", "perplexity"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({c: pa.array([], t) for c, t in zip(names, (left.schema.field("doc_id").type.value_type, pa.string(), pa.int32(), pa.int64(), pa.float64()), strict=True)})
        r = left.select(["size", "ids"]).to_pylist()[0]
        texts, ids = np.array(r["size"], np.int64), _restored(r["ids"], np.uint64)
        g = _Grams(ids, texts)
        both, one = g.contexts, _ordered(g.contexts >> _WORD)
        n3, n2 = np.zeros(len(g.a), np.uint32), np.zeros(len(g.bc), np.uint32)
        t3, t2 = np.zeros((4, len(both)), np.uint32), np.zeros((4, len(one)), np.uint32)
        rows = {x["shard"]: x for x in right.to_pylist()}
        for s, two, three, more in g.parts(range(shards), often, pieces):
            x = rows[s]
            n3[three], n2[two] = _restored(x["n3"], np.uint32), _restored(x["n2"], np.uint32)
            own, own1 = _contexts(g.bc, g.i[three], g.a[three], more)
            t3[:, np.searchsorted(both, own)] += _restored(x["t3"], np.uint32).reshape(4, -1)
            t2[:, np.searchsorted(one, own1)] += _restored(x["t2"], np.uint32).reshape(4, -1)
        last = g.bc & _LOW
        if sent:
            k = sent.value[last.astype(np.int64)]
        else:
            own = rows.get(None, {"id": [], "n": []})
            k = _found(np.array(own["id"], np.uint64), last, np.array(own["n"], np.int64))
        p1 = unseen + np.maximum(k - np.array([0.0, *d1])[np.minimum(k, 3)], 0.0) / max(total, 1)
        p2 = _share(n2, t2[:, np.searchsorted(one, g.bc >> _WORD)], d2, p1)
        p3 = _share(n3, t3[:, np.searchsorted(both, g.ba)], d3, p2[g.i])
        log = np.log10(p3) + np.where(last[g.i] == UNKNOWN, unknown, 0.0)
        sums = np.bincount(np.repeat(np.arange(len(texts)), texts), log[g.of], len(texts))
        ppl = np.full(len(texts), np.nan)
        np.power(10.0, -sums / np.maximum(texts, 1), out=ppl, where=texts > 0)
        meta = [left[c].combine_chunks().flatten() for c in names[:3]]
        return pa.table([*meta, pa.array(texts), pa.array(ppl, pa.float64(), mask=texts == 0)], names)

    def scored(k: int) -> DataFrame:
        some = F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == k
        left = packed.where(some).select("block", "doc_id", "part", "lang", "size", "ids").groupBy("block")
        return left.cogroup(answers.where(some).groupBy("block")).applyInArrow(score, f"doc_id {kind}, lang string, part int, n_tokens long, perplexity double")

    out = reduce(DataFrame.unionByName, [saved(scored(k), "scores") for k in range(ROUNDS)])
    spark.sql(f"DROP TABLE {table}")  # only its name; the files go with the others
    return out


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Rows (doc_id, lang, n_tokens, perplexity, threshold, kept), one per row of ``docs``.

    ``kept`` is true up to the threshold of the document's language. Texts that
    are null, empty or without a token have no perplexity and are not kept. A
    null language, or one with under ``MIN_HELD_OUT`` held-out trusted texts,
    takes the threshold of all; without any trusted text nothing can be judged:
    thresholds are null and every document with a token is kept. Repeated rows
    and ids, and rows without an id, are judged each by its own text; labels
    without an id count for none; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    with shuffles_dropped(docs.sparkSession):
        scored = scores(trusted(rows, labels))
    held = scored.where((F.col("part") == HELD) & F.col("perplexity").isNotNull())
    per = held.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"), F.count("*").alias("n"))
    per = saved(per.where(f"n >= {MIN_HELD_OUT} and lang is not null").select(F.col("lang").alias("t_lang"), "threshold").unionByName(held.agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold")).select(F.lit(None).cast("string").alias("t_lang"), "threshold")), "thresholds")
    everywhere = per.where("t_lang is null").first()["threshold"]
    out = scored.join(per.where("t_lang is not null"), F.col("lang") == F.col("t_lang"), "left").withColumn("threshold", F.coalesce("threshold", F.lit(everywhere).cast("double")))
    return out.select("doc_id", "lang", "n_tokens", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.col("perplexity").isNotNull()).alias("kept"))
