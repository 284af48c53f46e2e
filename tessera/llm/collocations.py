"""Phrases whose words stand together more often than apart (operator 13), counted by top-order marginalisation.

Each word is the first of one window of ``longest`` words, padded where its
piece of text ends. Only these windows are counted, once for all orders: a
ROLLUP over the windows' columns sums them over ever shorter prefixes, and the
sum of a prefix without padding is the count of that phrase. No shorter n-grams
are made from the text for it.

Windows also end before what no candidate can hold: a word, or two successive
words, seen less than ``least`` times, since a phrase is never more frequent
than its parts. Both sets are small (at most one in ``least`` of the words can
be the first of its kind to count) and go to the workers as dictionaries where
they are within ``MAX_WORDS`` and ``MAX_PAIRS``. Words and pairs have been
counted for the dictionaries, so a window of one word or two tells nothing new:
only windows of three words and more become rows, and the ROLLUP goes down to
three. Beyond these bounds, windows are whole, whatever their size, and words go
by numbers of 64 bits that are proven to be distinct. The result is the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, saved
from tessera.llm.pieces import slices
from tessera.operators.ranking import global_rank

LEAST, LONGEST, TOP = 100, 5, 2000
#: A phrase goes if a longer one that holds it has at least so many hundredths of its occurrences.
SHARE = 100
#: Dictionaries of at most so many rows are sent to the workers.
MAX_WORDS, MAX_PAIRS = 1_000_000, 4_000_000
#: What follows the last word of a piece.
PAD = -1
NO_LANG = "und"
BREAK = b".,;:!?\n\v\f\r"
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + BREAK, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(BREAK))

Batches = Iterator[pa.RecordBatch]


def tokens(texts: pa.Array) -> tuple[np.ndarray, list[str]]:
    """The words of all texts in a row, as codes of the distinct ones; ``PAD`` stands between pieces and between texts."""
    whole = " . ".join(pc.fill_null(texts, "").to_pylist()).encode().translate(_PLAIN).replace(b".", b" . ")
    found = pc.dictionary_encode(pc.split_pattern(pa.array([whole], pa.large_binary()).cast(pa.large_string()), " ").flatten())
    words = found.dictionary.to_pylist()
    codes = found.indices.to_numpy().astype(np.int64)
    kind = np.arange(len(words), dtype=np.int64)
    for k, w in enumerate(words):
        if w in ("", "."):
            kind[k] = PAD - 1 if w == "" else PAD
    codes = kind[codes]
    return codes[codes >= PAD], words


def _by_language(batches: Batches) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    for b in batches:
        langs = pc.fill_null(b["lang"], NO_LANG)
        for lang in langs.unique():
            for texts in slices(b["text"].filter(pc.equal(langs, lang))):
                yield lang.as_py(), *tokens(texts)


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, word, f) of all words of ``docs`` (lang, text)."""

    def count(batches: Batches) -> Batches:
        for lang, codes, words in _by_language(batches):
            n = np.bincount(codes[codes >= 0], minlength=len(words))
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "word": [words[k] for k in at], "c": pa.array(n[at], pa.int64())})

    return docs.mapInArrow(count, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("f"))


def _hashed(lang: str, words: list[str], seed: int) -> list[int]:
    return [xxhash.xxh64_intdigest(f"{lang}\0{w}", seed) >> 1 for w in words]


class Dictionary:
    """Numbers of the words that count, within the worker: ``number(lang, words)``, ``PAD`` for a word that doesn't."""

    def __init__(self, shared, seed: int | None):
        self.shared, self.seed, self.known = shared, seed, {}

    def __getstate__(self):
        return {"shared": self.shared, "seed": self.seed, "known": {}}

    def number(self, lang: str, words: list[str]) -> np.ndarray:
        if self.seed is not None:
            return np.array(_hashed(lang, words, self.seed), np.int64)
        if lang not in self.known:
            ids, langs, names = self.shared.value
            own = pc.equal(langs, lang)
            self.known[lang] = dict(zip(names.filter(own).to_pylist(), ids.filter(own).to_pylist(), strict=True))
        get = self.known[lang].get
        return np.array([get(w, PAD) for w in words], np.int64)


def vocabulary(counts: DataFrame, least: int, limit: int) -> tuple[DataFrame, Dictionary]:
    """Rows (id, lang, word, f) of the words seen ``least`` times or more, and their dictionary for the workers."""
    spark, often = counts.sparkSession, counts.where(F.col("f") >= least)
    if often.count() <= limit:
        ranked = global_rank(often, [F.desc("f"), F.col("lang"), F.col("word")], "id").select((F.col("id") - 1).alias("id"), "lang", "word", "f")
        known = saved(ranked, "vocabulary")
        t = known.toArrow()
        return known, Dictionary(spark.sparkContext.broadcast(tuple(t[c].combine_chunks() for c in ("id", "lang", "word"))), None)
    n, seed = counts.count(), 0
    while True:

        def name(batches: Batches, seed: int = seed) -> Batches:
            for b in batches:
                ids = [_hashed(la, [w], seed)[0] for la, w in zip(b["lang"].to_pylist(), b["word"].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "lang": b["lang"], "word": b["word"], "f": b["f"]})

        named = saved(counts.select("lang", "word", "f").mapInArrow(name, "id long, lang string, word string, f long"), "vocabulary")
        if named.select("id").distinct().count() == n:  # no two words share a number
            return named.where(F.col("f") >= least), Dictionary(None, seed)
        seed += 1


def _pack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a << 32) | b


def frequent_pairs(docs: DataFrame, known: Dictionary, least: int, limit: int):
    """Rows (pair, c) of the pairs of successive words seen ``least`` times or more, packed, and the same pairs in order for the workers; None twice if words have no small numbers or the pairs are too many."""
    if known.seed is not None:
        return None, None

    def count(batches: Batches) -> Batches:
        for lang, codes, words in _by_language(batches):
            ids = np.append(known.number(lang, words), PAD)[codes]
            a, b = ids[:-1], ids[1:]
            ok = (a >= 0) & (b >= 0)
            pair, c = np.unique(_pack(a[ok], b[ok]), return_counts=True)
            yield pa.RecordBatch.from_pydict({"pair": pa.array(pair, pa.int64()), "c": pa.array(c, pa.int64())})

    often = docs.mapInArrow(count, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    often = saved(often, "pairs")
    if often.count() > limit:
        return None, None
    return often, docs.sparkSession.sparkContext.broadcast(np.sort(often.select("pair").toArrow()["pair"].to_numpy()))


def _windows(longest: int, shortest: int, known: Dictionary, pairs) -> Callable[[Batches], Batches]:
    """Windows of ``shortest`` words and more, a row each; Spark counts them, combined before the shuffle."""
    names = [f"w{k + 1}" for k in range(longest)]

    def work(batches: Batches) -> Batches:
        for lang, codes, words in _by_language(batches):
            ids = np.append(known.number(lang, words), PAD)[codes]
            on = np.zeros(len(ids), bool)  # the next word still belongs to the window
            if len(ids):
                on[:-1] = (ids[:-1] >= 0) & (ids[1:] >= 0)
            if pairs is not None:
                at = np.flatnonzero(on)
                packed, often = _pack(ids[at], ids[at + 1]), pairs.value
                place = np.searchsorted(often, packed)
                on[at] = often[np.minimum(place, len(often) - 1)] == packed if len(often) else False
            starts = np.flatnonzero(ids >= 0)
            for k in range(shortest - 1):
                starts = starts[on[starts + k]]
            lead, go = [ids[starts]], np.ones(len(starts), bool)
            for k in range(1, longest):
                at = np.minimum(starts + k, len(ids) - 1)
                go &= on[at - 1] & (starts + k < len(ids))
                lead.append(np.where(go, ids[at], PAD))
            yield pa.RecordBatch.from_pydict({n: pa.array(w, pa.int64()) for n, w in zip(names, lead, strict=True)})

    return work


def windows(docs: DataFrame, known: Dictionary, pairs, longest: int, shortest: int) -> DataFrame:
    """Rows (w1, w2, ...): the windows of ``shortest`` words and more."""
    return docs.mapInArrow(_windows(longest, shortest, known, pairs), ", ".join(f"w{k + 1} long" for k in range(longest)))


def phrases(docs: DataFrame, words: DataFrame, known: Dictionary, often: DataFrame | None, pairs, least: int, longest: int) -> DataFrame:
    """Rows (p, f): phrases of 1 to ``longest`` word numbers that come ``least`` times or more."""
    shortest = 1 if often is None else 3
    names = [f"w{k + 1}" for k in range(longest)]
    found = None
    if often is not None:
        found = words.select(F.array("id").alias("p"), "f")
        if longest > 1:
            two = F.array(F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
            found = found.unionByName(often.select(two.alias("p"), F.col("c").alias("f")))
    if longest < shortest:
        return found
    rows = windows(docs, known, pairs, longest, shortest).select(F.struct(*names[:shortest]).alias("head"), *names[shortest:])
    sums = rows.rollup("head", *names[shortest:]).agg(F.count("*").alias("f")).where((F.col("f") >= least) & F.col("head").isNotNull())
    columns = [*[F.col(f"head.{n}") for n in names[:shortest]], *[F.col(n) for n in names[shortest:]]]
    sums = sums.where(F.coalesce(*reversed(columns)) != PAD).select(F.filter(F.array(*columns), lambda w: w.isNotNull()).alias("p"), "f")
    return sums if found is None else found.unionByName(sums)


def _parts(p: str, at: str, n: str) -> F.Column:
    return F.expr(f"slice({p}, {at}, {n})")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = SHARE, max_words: int = MAX_WORDS, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """Each language's best ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    Only ``text`` and ``lang`` of ``docs`` are read, whatever other columns are
    called. Null text is empty, null lang is ``und``, repeated rows count each,
    and an empty table has no phrases. Equal scores are ordered by frequency and
    then by the phrase's UTF-8 bytes, so that ranks have no ties.
    """
    docs = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = saved(word_counts(docs), "word-counts")
    words, known = vocabulary(counts, least, max_words)
    often, pairs = frequent_pairs(docs, known, least, max_pairs)
    found = saved(phrases(docs, words, known, often, pairs, least, longest), "phrases")
    n_words = words.count()

    candidates = found.where(F.size("p") > 1)
    longer = candidates.where(F.size("p") > 2)
    inside = longer.select("f", F.explode(F.expr("array_distinct(flatten(transform(sequence(2, size(p) - 1), n -> transform(sequence(1, size(p) - n + 1), i -> slice(p, i, n)))))")).alias("p"))
    held = inside.groupBy("p").agg(F.max("f").alias("longer"))
    kept = candidates.join(held, "p", "left").where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("f"))).select("p", F.col("f").alias("a"))
    kept = saved(kept, "kept-phrases")

    cuts = kept.select("p", "a", F.explode(F.expr("sequence(1, size(p) - 1)")).alias("k"))
    cuts = cuts.select("p", "a", "k", _parts("p", "1", "k").alias("first"), _parts("p", "k + 1", "size(p) - k").alias("rest"))
    cuts = cuts.join(found.select(F.col("p").alias("first"), F.col("f").alias("l")), "first").join(found.select(F.col("p").alias("rest"), F.col("f").alias("r")), "rest")
    spoken = kept.select("p", F.posexplode("p").alias("i", "id")).join(broadcast_if_small(words.drop("f"), n_words, 200_000), "id")
    spoken = spoken.groupBy("p").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda s: s["word"])).alias("phrase"), F.first("lang").alias("lang"))
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    scored = cuts.join(spoken, "p").join(totals, "lang")
    score = F.expr("cast((cast(1000 as decimal(38, 0)) * a * n) div (cast(l as decimal(38, 0)) * r) as bigint)")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    best = best.select("lang", "phrase", "a", "n", "b.l", "b.r", "b.score", F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("part"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # the best of each part first: a language's last rank sees at most 64 * top rows
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
