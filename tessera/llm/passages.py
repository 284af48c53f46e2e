"""Passages that repeat across documents, by MinHash banding of paragraphs (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.buckets import SIMILARITY, bucket_links, may_be_similar_sets, open_members, prefix_members, several, stars
from tessera.llm.common import broadcast_if_small, saved
from tessera.llm.shingles import EMPTY, SHINGLE_WORDS, lists, mix, numbers, runs
from tessera.operators.work import components

#: The least paragraph; what is shorter is no passage.
PARAGRAPH_WORDS = 20
#: Of so many successive runs of ``PARAGRAPH_WORDS`` words one is a paragraph of its own.
SPACING = 12
#: At a similarity of 0.8 two lines meet with probability 1 - (1 - 0.8**2)**4 = 0.983, at 0.9 with 0.9987, at 0.3 with 0.31.
BANDS, ROWS = 4, 2
#: So many ids of texts to read again are broadcast; more are shuffled.
MAX_IDS = 500_000

_RNG = np.random.default_rng(13)
_TURN = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BAND_COLS = [f"band_{k}" for k in range(BANDS)]


class Lines:
    """The words of a text, its shingles, and the places of its lines of ``PARAGRAPH_WORDS`` words and more."""

    def __init__(self, text: bytes | None):
        cut = [line.split() for line in (text or b"").lower().split(b"\n")]
        sizes = np.array([len(x) for x in cut], np.int64)
        ends = np.cumsum(sizes)
        long = sizes >= PARAGRAPH_WORDS
        self.at, self.n = (ends - sizes)[long], sizes[long]
        self.words = numbers(list(chain.from_iterable(cut)))
        self.shingles = runs(self.words, SHINGLE_WORDS)
        self.n_shingles = self.n - SHINGLE_WORDS + 1

    def contents(self) -> np.ndarray:
        """A number for each line's sequence of shingles."""
        if not len(self.at):
            return EMPTY
        ends = np.cumsum(self.n_shingles)
        within = np.arange(ends[-1]) - np.repeat(ends - self.n_shingles, self.n_shingles)
        rows = self.shingles[np.repeat(self.at, self.n_shingles) + within]
        return _content(rows, within, ends - self.n_shingles, self.n)

    def bands(self) -> np.ndarray:
        """A row of band keys for each line."""
        out = np.zeros((len(self.at), BANDS), np.uint64)
        if len(self.at):
            cuts = np.stack([self.at, self.at + self.n_shingles], axis=1).ravel()
            padded = np.append(self.shingles, np.uint64(0))
            for b in range(BANDS):
                key = np.full(len(self.at), b + 1, np.uint64)
                for t in _TURN[b * ROWS : (b + 1) * ROWS]:
                    key = mix(key * _STEP + np.minimum.reduceat(padded * t, cuts)[::2])
                out[:, b] = key
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """The places and contents of the runs of ``PARAGRAPH_WORDS`` words that are paragraphs wherever they stand."""
        heads = runs(self.words, PARAGRAPH_WORDS)
        if not len(heads):
            return np.zeros(0, np.int64), EMPTY
        view = np.lib.stride_tricks.sliding_window_view(heads, min(SPACING, len(heads)))
        at = np.unique(np.concatenate([view[k : k + 65536].argmin(axis=1) + np.arange(k, min(k + 65536, len(view))) for k in range(0, len(view), 65536)]))
        return at, heads[at]


def _content(rows: np.ndarray, within: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    placed = mix(rows + within.astype(np.uint64) * _STEP)
    return mix(np.add.reduceat(placed, starts) + n.astype(np.uint64))


def paragraphs(docs: DataFrame) -> DataFrame:
    r"""Rows (doc_id, at, n, content, band_0, ...): the paragraphs of each text, all of them numbers.

    Paragraphs are the lines (cut at \n) of ``PARAGRAPH_WORDS`` words or more,
    with their MinHash bands; and, since a passage may stand anywhere in a line
    or across lines, runs of ``PARAGRAPH_WORDS`` words at places that the words
    alone decide: of ``SPACING`` successive runs the one with the least number.
    The latter have no bands, they meet as equal. Any 31 words that two texts
    share hold one which both have.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, at, n, content, bands = [], [], [], [], []
            for k, text in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                lines = Lines(text)
                places, heads = lines.windows()
                at += [lines.at, places]
                n += [lines.n, np.full(len(places), PARAGRAPH_WORDS)]
                content += [lines.contents(), heads]
                bands += [lines.bands(), np.zeros((len(places), BANDS), np.uint64)]
                row += [np.full(len(lines.at) + len(places), k)]
            if not row:
                continue
            bands = np.concatenate(bands)
            none = bands[:, 0] == 0
            keys = [pa.array(np.ascontiguousarray(bands[:, k]).view(np.int64), mask=none) for k in range(BANDS)]
            numbers_ = [pa.array(np.concatenate(x).astype(np.int32)) for x in (at, n)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(row))), *numbers_, pa.array(np.concatenate(content).view(np.int64)), *keys], ["doc_id", "at", "n", "content", *_BAND_COLS])

    return docs.select("doc_id", "text").mapInArrow(of, "doc_id long, at int, n int, content long, " + ", ".join(f"{c} long" for c in _BAND_COLS))


def _line_sets(pairs: DataFrame, lines: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows (content, s) of the lines in pairs (a, b), with the set of shingles of each. One text of each is read again."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            contents, sets = [], []
            for text, wanted in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("contents").to_pylist(), strict=True):
                found, wanted = Lines(text), set(wanted)
                for k, content in enumerate(found.contents().view(np.int64).tolist()):
                    if content in wanted:
                        wanted.discard(content)
                        contents.append(content)
                        sets.append(np.unique(found.shingles[found.at[k] : found.at[k] + found.n_shingles[k]]))
            yield pa.RecordBatch.from_arrays([pa.array(contents, pa.int64()), lists(sets)], ["content", "s"])

    ends = pairs.select(F.col("a").alias("content")).unionByName(pairs.select(F.col("b").alias("content"))).distinct()
    wanted = saved(ends.join(lines.select("content", "lo"), "content").groupBy("lo").agg(F.collect_list("content").alias("contents")), "wanted-lines")
    found = texts.join(broadcast_if_small(wanted, wanted.agg(F.coalesce(F.sum(F.size("contents")), F.lit(0))).first()[0], MAX_IDS), F.col("doc_id") == F.col("lo"))
    # rows that share an id may both have the line
    return saved(found.select("text", "contents").mapInArrow(of, "content long, s array<long>").dropDuplicates(["content"]), "line-sets")


def _line_links(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between different lines (as contents) that are similar.

    First each line is compared with one hub of its bands. Lines of bands that
    are then not one component are all compared that can be similar, by
    their rarest shingles: no link between these is lost, and many variants of
    one line, which share nearly all that is common, are few pairs.
    """
    lines = found.where(F.col(_BAND_COLS[0]).isNotNull()).groupBy("content").agg(F.min("doc_id").alias("lo"), *[F.min(c).alias(c) for c in _BAND_COLS])
    lines = saved(lines, "lines")
    place = F.lit(0).cast("long").alias("place")
    members = several(lines.select(F.explode(F.array(*_BAND_COLS)).alias("s"), "content", place))
    first = stars(members)
    sets = _line_sets(first, lines, texts)

    def similar(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("content").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("content").alias("b"), F.col("s").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        return both.where(common * SIMILARITY[1] >= (F.size("x") + F.size("y") - common) * SIMILARITY[0]).select("a", "b").distinct()

    links = saved(similar(first), "similar-lines")
    left = open_members(members, links).select("content").distinct()
    near = prefix_members(sets.join(left, "content", "left_semi"))
    return bucket_links(near, may_be_similar_sets, similar, stars(near), links)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, class_id, at, n_words, first_doc_id, removed, class_ids): where texts repeat what other documents have.

    Lines with a MinHash band in common are joined, and linked if the exact
    Jaccard similarity of their sets of five-word shingles is ``SIMILARITY`` or
    more; all of a band that are not yet in one component are compared by their
    rarest shingles, so no link is lost to the choice of a representative. Components of links are the
    classes of lines; equal paragraphs are one class. A class that several
    documents hold is a repeat, and stays in its first document (least id).

    Of each document, overlapping or touching paragraphs with the same first
    document are joined to a row: words ``at`` to ``at + n_words`` of the text,
    between ASCII white space, counted from 0. ``class_ids`` are all its classes,
    ``class_id`` the least of them; the row is to be removed unless the document
    is the first.

    Equal paragraphs are grouped, with counts combined before the shuffle,
    before anything is compared, so a passage in a third of all documents is one
    row in its band. Null, empty and short texts have no paragraphs; very long
    ones are whole; a document without repeats has no row; rows that share an
    id are one document, which does not repeat itself; rows without an id are
    left out; an empty table gives no rows. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    found = saved(paragraphs(texts), "paragraphs")
    roots = components(_line_links(found, texts))
    roots = roots.select(F.col("node").alias("content"), F.col("root").alias("class_id"))

    held = saved(found.groupBy("content").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi"), "equal-paragraphs")
    near = saved(found.where(F.col(_BAND_COLS[0]).isNotNull()).join(roots, "content").select("content", "class_id", "doc_id"), "near-lines")
    first = near.groupBy("class_id").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("hi")).where("first_doc_id <> hi").drop("hi")
    near = near.select("content", "class_id").distinct().join(first, "class_id").select("content", "class_id", "first_doc_id")
    equal = held.join(near, "content", "left_anti").select("content", F.col("content").alias("class_id"), F.col("lo").alias("first_doc_id"))
    classes = equal.unionByName(near)

    hits = found.select("doc_id", "at", "n", "content").join(classes, "content").select("doc_id", "at", "n", "class_id", "first_doc_id")
    hits = saved(hits, "repeats")
    own = Window.partitionBy("doc_id", "first_doc_id").orderBy("at", "n", "class_id")
    joined = hits.withColumn("reach", F.max(F.col("at") + F.col("n")).over(own.rowsBetween(Window.unboundedPreceding, -1)))
    joined = joined.withColumn("run", F.sum(F.when(F.col("at") <= F.col("reach"), 0).otherwise(1)).over(own))
    out = joined.groupBy("doc_id", "first_doc_id", "run").agg(F.array_sort(F.collect_set("class_id")).alias("class_ids"), F.min("at").alias("at"), (F.max(F.col("at") + F.col("n")) - F.min("at")).cast("long").alias("n_words"))
    return out.select("doc_id", F.col("class_ids")[0].alias("class_id"), "at", "n_words", "first_doc_id", (F.col("doc_id") != F.col("first_doc_id")).alias("removed"), "class_ids")


def removals(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, spans): the word spans (at, n_words) to cut from each document that repeats.

    What a document is the first to hold is not cut from it, even where a span
    that others hold earlier overlaps it: such a span ends before it, or begins
    after it. So each class keeps one whole occurrence. Rows without an id are
    left out, rows that share one are one document, and an empty table gives no rows.
    """
    rows = repeated_passages(docs).select("doc_id", F.col("at").cast("long").alias("at"), (F.col("at") + F.col("n_words")).alias("end"), "removed")
    spans = lambda removed: F.array_sort(F.collect_list(F.when(F.col("removed") == removed, F.struct("at", "end"))))
    per = rows.groupBy("doc_id").agg(spans(True).alias("cut"), spans(False).alias("kept"))
    # a kept span parts a cut one in two: what lies before it, and what lies after
    part = lambda x, k: F.filter(F.array(F.struct(x["at"].alias("at"), F.least(x["end"], k["at"]).alias("end")), F.struct(F.greatest(x["at"], k["end"]).alias("at"), x["end"].alias("end"))), lambda y: y["at"] < y["end"])
    left = F.aggregate("kept", F.col("cut"), lambda acc, k: F.flatten(F.transform(acc, lambda x: part(x, k))))
    out = F.transform(left, lambda x: F.struct(x["at"].alias("at"), (x["end"] - x["at"]).alias("n_words")))
    return per.select("doc_id", out.alias("spans")).where(F.size("spans") > 0)
