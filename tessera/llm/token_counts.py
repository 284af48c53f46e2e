"""Exact token counts at every prefix of a text, by dynamic programming (operator 3)."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import new_folder
from tessera.llm.pieces import Pieces, gathered, slices

LIMIT = 4096
SPACE = "▁"
CACHE_WORDS = 200_000
CACHE_PAIRS = 400_000
CACHE_CHARS = 64
NONE = np.zeros(0, np.int32)


class PrefixCounter:
    """Token counts of the prefixes of a text under a sentencepiece BPE model without normalization.

    The model writes each space as a mark and puts one in front of the text.
    Where no piece of the vocabulary has a mark after another character, no
    token spans the place before a mark that follows one, so the text falls into
    words. Let ``count[k]`` be the exact token count of the prefix that ends with
    word k: ``count[k] = count[k-1] + tokens(word k)``. A word's tokens, and the
    counts of all prefixes that end inside it, are in that word's own table,
    which the recurrence over its characters fills (``word``), once for each
    distinct word. Storing the counts of all prefixes answers any question of
    length: the last is the count of the whole text.
    """

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        self.sp = SentencePieceProcessor(model_file=model_file)
        n = self.sp.get_piece_size()
        pieces = {self.sp.id_to_piece(i): i for i in range(n) if not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i))}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece of this vocabulary spans words")
        self.pieces = pieces
        sizes: dict[str, set[int]] = {}
        for p in pieces:
            if len(p) > 2:
                sizes.setdefault(p[-3:], set()).add(len(p))
        #: How long the pieces are that end with three characters, longest first; pieces of one and two characters come last.
        self.sizes = {tail: (*sorted(n, reverse=True), 2, 1) for tail, n in sizes.items()}
        self.apart: dict[str, bool] = {}
        self.cache: dict[str, bytes] = {}

    def _tokens(self, marked: str) -> list[int]:
        """The tokens of a string, longer than one mark, as it is encoded inside a text."""
        if marked[0] == SPACE:  # the library adds the first mark itself
            return self.sp.encode(marked[1:])
        return self.sp.encode("\n" + marked)[2:]  # the mark and the line feed join with nothing

    def _stay_apart(self, a: str, b: str) -> bool:
        """Whether tokens a, b (or b alone, if a is empty) are what their joined text is encoded as."""
        if len(self.apart) > CACHE_PAIRS:
            self.apart.clear()
        self.apart[f"{a}\n{b}"] = known = (marked := a + b) == SPACE or self._tokens(marked) == [self.pieces[x] for x in (a, b) if x]
        return known

    def _extend(self, marked: str, last: list[str], count: list[int]) -> None:
        """Fills the tables of one marked word from where they end.

        The encoding of a prefix is that of a shorter prefix and one more token:
        the one which the encoder leaves standing beside the shorter one's last.
        """
        sizes, pieces, apart = self.sizes, self.pieces, self.apart
        for i in range(len(count), len(marked) + 1):
            for n in sizes.get(marked[i - 3 : i] if i > 2 else "", (2, 1)):
                if (j := i - n) < 0 or (token := marked[j:i]) not in pieces:
                    continue
                known = apart.get(f"{last[j]}\n{token}")
                if self._stay_apart(last[j], token) if known is None else known:
                    last.append(token)
                    count.append(count[j] + 1)
                    break
            else:  # a character that no piece has: one token for each byte, which join with nothing
                last.append("")
                count.append(count[i - 1] + len(marked[i - 1].encode()))

    def word(self, marked: str) -> list[int]:
        """Token counts of the prefixes of 1, 2, ... characters of one marked word."""
        last, count = [""], [0]
        self._extend(marked, last, count)
        return count[1:]

    def tables(self, words: list[str]) -> list[bytes]:
        """``word`` of the mark and each word, as 32-bit numbers. New words are taken in order: what one has in common with the one before is filled once."""
        found = list(map(self.cache.get, words))
        if None not in found:
            return found
        own, before, last, count = {}, "", [""], [0]
        for w in sorted({w for w, t in zip(words, found, strict=True) if t is None}):
            marked = SPACE + w.replace(" ", SPACE)
            same = 0
            for x, y in zip(before, marked, strict=False):
                if x != y:
                    break
                same += 1
            del last[same + 1 :], count[same + 1 :]
            self._extend(marked, last, count)
            own[w], before = array("i", count[1:]).tobytes(), marked
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        self.cache |= {w: t for w, t in own.items() if len(w) <= CACHE_CHARS}
        return [own[w] if t is None else t for w, t in zip(words, found, strict=True)]

    def _words(self, text: str) -> list[str]:
        """What follows the first mark in each word; further marks of a run are spaces in front of it."""
        parts = text.split(" ")
        if "" not in parts and SPACE not in text:
            return parts
        out: list[str] = []
        spaces = 0
        for p in text.replace(SPACE, " ").split(" "):
            if p:
                out.append(" " * spaces + p)
                spaces = 0
            else:
                spaces += 1
        if spaces:
            out.append(" " * (spaces - 1))
        return out

    def _whole(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The counts at the end of each word, and at the end of each character."""
        if not text:
            return NONE, NONE
        tables = [np.frombuffer(t, np.int32) for t in self.tables(self._words(text))]
        ends = np.cumsum([t[-1] for t in tables], dtype=np.int32)
        chars = np.concatenate([t + e - t[-1] for t, e in zip(tables, ends, strict=True)])
        return ends, chars[1:]  # the first mark is no character of the text

    def at_words(self, text: str | None) -> list[int]:
        """The count at the end of each word."""
        return self._whole(text)[0].tolist()

    def tables_of(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the counts at the end of each word and of each character. Where words are simply what stands between spaces, distinct words of all texts are looked up once."""
        pieces = Pieces(texts)
        odd = np.array([not w or SPACE in w for w in pieces.distinct], bool)
        tables = self.tables([w for w, o in zip(pieces.distinct, odd.tolist(), strict=True) if not o])
        flat, sizes = np.frombuffer(b"".join(tables), np.int32), np.zeros(len(odd), np.int64)
        sizes[~odd] = [len(t) // 4 for t in tables]
        ends, totals = np.cumsum(sizes), np.zeros(len(odd), np.int64)
        totals[~odd] = flat[ends[~odd] - 1]
        sums = totals[pieces.codes].cumsum()
        before = np.concatenate([[0], sums])[pieces.starts]
        words = (sums - np.repeat(before, pieces.sizes)).astype(np.int32)
        chars, n = gathered(flat, ends, pieces.codes)
        chars = chars + np.repeat(words - totals[pieces.codes].astype(np.int32), n)
        stops = np.cumsum(n)[pieces.ends - 1].tolist()
        out = [(words[a:b], chars[c + 1 : d]) for a, b, c, d in zip(pieces.starts.tolist(), pieces.ends.tolist(), [0, *stops], stops, strict=False)]
        for k in pieces.texts_with(odd).tolist():
            out[k] = self._whole(texts[k].as_py())
        return out

    def at_prefixes(self, text: str | None) -> list[int]:
        """The token count of each prefix of the text, from 0 to all of its characters."""
        return [0, *self._whole(text)[1].tolist()]

    def longest_prefix(self, text: str | None, budget: int) -> int:
        """How many characters of the text fit into ``budget`` tokens; only words near the cut get a table of their own."""
        if not text:
            return 0
        words, at, best = self._words(text), 0, 0
        for k, (w, n) in enumerate(zip(words, self.at_words(text), strict=True)):
            size = len(w) + (k > 0)
            if n <= budget:
                best = at + size
            elif at <= best + CACHE_CHARS:
                before = n - self.word(SPACE + w.replace(" ", SPACE))[-1]
                inner = self.word(SPACE + w.replace(" ", SPACE))[0 if k else 1 :]
                best = max([best, *(at + i for i, c in enumerate(inner, 1) if before + c <= budget)])
            at += size
        return best


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(model_file: str) -> PrefixCounter:
    """One for each Python worker, which serves many tasks."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PrefixCounter(model_file)
    return _COUNTERS[model_file]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([NONE, *arrays])))


def prefix_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, counts, prefixes), one per row of ``docs``: the token counts of the prefixes that end with each space-separated word, and of all prefixes of 1, 2, ... characters.

    A null or empty text has no counts. Rows stand for themselves, repeated ids
    and null ids included; an empty table gives no rows. Tables of distinct words
    of many texts are filled once, whole texts however long.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for b in batches:
            at = 0
            for texts in slices(b.column(2)):
                words, chars = zip(*counter.tables_of(texts), strict=True)
                part = b.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _lists(words), _lists(chars)], ["doc_id", "n_bytes", "counts", "prefixes"])
                at += len(texts)
            pa.default_memory_pool().release_unused()  # else each worker keeps its largest batch for good

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(of, "doc_id long, n_bytes long, counts array<int>, prefixes array<int>")


def stored_prefix_counts(docs: DataFrame, model_file: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``prefix_counts`` as a Parquet table at ``path``, with counts as differences that take a few bits each; a row for each row, also for null texts and repeated ids."""
    found = prefix_counts(docs, model_file, id_col, text_col)
    found.write.option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def within_budget(table: DataFrame, budget: int) -> DataFrame:
    """``table`` with n_tokens, and fit_words and fit_tokens: how many words of the text fit into ``budget`` tokens, and the tokens that these take. No text is encoded. A row without tokens, of a null or empty text, has zeros; an empty table stays empty."""
    fit = F.size(F.filter("counts", lambda c: c <= budget))
    n = F.coalesce(F.try_element_at("prefixes", F.lit(-1)), F.lit(0)).cast("long")
    return table.withColumn("n_tokens", n).withColumn("fit_words", fit.cast("long")).withColumn("fit_tokens", F.coalesce(F.try_element_at("counts", F.nullif("fit_words", F.lit(0)).cast("int")), F.lit(0)).cast("long"))


def token_counts(docs: DataFrame, model_file: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit, fit_words, fit_tokens), one per row of ``docs``, from the stored counts of all prefixes.

    A null or empty text has no tokens; repeated rows and ids keep their own
    rows; an empty table gives no rows.
    """
    table = stored_prefix_counts(docs, model_file, new_folder(docs.sparkSession, "prefix-counts"), id_col, text_col)
    return within_budget(table, limit).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_words", "fit_tokens")
