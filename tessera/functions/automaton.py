"""Whole dictionaries over texts by one automaton: ordered replacements, and which terms a text holds.

Replacements apply in their order, each to what those before it left, exactly as
if all were tried one after another. An Aho-Corasick automaton of all literal
entries is run over the text once and tells which can apply at all; only these
are tried, and the text is looked at again where one has changed it. A pattern
that is no literal is tried each time its turn comes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that count as equal when case does not matter, beyond what one letter's case folding says.
_EQUAL = {"İ": "i", "ı": "i", "ΐ": "ΐ", "ΰ": "ΰ", "ﬅ": "ﬆ"}


class _Folding(dict):
    """A table for ``str.translate``: each letter as one letter that all its cases share."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        folded = _EQUAL.get(c, c.casefold())
        self[code] = folded if len(folded) == 1 else c
        return self[code]


_folding = _Folding()


def folded(text: str) -> str:
    return text.translate(_folding)


@dataclass
class Entry:
    """A replacement: ``pattern`` is a literal, whole words only if ``words``, or, if ``regex``, a pattern whose groups ``to`` may name."""

    pattern: str
    to: str
    words: bool = False
    case: bool = True
    regex: bool = False

    def compiled(self) -> re.Pattern | None:
        """None where the literal is replaced as it stands."""
        flags = 0 if self.case else re.IGNORECASE
        if self.regex:
            return re.compile(self.pattern, flags)
        if self.words:
            return re.compile(rf"\b{re.escape(self.pattern)}\b", flags)
        return None if self.case else re.compile(re.escape(self.pattern), flags)


def _applied(text: str, entry: Entry, pattern: re.Pattern | None) -> str:
    if pattern is None:
        return text.replace(entry.pattern, entry.to)
    return pattern.sub(entry.to if entry.regex else lambda _: entry.to, text)


def in_order(text: str, entries: list[Entry]) -> str:
    """The definition: every entry in turn."""
    for e in entries:
        text = _applied(text, e, e.compiled())
    return text


@dataclass
class Replacements:
    """``entries`` with their automaton, which each worker builds once. Empty literals, and patterns that are none, are left out."""

    entries: list[Entry]
    _ready: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"entries": self.entries, "_ready": None}

    def _built(self) -> tuple:
        if self._ready is None:
            entries, patterns = [], []
            for e in self.entries:
                try:
                    pattern = e.compiled()
                except re.error:
                    continue
                if e.pattern:
                    entries.append(e)
                    patterns.append(pattern)
            places: dict[str, list[int]] = {}
            for k, e in enumerate(entries):
                if not e.regex:
                    places.setdefault(folded(e.pattern), []).append(k)
            automaton = ahocorasick.Automaton()
            for literal, ks in places.items():
                automaton.add_word(literal, ks)
            if places:
                automaton.make_automaton()
            self._ready = entries, patterns, automaton if places else None, [k for k, e in enumerate(entries) if e.regex]
        return self._ready

    def apply(self, text: str) -> str:
        entries, patterns, automaton, always = self._built()
        at = -1  # the last entry whose turn has come

        def coming() -> list[int]:
            found = {k for _, ks in automaton.iter(folded(text)) for k in ks if k > at} if automaton is not None else set()
            return sorted(found.union(k for k in always if k > at), reverse=True)

        due = coming()
        while due:
            at = due.pop()
            new = _applied(text, entries[at], patterns[at])
            if new != text:
                text, due = new, None
                due = coming()
        return text


def replaced_texts(df: DataFrame, text_col: str, entries: list[Entry], name: str) -> DataFrame:
    """``df`` with ``name``, its text after all replacements in order; null stays null."""
    rules = Replacements(entries)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema if f.name != name] + [T.StructField(name, T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = pa.array([None if t is None else rules.apply(t) for t in b[text_col].to_pylist()], pa.string())
            columns = {c: b[c] for c in b.schema.names} | {name: done}
            yield pa.RecordBatch.from_pydict({f: columns[f] for f in schema.names})

    return df.mapInArrow(work, schema)


def terms_of(df: DataFrame, id_col: str, text_col: str, terms: Iterable[str]) -> DataFrame:
    """Rows (id, term, n): how often each of the ``terms`` stands in a text, in any case, overlaps included; terms that are absent have no row.

    Terms that differ in case only are one, spelled as the first of them. A text
    is run through once, whatever the number of terms.
    """
    spelled: dict[str, str] = {}
    for t in terms:
        if t:
            spelled.setdefault(folded(t), t)
    kind = dict(df.dtypes)[id_col]
    schema = f"id {kind}, term string, n long"
    if not spelled:
        return df.sparkSession.createDataFrame([], schema)
    built: list = []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            automaton = ahocorasick.Automaton()
            for k, t in spelled.items():
                automaton.add_word(k, t)
            automaton.make_automaton()
            built.append(automaton)
        for b in batches:
            row, term, n = [], [], []
            for k, text in enumerate(b["text"].to_pylist()):
                counts: dict[str, int] = {}
                for _, t in built[0].iter(folded(text or "")):
                    counts[t] = counts.get(t, 0) + 1
                row += [k] * len(counts)
                term += counts.keys()
                n += counts.values()
            yield pa.RecordBatch.from_pydict({"id": b["id"].take(pa.array(row, pa.int64())), "term": pa.array(term, pa.string()), "n": pa.array(n, pa.int64())})

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(work, schema)
