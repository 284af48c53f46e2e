"""Quality rules as a short-circuit cascade (operator 8)."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_words, let, saved

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_ROWS = 2000
#: Rules that take less beyond the words themselves count as equally cheap.
LEAST_SECONDS = 0.002


def n_words(words: Column, text: Column) -> Column:
    return F.size(words).cast("long")


def word_chars(words: Column, text: Column) -> Column:
    """Code points in words."""
    return F.length(F.concat_ws("", words)).cast("long")


def n_symbols(words: Column, text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")


def n_dup_lines(words: Column, text: Column) -> Column:
    r"""Lines (cut at \n) with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(words: Column, text: Column) -> Column:
    """Words that stand in a three-word window which the text has twice or more.

    Windows are compared by 64-bit hash. Where all differ nothing more is done;
    else (hash, place) pairs are sorted, so that equal windows are neighbours,
    and the places that they cover are counted once.
    """

    def of(w: Column) -> Column:
        grams = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

        def covered(g: Column) -> Column:
            pairs = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

            def count(p: Column) -> Column:
                same = lambda x, k: F.coalesce(x["h"] == F.get(p, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(p, k + 1)["h"], F.lit(False))
                places = F.flatten(F.transform(F.filter(p, same), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
                return F.size(F.array_distinct(places))

            return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(pairs, count))

        return let(grams, covered)

    return let(words, of).cast("long")  # else each window would split the text again


@dataclass(frozen=True)
class Rule:
    """A document fails if ``rejects`` is true of ``measures`` (name to column of words and text)."""

    name: str
    measures: dict[str, Callable[[Column, Column], Column]]
    rejects: Callable[..., Column]

    def column(self, words: Column, text: Column) -> Column:
        return self.rejects(**{k: f(words, text) for k, f in self.measures.items()})


RULES = (
    Rule("few_words", {"n_words": n_words}, lambda n_words: n_words < MIN_WORDS),
    Rule("word_length", {"n_words": n_words, "word_chars": word_chars}, lambda n_words, word_chars: (word_chars < 2 * n_words) | (word_chars > 15 * n_words)),
    Rule("symbols", {"n_words": n_words, "n_symbols": n_symbols}, lambda n_words, n_symbols: 10 * n_symbols > n_words),
    Rule("repeated_lines", {"n_words": n_words, "n_dup_lines": n_dup_lines}, lambda n_words, n_dup_lines: 20 * n_dup_lines > n_words),
    Rule("repeated_words", {"n_words": n_words, "n_repeat_words": n_repeat_words}, lambda n_words, n_repeat_words: 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words),
)


def _text(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def measured_order(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejection per cost on a bounded sample, best first.

    The sample is ``sample_rows`` rows, whichever Spark finds first; it decides
    the order only, never the verdict. The cost of a rule is the time that the
    sample takes beyond a job that only cuts it into words, the least of three
    runs each, so that what any job costs does not hide it. With an empty table
    the order stays.
    """
    sample = saved(docs.select(_text(docs, text_col).alias("t")).limit(sample_rows), "rule-sample")
    if sample.isEmpty():
        return list(rules)
    words = ascii_words(F.col("t"))

    def timed(rejects: Column) -> tuple[float, float]:
        """Seconds, and the share of rows for which ``rejects`` is true."""
        job, seconds = sample.agg(F.count_if(rejects), F.count("*")), []
        for _ in range(3):
            began = time.perf_counter()
            rejected, n = job.first()
            seconds.append(time.perf_counter() - began)
        return min(seconds), rejected / n

    base = timed(F.size(words) < 0)[0]
    found = []
    for k, rule in enumerate(rules):
        seconds, share = timed(rule.column(words, F.col("t")))
        found.append((-share / max(seconds - base, LEAST_SECONDS), k))
    return [rules[k] for _, k in sorted(found)]


def first_failure(words: Column, text: Column, rules: list[Rule]) -> Column:
    """The name of the first rule in order that rejects, null if none does; rules after it are not computed."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.column(words, text), F.lit(rule.name)).otherwise(out)
    return out


def kept(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects. A null or empty text has no word and goes."""
    rules = measured_order(docs, text_col)
    text = _text(docs, text_col)
    return docs.where(let(ascii_words(text), lambda w: first_failure(w, text, rules)).isNull())


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept), one per row of ``docs``.

    A null text counts as empty: all zero, and rejected. One row depends on no
    other, so repeated rows and ids keep their own; the cascade runs over the
    measures, in the order that ``measured_order`` finds.
    """
    rules = measured_order(docs, text_col)
    text = _text(docs, text_col)
    names = {k: f for rule in RULES for k, f in rule.measures.items()}
    row = let(ascii_words(text), lambda w: F.struct(*[f(w, text).alias(k) for k, f in names.items()]))
    rows = docs.select(docs[id_col].alias("doc_id"), row.alias("m")).select("doc_id", "m.*")
    failed = F.lit(None).cast("string")
    for rule in reversed(rules):
        failed = F.when(rule.rejects(**{k: F.col(k) for k in rule.measures}), F.lit(rule.name)).otherwise(failed)
    base = {r.name: r for r in RULES}
    base_failed = base["few_words"].rejects(F.col("n_words")) | base["repeated_words"].rejects(F.col("n_words"), F.col("n_repeat_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), failed.isNull().alias("kept"))
