"""The core normaliser: why a text is refused, or its text after all passes of the dictionaries.

Dictionaries are a parameter of any size (``readers.dictionaries`` reads them
from a file). Each pass is one array of patterns that a fold goes through in
order, so the plan stays as small with 600 entries as with six, and texts that
no entry of a pass is found in skip it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.automaton import Entry, replaced_texts
from tessera.functions.text import let

Entries = list[tuple[str, str]]
#: Passes of words in order, and whether their case matters.
WORD_PASSES = (("arabizi_upper", True), ("arabizi_words", False))
LATER_WORD_PASSES = (("abbreviations", False), ("telecom_tech", False))


def _java(replacement: str) -> str:
    r"""A replacement with groups as ``\1`` in the form that Java reads."""
    return re.sub(r"\\(\d)", r"$\1", replacement.replace("$", r"\$"))


def _literal(replacement: str) -> str:
    return replacement.replace("\\", r"\\").replace("$", r"\$")


def _quoted(literal: str) -> str:
    return f"\\Q{literal}\\E"


def _longest_first(entries: dict[str, str]) -> list[tuple[str, str]]:
    return sorted(entries.items(), key=lambda kv: len(kv[0]), reverse=True)


def word_entries(entries: dict[str, str], case: bool = False) -> Entries:
    """Whole words or phrases, the longest first, so that none is cut by a shorter one."""
    return [(f"(?{'' if case else 'i'}U)\\b{_quoted(k)}\\b", _literal(v)) for k, v in _longest_first(entries)]


def pattern_entries(entries: dict[str, str]) -> Entries:
    """Patterns in the dictionary's order; those that are none are left out."""
    out = []
    for pattern, value in entries.items():
        try:
            re.compile(pattern)
        except re.error:
            continue
        out.append((f"(?iU){pattern}", _java(value)))
    return out


def emoji_entries(entries: dict[str, str]) -> Entries:
    return [(_quoted(k), f" {_literal(v)} ") for k, v in _longest_first(entries)]


def variant_entries(variants: dict) -> Entries:
    """All spellings of the network's name as one."""
    latin, arabic = (variants.get(k, []) for k in ("latin", "arabic"))
    parts = [rf"\b(?:{'|'.join(map(_quoted, latin))})\b"] * bool(latin) + [f"(?:{'|'.join(map(_quoted, arabic))})"] * bool(arabic)
    return [(f"(?iU){'|'.join(parts)}", _literal(variants["normalized_form"]))] if parts else []


def replaced(c: Column, entries: Entries) -> Column:
    """``c`` after each replacement in order; texts in which none of the patterns is found stay as they are.

    A replacement can make room for a later entry; where no entry is found at first nothing is replaced, so none is made room for.
    """
    if not entries:
        return c
    steps = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(r).alias("r")) for p, r in entries])
    if any(re.search(r"\\[1-9]", p) for p, _ in entries):  # a back-reference would name another group in a joined pattern
        return F.aggregate(steps, c, lambda s, e: F.regexp_replace(s, e["p"], e["r"]))
    gate = "|".join(f"(?:{p})" for p, _ in entries)
    return let(c, lambda t: F.when(t.rlike(gate), F.aggregate(steps, t, lambda s, e: F.regexp_replace(s, e["p"], e["r"]))).otherwise(t))


def passes(dictionaries: dict) -> list[Entries]:
    """All replacements in the order in which they apply."""
    words = lambda names: [word_entries(dictionaries.get(n, {}), case) for n, case in names]
    return [
        emoji_entries(dictionaries.get("emojis", {})),
        *words(WORD_PASSES),
        pattern_entries(dictionaries.get("mixed_ar_fr_regex", {})),
        variant_entries(dictionaries.get("network_variants", {})),
        *words(LATER_WORD_PASSES),
        pattern_entries(dictionaries.get("french_corrections_regex", {})),
    ]


def normalise(c: Column, dictionaries: dict) -> Column:
    """A struct (text, reason): the reason of refusal, or the text of all passes; then lower case, no tags, letters and digits apart, single spaces.

    As lower case comes last, ``ADSL`` ends as ``adsl``, and ``4g``, first
    spelled ``4G``, as ``4 g``. Null and blank texts are refused.
    """
    letters = dictionaries.get("unicode_arabic", {})
    t = text.strip(F.coalesce(c, F.lit("")))
    single = {k: v for k, v in letters.items() if len(k) == 1 and len(v) == 1}
    if single:
        t = F.translate(t, "".join(single), "".join(single.values()))
    for k, v in letters.items():
        if k not in single:
            t = F.replace(t, F.lit(k), F.lit(v))
    for entries in passes(dictionaries):
        t = replaced(t, entries)
    reason = text.rejection(c, tuple(dictionaries.get("telecom_tech", {})))
    return let(reason, lambda r: F.struct(F.when(r.isNull(), text.core_form(t)).alias("text"), r.alias("reason")))


def sequence(dictionaries: dict) -> list[Entry]:
    """All entries of all passes in the order in which they apply, for the automaton."""
    single = [Entry(k, v) for k, v in dictionaries.get("unicode_arabic", {}).items()]
    emoji = [Entry(k, f" {v} ") for k, v in _longest_first(dictionaries.get("emojis", {}))]
    words = lambda names: [Entry(k, v, words=True, case=case) for n, case in names for k, v in _longest_first(dictionaries.get(n, {}))]
    patterns = lambda name: [Entry(k, v, case=False, regex=True) for k, v in dictionaries.get(name, {}).items()]
    variants, network = dictionaries.get("network_variants", {}), []
    parts = [rf"\b(?:{'|'.join(map(re.escape, variants['latin']))})\b"] * bool(variants.get("latin")) + [f"(?:{'|'.join(map(re.escape, variants['arabic']))})"] * bool(variants.get("arabic")) if variants else []
    if parts:
        network = [Entry("|".join(parts), variants["normalized_form"].replace("\\", r"\\"), case=False, regex=True)]
    return [*single, *emoji, *words(WORD_PASSES), *patterns("mixed_ar_fr_regex"), *network, *words(LATER_WORD_PASSES), *patterns("french_corrections_regex")]


def normalised(df: DataFrame, text_col: str, dictionaries: dict) -> DataFrame:
    """``df`` with ``reason`` and ``clean``, as ``normalise`` has them, by one automaton for dictionaries of any size.

    Words and their limits are those of Python's patterns here, in which a
    combining mark is no part of a word.
    """
    stripped = text.strip(F.coalesce(F.col(text_col), F.lit("")))
    reason = text.rejection(F.col(text_col), tuple(dictionaries.get("telecom_tech", {})))
    told = df.withColumn("reason", reason).withColumn("_t", F.when(F.col("reason").isNull(), stripped))
    done = replaced_texts(told, "_t", sequence(dictionaries), "_done")
    return done.withColumn("clean", text.core_form(F.col("_done"))).drop("_t", "_done")
