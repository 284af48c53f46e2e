"""SQL conditions for DuckDB from the library's patterns, whose classes and boundaries are Unicode's."""

from __future__ import annotations

import re

WORD = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"
SPACE = r"\s\x0B\x{85}\p{Z}"
#: Some conditions are taken together in one pattern, which keeps each pattern small.
TOGETHER = 12
BEHIND = re.compile(r"\\w\+\(\?<![^)]*\)")
AHEAD = re.compile(r"(.*)\\s\+\(\?!(.*)\)")


def converted(pattern: str) -> str:
    """A pattern with Unicode word, space and digit classes spelled out; a boundary becomes a place, or a sign that is no word's."""
    pattern = BEHIND.sub(r"\\w", pattern)  # one letter of the word is enough to match
    at_start = pattern.startswith(r"\b")
    out, inside, k = [], False, 2 * at_start
    while k < len(pattern):
        x = pattern[k]
        if x == "\\":
            c = pattern[k + 1]
            found = {"w": WORD, "s": SPACE, "d": r"\p{Nd}", "b": ""}.get(c)
            if c == "b":
                out.append(rf"(?:$|[^{WORD}])")
            elif found is None or c == "W":
                out.append(rf"[^{WORD}]" if c == "W" else x + c)
            else:
                out.append(found if inside else f"[{found}]")
            k += 2
            continue
        if x == "[" and not inside:
            inside = True
        elif x == "]":
            inside = False
        out.append(x)
        k += 1
    return (rf"(?:^|[^{WORD}])" if at_start else "") + "".join(out)


def sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def meets(column: str, patterns: tuple[str, ...], dotall: bool = False) -> str:
    """What ``flags.meets`` asks, as a DuckDB condition."""
    option = "is" if dotall else "i"
    ahead = [m for p in patterns if (m := AHEAD.fullmatch(p))]
    parts = [converted(p) for p in patterns if not AHEAD.fullmatch(p)]
    groups = [(column, "|".join(f"(?:{p})" for p in parts[k : k + TOGETHER])) for k in range(0, len(parts), TOGETHER)]
    # a word and spaces without another word behind: the text without the two, one space apart, still has the first and a space
    groups += [(f"regexp_replace({column}, {sql(converted(rf'{a}\s{b}'))}, '', 'gi')", converted(rf"{a}\s")) for a, b in (m.groups() for m in ahead)]
    return "coalesce(" + " OR ".join(f"regexp_matches({c}, {sql(g)}, '{option}')" for c, g in groups) + ", false)"


def found_in(pattern: str, patterns: tuple[str, ...]) -> bool:
    """Whether one of ``patterns`` is found in the text of ``pattern`` itself."""
    return any(re.search(p, pattern, re.I) for p in patterns)
