import random
from collections import defaultdict

import pytest

from tessera.llm import passages
from tessera.llm.common import ascii_words

from .cases import empty, odd, odd_rows, table


def shared(rows, n):
    """Documents that have a run of n words in common with another id."""
    at = defaultdict(set)
    for i, text in rows:
        w = (text or "").encode().lower().split()
        for k in range(len(w) - n + 1):
            at[b" ".join(w[k : k + n])].add(i)
    return {i for ids in at.values() if len(ids) > 1 for i in ids}


def line_sets(rows):
    """(doc_id, set of five-word shingles) of each line of 20 words or more."""
    for i, text in rows:
        for line in (text or "").encode().lower().split(b"\n"):
            w = line.split()
            if len(w) >= passages.PARAGRAPH_WORDS:
                yield i, frozenset(b" ".join(w[k : k + 5]) for k in range(len(w) - 4))


def near_line_pairs(rows):
    """Pairs of ids with a pair of lines whose sets have a similarity of 0.8 or more, from all pairs that share a shingle."""
    sets = list(line_sets(rows))
    holders, common = defaultdict(list), defaultdict(int)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for ks in holders.values():
        for b in ks:
            for a in ks:
                if a < b:
                    common[a, b] += 1
    return {tuple(sorted((sets[a][0], sets[b][0]))) for (a, b), n in common.items() if 5 * n >= 4 * (len(sets[a][1]) + len(sets[b][1]) - n) and sets[a][0] != sets[b][0]}


def check(df, rows):
    got = df.collect()
    texts = dict(rows)
    assert shared(rows, 31) <= {r.doc_id for r in got}
    first = {c: r.first_doc_id for r in got for c in r.class_ids}
    holds = defaultdict(set)
    for r in got:
        assert r.n_words >= passages.PARAGRAPH_WORDS and r.removed == (r.doc_id != r.first_doc_id) and r.class_id == r.class_ids[0]
        assert 0 <= r["at"] and r["at"] + r.n_words <= len(texts[r.doc_id].encode().lower().split())
        for c in r.class_ids:
            assert first[c] == r.first_doc_id
            holds[c].add(r.doc_id)
    assert all(len(ids) > 1 and min(ids) == first[c] for c, ids in holds.items())  # each class has all its members, and its first stays
    return got


def test_whole_table(spark, sf):
    rows = [r[:2] for r in table(sf, "documents")]
    got = {r.doc_id for r in check(passages.repeated_passages(spark.read.parquet(f"{sf}/documents.parquet")), rows)}
    near = near_line_pairs(rows)
    assert sum(a in got and b in got for a, b in near) >= 0.98 * len(near) > 0
    # nothing is found that neither shares a run of 20 words with another document nor has a near line there
    assert got <= shared(rows, passages.PARAGRAPH_WORDS) | {i for p in near for i in p}


def test_odd_rows(spark):
    rows = [r[:2] for r in odd_rows() if r[0] is not None]
    got = {r.doc_id for r in check(passages.repeated_passages(odd(spark)), rows)}
    assert {14, 15, 16, 17, 19} <= got and not got & {0, 1, 4, 18, 20, 100}


def pairs_of(kind, rng):
    """Two texts that share a passage, of the given kind."""
    word = lambda: f"w{rng.randrange(100_000)}"
    around = lambda: [word() for _ in range(rng.randint(10, 60))]
    n, edits, inside = kind
    a = [word() for _ in range(n)]
    b = list(a)
    for k in edits(rng):
        b[k] = word()
    return [" ".join(around() + x + around()) if inside else " ".join(x) for x in (a, b)]


KINDS = {
    "25 words, equal": (25, lambda rng: [], False),
    "40 words, last differs": (40, lambda rng: [39], False),
    "60 words, middle differs": (60, lambda rng: [30], False),
    "100 words, middle differs": (100, lambda rng: [50], False),
    "40 words inside, one near the end differs": (40, lambda rng: [37], True),
    "51 to 60 words inside, equal": (55, lambda rng: [], True),
    "60 words inside, any one differs": (60, lambda rng: [rng.randrange(60)], True),
    "80 words inside, any one differs": (80, lambda rng: [rng.randrange(80)], True),
    "100 words inside, any two differ": (100, lambda rng: rng.sample(range(100), 2), True),
    "150 words inside, any three differ": (150, lambda rng: rng.sample(range(150), 3), True),
}


def test_recall(spark):
    """Of each kind of near passage at least 0.95 is found, and nothing else."""
    rng = random.Random(4)
    rows, kinds = [], []
    for name, kind in KINDS.items():
        for _ in range(120):
            kinds.append(name)
            rows += [(len(rows) + k, t) for k, t in enumerate(pairs_of(kind, rng))]
    lone = [(len(rows) + k, " ".join(f"x{rng.randrange(300)}" for _ in range(200))) for k in range(200)]
    got = {r.doc_id for r in passages.repeated_passages(spark.createDataFrame(rows + lone, "doc_id long, text string")).collect()}
    assert not got & {i for i, _ in lone}
    found = defaultdict(int)
    for k, name in enumerate(kinds):
        found[name] += {2 * k, 2 * k + 1} <= got
    print({k: v / 120 for k, v in found.items()})
    for name in KINDS:
        assert found[name] >= 0.95 * 120, (name, found[name])


def test_similar_lines_meet_beyond_the_least(spark):
    """A chain of edits: lines that are similar to others of their band, but not to its least, come into one class."""
    rng = random.Random(9)
    at = [f"w{rng.randrange(9999)}" for _ in range(100)]
    rows = []
    for i in range(24):
        rows.append((i, " ".join(at)))
        at[rng.randrange(100)] = f"y{i}"
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = [r for r in got if r["at"] == 0 and r.n_words == 100 and r.first_doc_id == 0]
    assert {r.doc_id for r in whole} == set(range(24)) and len({c for r in whole for c in r.class_ids if all(c in x.class_ids for x in whole)}) >= 1


def test_removals_keep_one_of_each(spark):
    """Adjoining passages with different first documents: each stays where it is first."""
    rng = random.Random(2)
    a, b, c = ([f"{k}{rng.randrange(9999)}" for _ in range(60)] for k in "abc")
    rows = [(1, a), (5, a + b), (9, b + c), (12, c + b)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in passages.removals(df).collect()}
    words = {r[0]: r[1] for r in df.select("doc_id", ascii_words(df.text)).collect()}
    left = [w for i, ws in words.items() for k, w in enumerate(ws) if not any(s["at"] <= k < s["at"] + s.n_words for s in spans.get(i, []))]
    assert 1 not in spans and set(a + b + c) <= set(left)
    # of each of the four later copies at most 11 words at either end lie outside its paragraphs
    assert len(left) <= len(a + b + c) + 4 * 2 * (passages.SPACING - 1)


@pytest.mark.parametrize("limit", [0])
def test_without_broadcast(spark, limit):
    old, passages.MAX_IDS = passages.MAX_IDS, limit
    try:
        check(passages.repeated_passages(odd(spark)), [r[:2] for r in odd_rows() if r[0] is not None])
    finally:
        passages.MAX_IDS = old


def test_empty(spark):
    assert passages.repeated_passages(empty(spark)).count() == 0 and passages.removals(empty(spark)).count() == 0
