import random
from collections import Counter, defaultdict

from tessera.llm import near_copies
from tessera.llm.common import read

from .cases import PASSAGE, empty, odd, odd_rows, plain, table


def brute(rows):
    """The component of each row, from all pairs of different texts with a five-word Jaccard similarity of 0.8 or more."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s or [None]:
            holders[x].append(k)
    common = Counter((a, b) for ks in holders.values() for b in ks for a in ks if a < b)
    to = list(range(len(rows)))

    def root(k):
        while to[k] != k:
            k = to[k]
        return k

    for (a, b), n in common.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n) or sets[a] == sets[b]:
            to[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min((x for x in (i, least.get(root(k))) if x is not None), default=None)
    return sorted(((i, least[root(k)]) for k, (i, _) in enumerate(rows)), key=repr)


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [r[:2] for r in table(d, "documents")]
    assert plain(near_copies.near_copies(read(spark, d, "documents"))) == brute(rows)


def test_odd_rows(spark):
    assert plain(near_copies.near_copies(odd(spark))) == brute([r[:2] for r in odd_rows()])
    assert near_copies.keep_one_each(empty(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    """Rows without an id, or with one that others have, are lost only to a near copy; reruns agree."""
    kept = near_copies.keep_one_each(odd(spark))
    assert kept.columns == odd(spark).columns
    ids = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {14, 0, 100} <= {i for i, _ in ids} and not {15, 16} & {i for i, _ in ids}
    assert ids.count((100, "alpha beta")) == ids.count((100, "another text with the id of a text that differs")) == 1
    assert ids.count((None, "no id here at all")) == ids.count((None, "no id, and its only copy has none")) == 1 and (None, PASSAGE) not in ids
    assert plain(kept) == plain(near_copies.keep_one_each(odd(spark).repartition(5)))


def test_edited_copies_and_common_passages(spark):
    """Chains and groups of copies with a few changed words, and different texts that share a long passage."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    notice, rows = [word() for _ in range(60)], []
    for _ in range(6):
        base = [word() for _ in range(rng.choice((40, 120, 300)))]
        for _ in range(30):
            w = list(base)
            for _ in range(rng.randint(0, len(w) // 40 + 1)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w))
    rows += [" ".join(notice + [word() for _ in range(rng.choice((10, 30)))]) for _ in range(60)]
    at = [word() for _ in range(200)]
    for _ in range(30):
        at[rng.randrange(200)] = word()
        rows.append(" ".join(at))
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert plain(near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_simhash_brings_pairs(spark, monkeypatch):
    """Copies with one changed word in a long text meet by their fingerprints alone; so do equal fingerprints; each pair is verified."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(4000)]
    near = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (100, 1000, 2000)]
    rows = list(enumerate([" ".join(base), *near, "another text", "and one more"]))
    fps = [near_copies._fingerprint(near_copies.shingles(t.encode())) for _, t in rows]
    contents = spark.createDataFrame(list(zip(fps, range(len(rows)), strict=True)), "fp long, content long")
    got = {frozenset((r.a, r.b)) for r in near_copies._simhash_pairs(contents).collect()}
    assert {i for p in got for i in p} <= {0, 1, 2, 3} and all((fps[a] ^ fps[b]).bit_count() <= 2 for a, b in map(tuple, got))
    assert any(got)
    assert near_copies._fingerprint(near_copies.EMPTY) == 0
    seen = []
    links = near_copies.simhash.links
    monkeypatch.setattr(near_copies.simhash, "links", lambda fps: seen.append(fps.count()) or links(fps))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain(near_copies.near_copies(docs)) == brute(rows) and seen


def test_prefixes_are_written_once(spark, monkeypatch):
    """Rows that are equal in every column are one content, and prefixes go to no second table."""
    rows = [(1, PASSAGE)] * 3 + [(2, PASSAGE), (3, PASSAGE + " and more"), (4, "another text"), (4, "another text")]
    seen, save = [], near_copies.saved
    monkeypatch.setattr(near_copies, "saved", lambda df, name: seen.append((name, df.columns)) or save(df, name))
    assert plain(near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert [name for name, columns in seen if "prefix" in columns] == ["prefixes"]
