import re
from collections import Counter, defaultdict

from tessera.llm import mixing

from .cases import empty, odd, odd_rows, plain, table


def targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while True:
        level = (total - sum(out.values())) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        out |= {s: 3.0 * sizes[s] for s in over}
        free -= over


def check(rows, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, _, s, *_ in docs:
        sizes[s] += size(t)
    want, taken = targets(sizes), defaultdict(int)
    assert sorted(((r.doc_id, r.size) for r in rows), key=repr) == sorted(((d[0], size(d[1])) for d in docs), key=repr)
    largest = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) <= 1e-9 * max(1, want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(mixing.mix(docs).collect(), table(sf, "documents"))
    assert plain(mixing.mix(docs)) == plain(mixing.mix(docs.repartition(7)))


def test_odd_rows(spark):
    check(mixing.mix(odd(spark)).collect(), odd_rows())


def test_capped_sources(spark):
    rows = [(i, "w " * 10, "en", "a" if i < 2 else "b", 1) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix(df).collect()
    check(got, rows)
    assert {r.copies for r in got if r.source == "a"} == {3}


def test_empty_and_rows(spark):
    assert mixing.mix(empty(spark)).count() == 0
    out = mixing.mixed(odd(spark))
    assert out.columns == odd(spark).columns
    copies = Counter()
    for r in mixing.mix(odd(spark)).collect():
        copies[r.doc_id, r.source, r.size] += r.copies
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, words(r.text)) for r in out.collect()) == +copies
