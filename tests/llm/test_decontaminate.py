import re
from collections import defaultdict

from tessera.llm import decontaminate

from .cases import PASSAGE, empty, odd, odd_rows, plain, table

ITEMS = [(1, PASSAGE[:200]), (2, "one"), (3, None), (4, "  ... "), (5, "alpha beta"), (6, "ÜNÏ öde"), (7, "ünï Öde İstanbul"), (8, "Ünï ÖDE"), (1, "say " + PASSAGE[300:420]), (None, "gamma delta none")]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    wins = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9)) if w else ():
            wins[tuple(w[k : k + 10])].add(str(i) if i is not None else None)
    sizes = sorted({len(w) for w in wins})
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in wins:
                    hit |= set(range(k, k + n))
                    ids |= wins[x] - {None}
        out.append((i, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def test_whole_table(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = plain(decontaminate.item_hits(docs, items))
    assert got == brute([r[:2] for r in table(sf, "documents")], table(sf, "benchmark"))
    assert any(r[2] for r in got)


def test_odd_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for limit in (decontaminate.BROADCAST_ROWS, 0):
        decontaminate.BROADCAST_ROWS, old = limit, decontaminate.BROADCAST_ROWS
        try:
            assert plain(decontaminate.item_hits(odd(spark), items)) == brute([r[:2] for r in odd_rows()], ITEMS)
        finally:
            decontaminate.BROADCAST_ROWS = old


def test_empty(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.item_hits(empty(spark), items).count() == 0
    assert {r.n_hit for r in decontaminate.item_hits(odd(spark), items).collect()} == {0}
    clean = decontaminate.clean_documents(odd(spark), items)
    assert clean.count() == len(odd_rows()) and clean.columns == odd(spark).columns


def test_each_row_by_its_own_text(spark):
    """Contaminated rows go with or without an id, and clean rows that share their id stay."""
    item = " ".join(f"item{i}" for i in range(12))
    rows = [(1, "x " + item), (None, "y " + item), (None, "clean"), (1, "clean too"), (None, None), (1, "x " + item)]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert plain(decontaminate.clean_documents(docs, items)) == sorted([(None, "clean"), (1, "clean too"), (None, None)], key=repr)
    assert plain(decontaminate.item_hits(docs, items)) == brute(rows, [(1, item)])
