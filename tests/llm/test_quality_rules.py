import re
from collections import Counter

from tessera.llm import quality_rules as q

from .cases import empty, odd, odd_rows, plain, table


def brute(i, text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    c = Counter(grams)
    rep = len({p for k, g in enumerate(grams) if c[g] > 1 for p in (k, k + 1, k + 2)})
    n, chars, sym, dup = len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    base = n < 50 or 100 * rep > 50 * n
    return (i, n, chars, sym, dup, rep, base, not (base or chars < 2 * n or chars > 15 * n or 10 * sym > n or 20 * dup > n))


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = sorted((brute(*r[:2]) for r in table(sf, "documents")), key=repr)
    assert plain(q.measured(docs)) == want
    assert sorted(r.doc_id for r in q.kept(docs).collect()) == sorted(r[0] for r in want if r[-1])


def test_odd_rows(spark):
    assert plain(q.measured(odd(spark))) == sorted((brute(*r[:2]) for r in odd_rows()), key=repr)
    assert q.kept(odd(spark)).columns == odd(spark).columns


def test_empty(spark):
    assert q.measured(empty(spark)).count() == 0 and q.kept(empty(spark)).count() == 0


def test_order_does_not_change_the_verdict(spark, sf):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    keeps = [sorted(r.doc_id for r in docs.where(q.first_failure(q.ascii_words(F.col("text")), F.col("text"), order).isNull()).collect()) for order in (list(q.RULES), list(q.RULES)[::-1])]
    assert keeps[0] == keeps[1]
