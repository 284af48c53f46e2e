import re
from collections import Counter, defaultdict

from tessera.llm import collocations as co

from .cases import empty, odd, odd_rows, plain, table


def brute(rows, least=100, longest=5, top=2000, share=100):
    """rows of (lang, text)"""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + k] for p, a in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= share * cand[p[i : i + k]]}
        scored = []
        for p, a in cand.items():
            if p not in gone:
                s, _, le, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), le, r))
        out += [(lang, k + 1, p.decode(), -a, le, r, n[lang], -s) for k, (s, a, p, le, r) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def test_table(spark):
    rows = [(r[2], r[1]) for r in table("/root/testdata/sf0.01", "documents")]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute(rows)
    assert plain(co.collocations(docs)) == want and len(want) > 50
    want = brute(rows, least=20, top=50)
    assert plain(co.collocations(docs, least=20, top=50)) == want


def test_odd_rows_and_empty_table(spark):
    rows = [(r[2], r[1]) for r in odd_rows()]
    for least, longest in ((1, 5), (2, 3), (100, 5)):
        assert plain(co.collocations(odd(spark), least=least, longest=longest)) == brute(rows, least, longest)
    assert co.collocations(empty(spark)).count() == 0


def test_beyond_the_dictionaries(spark):
    """Too many words, or pairs, for the workers: whole windows, the same result."""
    rows = [("en", "A b c, a b c. a b d! x a b"), (None, "a b c d e f a b c d e f"), ("en", "a b\ta b c")] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    want = brute(rows, 2)
    for words, pairs in ((10**6, 10**6), (10**6, 0), (0, 0)):
        assert plain(co.collocations(docs, least=2, max_words=words, max_pairs=pairs)) == want


def test_exact_beyond_64_bits(spark):
    """1000 * a * n passes 64 bits, and the quotient is still exact."""
    from pyspark.sql import functions as F

    a, n, le, r = 9 * 10**12, 10**13 + 7, 3 * 10**12 + 1, 7 * 10**11
    row = spark.createDataFrame([(a, n, le, r)], "a long, n long, l long, r long")
    got = row.select(F.expr("cast((cast(1000 as decimal(38, 0)) * a * n) div (cast(l as decimal(38, 0)) * r) as bigint)")).first()[0]
    assert got == 1000 * a * n // (le * r)


def test_rows_of_windows(spark):
    """Words and pairs that the dictionaries have counted make no rows; the rows of windows grow as the text."""
    text = "a b x1 b c. x2 a b, c d e f! g h x3"
    rows = [("en", text.replace("x", f"x{k}")) for k in range(20)]
    made = []
    for times in (1, 5):
        docs = spark.createDataFrame(rows * times, "lang string, text string").coalesce(1)
        _, known = co.vocabulary(co.word_counts(docs), 10, 1000)
        often, pairs = co.frequent_pairs(docs, known, 10, 1000)
        assert often.count() == 6
        made.append(co.windows(docs, known, pairs, 5, 3).count())
        assert plain(co.collocations(docs, least=10)) == brute(rows * times, 10)
    assert made == [40, 200]  # c d e f and d e f, where there were rows of one word and of two as well
    docs = spark.createDataFrame(rows, "lang string, text string")
    for longest in (1, 2, 3):
        assert plain(co.collocations(docs, least=10, longest=longest)) == brute(rows, 10, longest)
