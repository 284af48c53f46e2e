import random
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import repeated_bytes as rb
from tessera.llm import suffix_array as sa
from tessera.llm.common import read

from .cases import empty, odd, odd_rows, plain, table


def brute(rows, width=50):
    """rows of (doc_id, text): windows in a dictionary with their least id."""
    last = float("inf")
    texts = [(last if i is None else i, i, (t or "").encode()) for i, t in rows]
    least = {}
    for rank, _, t in texts:
        for k in range(len(t) - width + 1):
            w = t[k : k + width]
            if rank < least.get(w, last):
                least[w] = rank
    out = []
    for rank, i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - width + 1):
            if least.get(t[k : k + width], last) < rank:
                gone[k : k + width] = b"\1" * width
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digests(df):
    return plain(df.select("doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"]), F.size("spans").cast("long"), F.sha2("kept", 256)))


def test_suffix_arrays():
    """Order, window holders and shared lengths of random strings over small and large alphabets."""
    rng = random.Random(5)
    for _ in range(150):
        alphabet = rng.choice([b"a", b"ab", b"abc", bytes(range(245)), b"\x00\x01\xf4z"])
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 12))]
        strings += [rng.choice(strings) + rng.choice(strings) for _ in range(rng.randint(0, 5))]
        holders, width = [rng.randint(0, 9) for _ in strings], rng.randint(1, 12)
        data, sizes = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
        text, starts = sa.joined(data, sizes)
        array = sa.suffix_array(text)
        raw = text.tobytes()
        suffixes = [raw[k : raw.index(1, k) + 1] for k in array.tolist() if k < len(raw) - 1]
        assert sorted(array.tolist()) == list(range(len(text))) and suffixes == sorted(suffixes)
        shared = sa.common_prefixes(text, array)[array]
        for k in range(1, len(suffixes)):
            a, b = suffixes[k - 1][:-1], suffixes[k][:-1]
            assert shared[k + 1] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        least, starts = sa.least_holders(data, sizes, np.array(holders), width)
        seen = {}
        for s, h in zip(strings, holders, strict=True):
            for k in range(len(s) - width + 1):
                seen[s[k : k + width]] = min(h, seen.get(s[k : k + width], h))
        for at, s in zip(starts.tolist(), strings, strict=True):
            assert least[at : at + max(0, len(s) - width + 1)].tolist() == [seen[s[k : k + width]] for k in range(len(s) - width + 1)]


def test_table(spark, sf):
    rows = [r[:2] for r in table(sf, "documents")]
    want = brute(rows)
    assert plain(rb.digests(read(spark, sf, "documents"))) == want and sum(r[2] for r in want) > 10_000
    assert digests(rb.without_repeats(read(spark, sf, "documents"), hot=3)) == want


def test_odd_rows_and_empty_table(spark):
    for hot in (rb.HOT, 1):
        assert digests(rb.without_repeats(odd(spark), hot=hot)) == brute([r[:2] for r in odd_rows()])
    assert rb.without_repeats(empty(spark)).count() == 0


def test_many_blocks(spark):
    """Copies, overlaps and periodic texts in every block; the smallest id is not the first row."""
    rng = random.Random(9)
    bases = ["".join(rng.choice("abcdefgh ") for _ in range(900)) for _ in range(4)] + ["ab" * 3000, "x" * 5000]
    rows = []
    for i in range(80):
        b = rng.choice(bases)
        k, n = rng.randrange(len(b)), rng.randrange(400)
        rows.append((rng.randrange(60), "".join(rng.choice("αβγ xyz") for _ in range(rng.randrange(80))) + b[k : k + n] + rng.choice(["", "é" * 70, b[:49], b[:50]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for hot in (rb.HOT, 5):
        assert digests(rb.without_repeats(docs, hot=hot)) == brute(rows)
    wide = 20
    assert digests(rb.without_repeats(docs, width=wide)) == brute(rows, wide)


def test_common_anchors_make_few_rows(spark):
    """Around an anchor that every text has, texts differ: their windows don't become rows, and a repeated one among them is found."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    common, again = "\x01\x02\x03 common anchor \x03\x02\x01", word(60)
    rows = [(i, "".join(word(60) + common for _ in range(6)) + (again + common if i in (7, 300) else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made, whole = [], rb.saved
    rb.saved = lambda df, name: made.append((name, whole(df, name))) or made[-1][1]
    try:
        got = digests(rb.without_repeats(docs, hot=50))
    finally:
        rb.saved = whole
    assert got == brute(rows) and next(r[2] for r in got if r[0] == 300) >= 60
    assert sum(df.count() for name, df in made if name == "hot-windows") < 1000
