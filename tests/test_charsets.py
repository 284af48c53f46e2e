"""Classes of character sets against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.charsets import character_classes


def brute(rows, percent):
    rows = [(i, t.lower().strip()) for i, t in rows if t is not None]
    to, links = list(range(len(rows))), [0] * len(rows)

    def root(k):
        while to[k] != k:
            k = to[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = set(rows[a][1]), set(rows[b][1])
            if rows[a][1] == rows[b][1] or x and y and 100 * len(x & y) >= percent * len(x | y):
                links[a] += 1
                links[b] += 1
                to[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(i, least.get(root(k), i))
    return sorted((i, least[root(k)], links[k]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("percent", (60, 85, 95))
def test_against_all_pairs(spark, percent):
    """Short and long sets, many rare characters, sets beyond the mask, and sets too large for parts."""
    rng = random.Random(percent)
    common, rare = "abcdefghijklmnopqrstuvwxyz ,.", [chr(0x4E00 + k) for k in range(500)]
    texts = [None, "", " ", "", "a", "A ", "ab", "ba"]
    texts += ["".join(rng.sample(common, rng.randint(2, 8))) for _ in range(60)]
    texts += [common + "".join(rng.sample(rare, rng.randint(0, 9))) for _ in range(40)]
    wide = rare[:60]
    texts += [common + "".join(rng.sample(wide, 55)) + "".join(rng.sample(rare[60:90], rng.randint(0, 6))) for _ in range(40)]
    texts += ["".join(rng.sample(rare, 430)) for _ in range(6)] + ["".join(rare[:470]), "".join(rare[5:475])]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = character_classes(spark.createDataFrame(rows, "id long, t string"), "id", F.col("t"), percent)
    assert sorted(map(tuple, got.collect())) == brute(rows, percent)
