import random
import re

import pytest
import xxhash

from tessera.llm import simhash
from tessera.operators.work import components

from .cases import empty, odd, odd_rows, plain, table


def brute(rows):
    fps = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sh = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        fps.append((i, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))))
    left, comp = set(range(len(fps))), {}
    while left:
        grow = [left.pop()]
        seen = list(grow)
        while grow:
            x = grow.pop()
            near = [y for y in left if (fps[x][1] ^ fps[y][1]).bit_count() <= 2]
            left.difference_update(near)
            grow += near
            seen += near
        least = min((fps[x][0] for x in seen if fps[x][0] is not None), default=None)
        comp |= dict.fromkeys(seen, least)
    return sorted(((i, fp - (1 << 64) if fp >> 63 else fp, comp[k]) for k, (i, fp) in enumerate(fps)), key=repr)


def test_whole_table(spark, sf):
    rows = [(r[0], r[1]) for r in table(sf, "documents")]
    assert plain(simhash.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))) == brute(rows)


def test_odd_rows(spark):
    assert plain(simhash.near_duplicates(odd(spark))) == brute([(r[0], r[1]) for r in odd_rows()])


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("entry_rows", [256, 3, 0])
def test_links_join_all_within_two_bits(spark, monkeypatch, entry_rows):
    """With all entries fetched as they are, with some too large, and with all too large."""
    monkeypatch.setattr(simhash, "ENTRY_ROWS", entry_rows)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)] + [0, (1 << 64) - 1]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(30)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    links = {(r.a, r.b) for r in found.collect()}
    assert all((((a ^ b) & (1 << 64) - 1).bit_count()) <= 2 for a, b in links)
    roots = {r.node: r.root for r in components(found).collect()}
    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                assert roots[a] == roots[b]
                assert entry_rows < 256 or (b, a) in links
