import math
import os
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import kneser_ney as kn
from tessera.operators.work import shared_folder

from .cases import empty, odd, odd_rows


def brute(texts):
    """log10 p(w | u v) of an interpolated modified Kneser-Ney model, straight from the definition."""
    docs = [[w for w in kn.TOKEN.findall(t.lower())] for t in texts]
    freq = Counter(w for d in docs for w in d)
    known = {w for w, n in freq.items() if n > 1}
    rare = sum(1 for n in freq.values() if n == 1)
    c3 = Counter()
    for d in docs:
        w = ["<s>", "<s>"] + [x if x in known else "<u>" for x in d]
        c3.update(zip(w, w[1:], w[2:]))
    left = defaultdict(set)
    raw = Counter()
    for (a, b, c), n in c3.items():
        left[b, c].add(a)
        raw[b, c] += n
    c2 = Counter({k: raw[k] if k[0] == "<s>" else len(v) for k, v in left.items()})
    c1 = Counter(c for b, c in c2 if b != "<s>")

    def discounts(c):
        n = [sum(1 for v in c.values() if v == k) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
        d = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else y for k in range(3)]
        return [min(max(x, 0.01), k + 0.99) for k, x in enumerate(d)]

    ds = [discounts(c) for c in (c1, c2, c3)]

    def p(c, d, gram, lower):
        ctx = [(g, n) for g, n in c.items() if (g[:-1] if isinstance(g, tuple) else ()) == gram[:-1]]
        total = sum(n for _, n in ctx)
        if not total:
            return lower
        own = c.get(gram if len(gram) > 1 else gram[0], 0)
        gamma = sum(d[min(n, 3) - 1] for _, n in ctx) / total
        return (max(own - d[min(own, 3) - 1], 0) if own else 0) / total + gamma * lower

    def log10_p(u, v, w):
        x = tuple(t if t in known or t == "<s>" else "<u>" for t in (u, v, w))
        p1 = p(c1, ds[0], x[2:], 1 / (len(c1) + 1))
        return math.log10(p(c3, ds[2], x, p(c2, ds[1], x[1:], p1))) - (0 if w in known else math.log10(rare + 1))

    return log10_p


TEXTS = ["the cat sat on the mat . the cat ran", "a dog sat on a log , the dog ran off", "the cat and the dog sat", "on the mat the dog sat , the end", "zebra once"]


def test_probabilities(spark, tmp_path):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    rows, unseen = kn.fit(df)
    model = kn.Model(kn.save_model(rows, f"file://{tmp_path}/model"), unseen)
    want = brute(TEXTS)
    for text in [*TEXTS, "the dog sat on the zebra", "never seen words here", "mat the", ".", "the"]:
        w = ["<s>", "<s>", *kn.TOKEN.findall(text.lower())]
        got = model.log10_p(np.concatenate([np.full(2, kn.START, np.uint64), model.ids(text)]))
        assert np.allclose(got, [want(*w[k : k + 3]) for k in range(len(w) - 2)], atol=1e-5), text
        for stretch in (1 << 18, 3):
            kn.STRETCH = stretch
            (n, p), (other, _), (none, null) = model.perplexities([text, TEXTS[0], None])
            assert n == len(w) - 2 and math.isclose(p, 10 ** -got.mean(), rel_tol=1e-9) and other == 10 and none == 0 and null is None
        kn.STRETCH = 1 << 18


def test_held_out_accuracy(spark):
    """Junk goes and clean texts stay, those that the model never saw included."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = kn.classify(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("toxic = 0").select("quality", "kept", "perplexity").collect()
    good, bad = [[r for r in rows if r.quality == q] for q in (1, 0)]
    assert sum(r.kept for r in good) / len(good) >= 0.98
    auc = np.mean([(x.perplexity > y.perplexity) for x in bad if x.perplexity for y in good if y.perplexity])
    assert auc >= 0.85


def test_odd_rows(spark):
    labels = spark.createDataFrame([(14, 1, 0), (15, 1, None), (17, 1, 1), (None, 1, 0), (6, 0, 0), (14, 1, 0)], "doc_id long, quality int, toxic int")
    got = kn.classify(odd(spark), labels).collect()
    assert len(got) == len(odd_rows())
    by = {r.doc_id: r for r in got}
    assert by[0].perplexity is None and not by[0].kept and by[1].n_tokens == 0 and by[14].n_tokens > 0
    none = kn.classify(odd(spark), labels.limit(0)).collect()
    assert all(r.kept == (r.n_tokens > 0) for r in none)
    assert kn.classify(empty(spark), labels).count() == 0


def test_all_trusted_texts_are_learnt(spark):
    """Of 3 million words of trusted texts four fifths are learnt: the words of so many texts are known."""
    text = F.concat_ws(" ", F.array_repeat(F.lit("so it goes on and on"), 500), F.array_repeat(F.concat(F.lit("w"), "doc_id"), 100))
    docs = spark.range(0, 1000, 1, 4).select(F.col("id").alias("doc_id")).select("doc_id", F.lit("en").alias("lang"), text.alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = [r.perplexity for r in kn.classify(docs, labels).collect()]
    known = sum(p < (min(got) + max(got)) / 2 for p in got)
    assert len(got) == 1000 and 760 <= known <= 840, known


def test_packs_and_shards_do_not_matter(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet").limit(300), spark.read.parquet(f"{d}/labels.parquet")
    want = {r.doc_id: r for r in kn.classify(docs.coalesce(1), labels).collect()}
    whole = kn.SHARD_TOKENS
    try:
        kn.SHARD_TOKENS = 3000
        got = kn.classify(docs.repartition(7), labels).collect()
    finally:
        kn.SHARD_TOKENS = whole
    assert len(got) == len(want) == 300
    for r in got:
        x = want[r.doc_id]
        assert (r.n_tokens, r.kept) == (x.n_tokens, x.kept) and math.isclose(r.perplexity or 0, x.perplexity or 0, rel_tol=1e-5)


def test_scores_against_the_definition(spark, monkeypatch):
    """Perplexities by counts from shards, also with common words in several pieces, packs of a text or two, and words by joins."""
    other = ["the dog sat on the zebra", "never seen words here", "mat the", ".", "", None, "the the the cat"]
    rows = [(k, "en", t, kn.TRAIN) for k, t in enumerate(TEXTS)] + [(100 + k, None, t, kn.NONE) for k, t in enumerate(other)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, part int").coalesce(2)
    log10_p = brute(TEXTS)
    want = {}
    for i, _, t, _ in rows:
        w = ["<s>", "<s>", *kn.TOKEN.findall((t or "").lower())]
        want[i] = 10 ** -np.mean([log10_p(*w[k : k + 3]) for k in range(len(w) - 2)]) if len(w) > 2 else None
    for change in ({}, {"SHARD_TOKENS": 6}, {"SHARD_TOKENS": 6, "PACK_BYTES": 30, "ROUNDS": 3}, {"MAX_WORDS": 0, "PACK_BYTES": 30}):
        with monkeypatch.context() as m:
            for name, value in change.items():
                m.setattr(kn, name, value)
            got = {r.doc_id: r for r in kn.scores(df).collect()}
        assert got.keys() == want.keys() and not [t for t in spark.catalog.listTables() if t.name.startswith("packs_")]
        for i, p in want.items():
            assert (got[i].perplexity is None) == (p is None), (change, i)
            assert p is None or math.isclose(got[i].perplexity, p, rel_tol=1e-9), (change, i)


def test_distinct_pairs():
    bc, a = np.array([7 << 32 | 2, 3 << 32 | 9, 7 << 32 | 2, 3 << 32 | 9], np.uint64), np.array([5, 1, 4, 1], np.uint64)
    for big in (0, 1 << 30):
        two, i, first, of = kn._distinct(bc, a + np.uint64(big))
        assert two.tolist() == [3 << 32 | 9, 7 << 32 | 2] and i.tolist() == [0, 1, 1] and (first - np.uint64(big)).tolist() == [1, 4, 5] and of.tolist() == [2, 0, 1, 0]


def test_tables_on_disk(spark):
    """All that is written in between takes less than 1.5 times the input."""
    d = "/root/testdata/sf0.1"
    folder = shared_folder(spark).removeprefix("file://")
    sizes = lambda: sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)
    before = sizes()
    kn.classify(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    assert sizes() - before < 1.5 * os.path.getsize(f"{d}/documents.parquet")
