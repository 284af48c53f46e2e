"""Set joins leave little on disk: rounds, sketches, and no shuffle files or tables that nothing reads."""

import itertools
import random

from pyspark.sql import functions as F

from tessera.operators import prefixes
from tessera.operators import similarity as sim
from tessera.operators.work import discard, new_folder, saved


def on_disk(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_written_tables_leave_no_shuffle_files(spark):
    before = on_disk(spark)
    out = saved(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n")), "sums")
    assert on_disk(spark) <= before and out.count() == 7


def test_discarded_tables_are_gone_and_others_stay(spark, tmp_path):
    kept = str(tmp_path / "kept")
    spark.range(3).write.parquet(kept)
    out, other = saved(spark.range(5), "five"), spark.read.parquet(kept)
    path = spark._jvm.org.apache.hadoop.fs.Path(out.inputFiles()[0]).getParent()
    discard(out, other)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) and other.count() == 3


def test_rounds_lose_no_pair(spark, monkeypatch):
    """Sets of all sizes, more similar pairs than a round takes, and very long ones, whose sketches are full."""
    monkeypatch.setattr(prefixes, "SLICE", 300)
    monkeypatch.setattr(prefixes, "SETS_A_PAIR", 1)
    monkeypatch.setattr(prefixes, "FEW", 20)
    rng = random.Random(8)
    rows = []
    for n in (1, 2, 7, 30, 90, 4000):
        base = [f"w{n}-{k}" for k in range(n)]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(max(1, n // 4) + 1)):
                w[rng.randrange(n)] = f"x{rng.randrange(60)}"
            rows.append(sorted(set(w)))
    df = spark.createDataFrame(list(enumerate(rows)), "id long, w array<string>")
    _, distinct = sim.contents(df, "id", F.col("w"))
    sets = {r.content: set(r.features) for r in distinct.collect()}
    for threshold in (0.7,):
        want = {(a, b): (len(sets[a] & sets[b]), len(sets[a] & sets[b]) / len(sets[a] | sets[b])) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-12}
        got = sim.jaccard_links(distinct, threshold).collect()
        assert {(r.a, r.b): (r.common, r.score) for r in got} == want and len(got) == len(want) and want


def test_sketches_bar_most_pairs(spark):
    """Sets that share one rare feature and no more meet, and are not read again."""
    rows = [(i, [f"p{i // 2}"] + [f"{i}-{k}" for k in range(40)]) for i in range(200)]
    distinct = spark.createDataFrame(rows, "content long, features array<string>")
    sets = distinct.select("content", prefixes.numbered(F.col("features"), "array<string>").alias("features"))
    found = prefixes.heads(sets, 0.5)
    x, y = (prefixes.entries(found, k) for k in ((0, 2), (1, 2)))
    assert x.join(y, "f").isEmpty()  # a feature is of one round
    met = prefixes.met(found, lambda k: (lambda e: e.alias("x").join(e.alias("y"), (F.col("x.f") == F.col("y.f")) & (F.col("x.content") < F.col("y.content")) & prefixes.may_be_similar("x", "y", 0.5)).select(F.col("x.content").alias("a"), F.col("y.content").alias("b")))(prefixes.entries(found, k)))
    assert met.count() <= 5


def test_tables_go_to_their_own_folder(spark):
    assert spark.sparkContext.applicationId in new_folder(spark, "x")
