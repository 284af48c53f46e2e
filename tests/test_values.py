"""Membership, domains, damaged JSON, levels of agreement and judges."""

from pyspark.sql import functions as F

from tessera.functions import values
from tessera.operators import labels as lab


def test_missing_is_none_of_them(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert [r.x for r in df.where(values.not_in(F.col("x"), "a")).collect()] == ["b", None]


def test_each_row_is_in_one_part(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int")
    good, bad = values.split_valid(df, small=F.col("v") < 10, odd=F.col("id") % 2 == 1)
    assert [tuple(r) for r in good.collect()] == [(1, 5)]
    assert {(r.id, tuple(r.errors)) for r in bad.collect()} == {(2, ("small", "odd")), (3, ("small",))}


def test_damaged_json(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": "x"}',), ("{",), (None,), ('{"j": 2}',), ("[1]",)], "t string")
    default = F.struct(F.lit(-1).cast("long").alias("k"))
    assert [r.v.k for r in df.select(values.load_json(F.col("t"), "struct<k: bigint>", default).alias("v")).collect()] == [1, None, -1, -1, None, -1]
    assert df.select(values.dump_json(F.struct(F.lit(None).cast("int").alias("a"), F.lit(1).alias("b")))).first()[0] == '{"a":null,"b":1}'


def test_levels(spark):
    df = spark.createDataFrame([(x,) for x in (-0.1, 0.0, 0.2, 0.5, 0.79, 0.8, 1.0)], "k double")
    got = [r[0] for r in df.select(lab.kappa_level(F.col("k"), lab.ANNOTATOR_LEVELS, lab.ANNOTATOR_BELOW)).collect()]
    assert got == ["Très faible (désaccord)", "Très faible", "Faible", "Modérée", "Forte", "Presque parfaite", "Presque parfaite"]
    assert [r[0] for r in df.select(lab.kappa_level(F.col("k"))).collect()] == ["mauvais", "mauvais", "faible", "modere", "bon", "excellent", "excellent"]


def test_judges(spark):
    df = spark.createDataFrame([("a", "p", 1.0, "p"), ("a", None, 9.0, "p"), ("a", "n", 2.0, "p"), ("a", "n", 3.0, None), ("b", None, None, None)], "j string, v string, s double, t string")
    got = {r.judge: (r.n, r.failures, r.agreement, r.p50) for r in lab.compare_judges(df, "j", F.col("v"), F.col("s"), F.col("t")).collect()}
    assert got == {"a": (4, 1, 0.5, 2.5), "b": (1, 1, None, None)}


def test_shuffle_is_the_seed_s(spark):
    df = spark.range(50)
    first = [r.id for r in values.shuffled(df, "id", 1).orderBy("place").collect()]
    assert first == [r.id for r in values.shuffled(df.repartition(7), "id", 1).orderBy("place").collect()] and sorted(first) == list(range(50)) != first
    assert first != [r.id for r in values.shuffled(df, "id", 2).orderBy("place").collect()]
