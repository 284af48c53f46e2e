"""Operators against plain Python: greedy removal, set joins, ranks, merges, readers."""

import itertools
import json

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import joins, ranking
from tessera.operators import similarity as sim
from tessera.sources import readers, writers
from tessera.streaming import comments as live


def word_sets(sf):
    import duckdb

    rows = duckdb.connect().execute(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    return {i: frozenset(t.lower().split()) for i, t in rows if t and t.split()}


def jac(a, b):
    return len(a & b) / len(a | b)


def test_greedy_and_links(spark, sf):
    sets = word_sets(sf)
    df = spark.read.parquet(f"{sf}/documents.parquet")
    members, distinct = sim.contents(df, "doc_id", F.array_sort(F.array_distinct(text.tokens(F.lower("text")))))
    links = sim.jaccard_links(distinct, 0.7)
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] != sets[b] and jac(sets[a], sets[b]) >= 0.7}
    first = {s: min(i for i, x in sets.items() if x == s) for s in set(sets.values())}
    assert {(r.a, r.b) for r in links.collect()} == {(a, b) for a, b in want if first[sets[a]] == a and first[sets[b]] == b}
    kept = []
    for i in sorted(sets):
        if all(jac(sets[i], sets[k]) < 0.7 for k in kept):
            kept.append(i)
    assert sorted(r.id for r in sim.greedy_kept(members, links).where("kept").collect()) == kept


def test_greedy_is_not_closure(spark):
    members = spark.createDataFrame([(i, i, 1) for i in range(6)], "id long, content long, copies long")
    links = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0), (4, 5, 1.0)], "a long, b long, score double")
    assert [r.id for r in sim.greedy_kept(members, links).where("kept").orderBy("id").collect()] == [0, 2, 4]
    assert {(r.id, r.class_id, r.n_links) for r in sim.classes(members, links).collect()} == {(0, 0, 1), (1, 0, 2), (2, 0, 2), (3, 0, 1), (4, 4, 1), (5, 4, 1)}


def test_cosine_links(spark):
    import math
    import random

    rng = random.Random(3)
    docs = {i: [rng.choice("abcdefghijklmnop") for _ in range(12)] for i in range(40)}
    for i in range(40, 60):
        docs[i] = docs[i - 40][:-1] + ["z"]
    n, df = len(docs), {}
    for w in docs.values():
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    vec = {}
    for i, w in docs.items():
        v = {x: (1 + math.log(w.count(x))) * (math.log((1 + n) / (1 + df[x])) + 1) for x in set(w)}
        norm = math.sqrt(sum(y * y for y in v.values()))
        vec[i] = {x: y / norm for x, y in v.items()}
    want = {(a, b) for a, b in itertools.combinations(docs, 2) if sum(y * vec[b].get(x, 0) for x, y in vec[a].items()) >= 0.85}
    distinct = spark.createDataFrame([(i, w, 1) for i, w in docs.items()], "content long, features array<string>, copies long")
    assert {(r.a, r.b) for r in sim.cosine_links(sim.tfidf(distinct), 0.85).collect()} == want and want


def test_ranks(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    assert [r["rank"] for r in ranking.global_rank(df, [F.col("id").desc()]).orderBy(F.desc("id")).collect()] == list(range(1, 1001))
    got = ranking.group_rank(df, ["g"], [F.col("id")]).collect()
    assert all(r["rank"] == r.id // 3 + 1 and r.group_size == (334 if r.g == 0 else 333) for r in got)


def test_updates(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "new"), (3, "z")], "k int, v string")
    assert sorted(map(tuple, joins.upsert(a, b, ["k"]).collect())) == [(1, "x"), (2, "new"), (3, "z")]
    assert sorted(map(tuple, joins.update_from(a, b, "k", ["v"]).collect())) == [(1, "x"), (2, "new")]


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "reply").mkdir()
    (tmp_path / "reply" / "a.txt").write_text('Here you are\n```csv\nmongo_id,normalized_arabert,label\n1,"a, b",positif\n2,c,negatif\n```', encoding="utf-8")
    got = readers.csv_of_reply(spark, str(tmp_path / "reply"), ["mongo_id", "normalized_arabert", "label"], "normalized_arabert")
    assert sorted(map(tuple, got.collect())) == [("1", "a, b", "positif"), ("2", "c", "negatif")]
    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\n2,z,too,many\n3,w\n')
    assert {r.a for r in readers.csv_tolerant(spark, str(tmp_path / "t.csv"), ["a", "b"]).collect()} >= {"1", "3"}
    (tmp_path / "t.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    assert readers.json_array(spark, str(tmp_path / "t.json")).count() == 2
    df = spark.createDataFrame([(1, ["x", "y"]), (1, ["x"]), (2, [])], "k int, v array<string>")
    for _ in range(2):
        writers.append_new(df, str(tmp_path / "t"), "k")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    writers.csv(df, str(tmp_path / "c"))
    assert '"x,y"' in "".join(p.read_text() for p in (tmp_path / "c").glob("*.csv"))


def test_stream_counts_each_message_once(spark, sf, tmp_path):
    """Several batches, and one that is repeated, give what one pass over all rows gives."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    rows = events.select(F.col("event_type").alias("key"), "ts", "event_id", F.col("user_id").cast("string").alias("label"))
    rows.repartition(5).write.parquet(str(tmp_path / "in"))
    sink = live.frequency_sink(str(tmp_path / "table"), "key", "ts", "event_id", ["label"])
    stream = live.table_stream(spark, str(tmp_path / "in"), rows.schema, 1)
    stream.writeStream.foreachBatch(lambda df, n: (sink(df, n), sink(df, n))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    want = live.fold(rows, "key", "ts", "event_id", ["label"])
    assert sorted(map(tuple, live.current(spark, str(tmp_path / "table")).collect())) == sorted(map(tuple, want.collect()))


def test_scores_are_given_once(spark, tmp_path):
    """Only keys that are new to the table are scored, a repeated batch changes nothing, and other parts are not rewritten."""
    seen = []

    def score(df):
        seen.append(sorted(r.key for r in df.select("key").collect()))
        return df.withColumn("label", F.concat(F.lit("batch "), F.lit(len(seen))))

    sink = live.frequency_sink(str(tmp_path / "t"), "key", "ts", "id", [], score)
    batch = lambda *rows: spark.createDataFrame([(k, i, i) for k, i in rows], "key string, ts long, id long")
    sink(batch(("a", 1), ("b", 2), ("a", 3)), 0)
    sink(batch(("b", 4), ("c", 5)), 1)
    sink(batch(("b", 4), ("c", 5)), 1)
    sink(batch(("a", 0)), 2)
    got = {r.key: (r.frequence, r.id, r.label) for r in live.current(spark, str(tmp_path / "t")).collect()}
    assert got == {"a": (3, 0, "batch 1"), "b": (2, 2, "batch 1"), "c": (1, 5, got["c"][2])} and got["c"][2] in ("batch 2", "batch 3")
    assert seen == [["a", "b"], ["c"], ["c"], []]


def test_nearest_with_odd_vectors(spark):
    from tessera.operators.search import nearest

    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (None, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [1.0, 0.0, 0.0]), (8, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = [(r.query_id, r.id, r.rank) for r in nearest(df, df.where("id in (1, 3)"), "id", "v", 3).orderBy("query_id", "rank").collect()]
    assert got == [(1, 8, 1), (1, 2, 2), (1, 4, 3)]
    assert nearest(df, df.where("id = 99"), "id", "v", 3).count() == 0


def test_character_ngrams_are_the_truth(spark):
    """Links by character 3- to 5-grams against cosines straight from the definition."""
    import math
    from collections import Counter

    texts = ["le service est bon et rapide", "le service est bon et rapide.", "un autre texte", "ab", "", None, "le service est bon et rapide"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members, distinct = sim.contents(df, "doc_id", F.array(F.lower(F.nullif("text", F.lit("")))))
    grams = distinct.where("features[0] is not null").select("content", "copies", text.character_ngrams(F.col("features")[0], 3, 5).alias("features"))
    links = {(r.a, r.b): r.score for r in sim.cosine_links(sim.tfidf(grams, sublinear=False), 0.5).collect()}
    docs = {i: Counter(t[k : k + n] for n in (3, 4, 5) for k in range(len(t) - n + 1)) for i, t in enumerate(texts) if t and len(t) >= 3}
    n, df_ = len(docs), Counter(g for c in docs.values() for g in c)
    n += 1  # the text of two letters has no grams but counts as a document
    vec = {i: {g: k * (math.log((1 + n) / (1 + df_[g])) + 1) for g, k in c.items()} for i, c in docs.items()}
    cos = lambda a, b: sum(a[g] * b[g] for g in a if g in b) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    assert set(links) == {(0, 1)} and math.isclose(links[0, 1], cos(vec[0], vec[1]), rel_tol=1e-9)


def test_typed_fields_and_rejects(spark):
    target = spark.createDataFrame([(1, 1.0, False), (2, 2.0, True), (3, 3.0, True)], "k long, x double, ok boolean")
    fields = spark.createDataFrame([(1, " 7.5 ", "Oui"), (2, "none", "peut-être"), (9, "1", "non")], "k long, x string, ok string")
    updated, rejected = joins.update_typed(target, fields, "k", {"x": "double", "ok": "bool"})
    assert sorted(map(tuple, updated.collect())) == [(1, 7.5, True), (2, 2.0, True), (3, 3.0, True)] and [r.k for r in rejected.collect()] == [9]


def test_tables_are_copied_sorted_and_dropped(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 97 as k", "id")
    writers.sorted_table(df, str(tmp_path / "sorted"), "k", 4)
    files = [sorted(r.k for r in spark.read.parquet(str(f)).collect()) for f in (tmp_path / "sorted").glob("*.parquet")]
    assert sum(map(len, files)) == 1000 and all(a[-1] < b[0] for a, b in itertools.pairwise(sorted(files)))
    for name in ("t_old", "t_new", "t_buckets"):
        writers.drop_table(spark, name)
    writers.replace_table(df, "t_old")
    writers.copy_table(spark, "t_old", "t_new")
    writers.bucketed_table(df, "t_buckets", "k", 4)
    assert spark.table("t_new").count() == spark.table("t_buckets").count() == 1000
    plan = spark.table("t_buckets").alias("a").join(spark.table("t_buckets").alias("b"), "k")._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan
    for name in ("t_old", "t_new", "t_buckets"):
        writers.drop_table(spark, name)
        assert not spark.catalog.tableExists(name)


def test_dictionaries_and_lines(spark, tmp_path):
    import pytest

    (tmp_path / "d.json").write_text(json.dumps({"emojis": {"👍": "bravo"}}), encoding="utf-8")
    assert readers.dictionaries(spark, str(tmp_path / "d.json")) == {"emojis": {"👍": "bravo"}}
    with pytest.raises(ValueError, match="bytes"):
        readers.dictionaries(spark, str(tmp_path / "d.json"), 3)
    (tmp_path / "a.txt").write_text("one\n\n  \ntwo", encoding="utf-8")
    assert [r.text for r in readers.text_lines(spark, str(tmp_path / "a.txt")).collect()] == ["one", "two"]


def test_late_rows_are_dropped_from_streams(spark, tmp_path):
    """Sessions and windows of a stream leave out what comes later than the watermark allows."""
    import datetime

    at = lambda m: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)
    source = tmp_path / "in"
    batches = [[("a", at(0)), ("a", at(5)), ("b", at(300))], [("a", at(10)), ("b", at(305))], [("b", at(900))]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(str(source))
        out = live.sessions(live.table_stream(spark, str(source), "k string, ts timestamp", 1), "ts", ["k"], "30 minutes", "1 minute")
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    got = {(r.k, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert ("a", 2) in got and ("a", 3) not in got and ("b", 2) in got


def test_batch_totals_and_marks(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    seen = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert tuple(live.batch_statistics(batch, seen, "k").first()) == (4, 2, 2)
    assert tuple(live.batch_statistics(batch, None, "k").first()) == (4, 3, 1)
    assert sorted((r.k or "", r.sent) for r in live.mark_sent(batch.distinct(), seen, "k").collect()) == [("", False), ("a", True), ("b", False)]


def test_normalised_messages(spark):
    df = spark.createDataFrame([("Très   bon !!",), ("  ",), (None,), ("#x @y",)], "commentaire string")
    got = live.normalised(df).collect()
    assert [r.texte_normalise for r in got] == ["très bon"] and len(got[0].hash_texte) == 32
