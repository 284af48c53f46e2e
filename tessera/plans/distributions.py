"""Distribution, trend and shape queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import aggregates as agg
from tessera.operators.ranking import group_rank, halves
from tessera.plans.base import AS_OF, comments, query, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
LABELS = agg.LABELS


def as_of():
    return F.lit(AS_OF).cast("timestamp")


@query("""WITH {comments}
SELECT source, count(*) AS total,
       count(*) FILTER (label = 'positif') AS positif, count(*) FILTER (label = 'neutre') AS neutre, count(*) FILTER (label = 'negatif') AS negatif,
       round(100.0::DOUBLE * count(*) FILTER (label = 'positif') / count(*), 1) AS pct_positif,
       round(100.0::DOUBLE * count(*) FILTER (label = 'neutre') / count(*), 1) AS pct_neutre,
       round(100.0::DOUBLE * count(*) FILTER (label = 'negatif') / count(*), 1) AS pct_negatif
FROM comments GROUP BY source""")
def source_label_stats(spark, sf_dir):
    return agg.label_stats(comments(spark, sf_dir), ["source"]).orderBy(F.desc("total"), "source")


@query("""WITH {comments}
SELECT count(*) AS total,
       count(*) FILTER (label = 'positif') AS positif, count(*) FILTER (label = 'neutre') AS neutre, count(*) FILTER (label = 'negatif') AS negatif,
       round(100.0::DOUBLE * count(*) FILTER (label = 'positif') / count(*), 1) AS pct_positif,
       round(100.0::DOUBLE * count(*) FILTER (label = 'neutre') / count(*), 1) AS pct_neutre,
       round(100.0::DOUBLE * count(*) FILTER (label = 'negatif') / count(*), 1) AS pct_negatif
FROM comments WHERE label IS NOT NULL""")
def label_totals_pct(spark, sf_dir):
    return agg.label_stats(comments(spark, sf_dir).where("label is not null"), [])


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def group_count_desc(spark, sf_dir):
    return agg.value_counts(table(spark, sf_dir, "events"), "event_type").orderBy(F.desc("n"), "event_type")


@query("SELECT event_type, round(sum(value), 2) AS weight, count(*) AS n FROM events GROUP BY event_type")
def weighted_label_sum(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("weight"), F.count("*").alias("n"))


@query("SELECT event_type, count(value) AS n, round(avg(value), 4) AS mean, round(median(value), 4) AS median, min(value) AS least, max(value) AS greatest FROM events GROUP BY event_type")
def confidence_stats(spark, sf_dir):
    d = agg.distribution(table(spark, sf_dir, "events"), ["event_type"], "value")
    return d.select("event_type", "n", F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"), "least", "greatest")


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types, count(*) AS n FROM events")
def distinct_sessions(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.countDistinct("user_id").alias("users"), F.countDistinct("event_type").alias("types"), F.count("*").alias("n"))


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 2) AS weight FROM events GROUP BY 1, 2")
def daily_label_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("weight"))


@query("SELECT hour(ts)::INT AS hour, count(*) AS n FROM events GROUP BY 1")
def hourly_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.hour("ts").alias("hour")).agg(F.count("*").alias("n"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS total,
       count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P,
       round(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'F') / count(*), 1) AS pct_F,
       round(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'O') / count(*), 1) AS pct_O,
       round(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'P') / count(*), 1) AS pct_P
FROM orders GROUP BY 1""")
def monthly_label_pct(spark, sf_dir):
    months = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return agg.label_stats(months, ["month"], ("F", "O", "P"), "o_orderstatus")


@query("""SELECT substr(strftime(o_orderdate, '%d/%m/%Y'), 4, 2) AS month, count(*) AS n FROM orders GROUP BY 1""")
def month_key_without_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.substring(F.date_format("o_orderdate", "dd/MM/yyyy"), 4, 2).alias("month")).agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT strftime(ts, '%Y-%W') AS week, count(*) AS n, round(100.0::DOUBLE * count(*) FILTER (event_type = 'error') / count(*), 1) AS pct_error,
       min(CAST(date_trunc('week', ts) AS DATE)) AS monday FROM events GROUP BY 1 HAVING count(*) >= 10)
SELECT * FROM w ORDER BY pct_error DESC, week LIMIT 1""")
def weekly_peak(spark, sf_dir):
    from tessera.functions.dates import week_key

    weeks = table(spark, sf_dir, "events").groupBy(week_key(F.col("ts")).alias("week")).agg(F.count("*").alias("n"), agg.percent(F.count_if(F.col("event_type") == "error"), F.count("*")).alias("pct_error"), F.min(F.to_date(F.date_trunc("week", "ts"))).alias("monday"))
    return weeks.where("n >= 10").orderBy(F.desc("pct_error"), "week").limit(1)


@query("""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, round(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'F') / count(*), 1) AS pct FROM orders GROUP BY 1)
SELECT month, pct, lag(pct) OVER (ORDER BY month) AS previous, round(pct - lag(pct) OVER (ORDER BY month), 1) AS difference FROM m""")
def month_over_month(spark, sf_dir):
    months = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(agg.percent(F.count_if(F.col("o_orderstatus") == "F"), F.count("*")).alias("pct"))
    before = F.lag("pct").over(Window.orderBy("month"))  # one row a month
    return months.select("month", "pct", before.alias("previous"), F.round(F.col("pct") - before, 1).alias("difference"))


@query("""WITH v AS (SELECT event_type,
       count(*) FILTER (ts >= {as_of} - INTERVAL 7 DAY) AS new, count(*) FILTER (ts < {as_of} - INTERVAL 7 DAY) AS previous
       FROM events WHERE ts >= {as_of} - INTERVAL 14 DAY AND ts < {as_of} GROUP BY event_type)
SELECT event_type, new, previous, new - previous AS difference,
       CASE WHEN previous = 0 AND new > 0 THEN 100.0::DOUBLE WHEN previous = 0 THEN 0.0::DOUBLE ELSE round((new - previous) * 100.0::DOUBLE / previous, 1) END AS pct_change FROM v""")
def period_variation(spark, sf_dir):
    return agg.variation(table(spark, sf_dir, "events"), "ts", as_of(), 7, ["event_type"])


@query("""SELECT count(*) FILTER (ts >= {as_of} - INTERVAL 1 HOUR AND ts <= {as_of}) AS last_hour,
       count(*) FILTER (ts >= {as_of} - INTERVAL 24 HOUR AND ts <= {as_of}) AS last_day,
       count(*) FILTER (ts >= {as_of} - INTERVAL 168 HOUR AND ts <= {as_of}) AS last_week FROM events""")
def recent_activity(spark, sf_dir):
    return agg.recent(table(spark, sf_dir, "events"), "ts", as_of(), {"last_hour": 1, "last_day": 24, "last_week": 168})


@query("""WITH {comments} SELECT source, count(*) FILTER (label = 'positif') AS positif, count(*) FILTER (label = 'neutre') AS neutre, count(*) FILTER (label = 'negatif') AS negatif FROM comments GROUP BY source""")
def crosstab_source_label(spark, sf_dir):
    return agg.crosstab(comments(spark, sf_dir), "source", "label", list(LABELS))


@query("""WITH {comments}, c AS (SELECT source, count(*) FILTER (label = 'positif') AS positif, count(*) FILTER (label = 'neutre') AS neutre, count(*) FILTER (label = 'negatif') AS negatif FROM comments GROUP BY source)
SELECT source, 'positif' AS label, positif AS n FROM c UNION ALL SELECT source, 'neutre', neutre FROM c UNION ALL SELECT source, 'negatif', negatif FROM c""")
def melt_source_label(spark, sf_dir):
    return agg.melt(crosstab_source_label(spark, sf_dir), ["source"], list(LABELS), "label", "n")


@query("""SELECT event_type, (CASE WHEN value < 0 THEN 0 WHEN value >= 500 THEN 21 ELSE floor(value / 25.0::DOUBLE) + 1 END)::BIGINT AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2""")
def hist_value_20bins(spark, sf_dir):
    return agg.histogram(table(spark, sf_dir, "events").where("value is not null"), "value", 0.0, 500.0, 20, ["event_type"])


@query("""SELECT CASE WHEN p >= 0 AND p < 50 THEN '0-50' WHEN p >= 50 AND p < 70 THEN '50-70' WHEN p >= 70 AND p < 85 THEN '70-85' WHEN p >= 85 AND p < 95 THEN '85-95' WHEN p >= 95 AND p < 100 THEN '95-100' END AS bucket, count(*) AS n
FROM (SELECT (value / 5) AS p FROM events) GROUP BY 1""")
def bucket_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("p", F.col("value") / 5)
    return e.groupBy(agg.buckets(F.col("p"), [0, 50, 70, 85, 95, 100]).alias("bucket")).agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, user_id, n, (row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id))::INT AS rank FROM c QUALIFY rank <= 5""")
def topk_per_label(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return agg.top_k(counts, ["event_type"], [F.desc("n"), F.col("user_id")], 5)


@query("SELECT user_id, count(*) AS frequence, max(ts) AS derniere FROM events GROUP BY user_id ORDER BY frequence DESC, user_id LIMIT 10")
def topn_frequency(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("frequence"), F.max("ts").alias("derniere")).orderBy(F.desc("frequence"), "user_id").limit(10)


@query("""SELECT conv_id, turn, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role, text) <= 3""")
def history_last_n(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return agg.top_k(c, ["conv_id"], [F.desc("turn"), F.col("role"), F.col("text")], 3).drop("rank").orderBy("conv_id", "turn")


@query("""SELECT doc_id, (CASE WHEN row_number() OVER (ORDER BY doc_id) <= floor((SELECT count(*) FROM documents) / 2) THEN 1 ELSE 2 END)::INT AS half FROM documents""")
def split_half(spark, sf_dir):
    return halves(table(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")])


@query("""SELECT event_type, user_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) <= 150""")
def stratified_sample(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return agg.top_k(e, ["event_type"], [F.md5(F.col("event_id").cast("string")), F.col("event_id")], 150).select("event_type", "user_id", "ts", "value")


@query("""SELECT event_id, event_type, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY md5('42' || CAST(event_id AS VARCHAR)), event_id) <= floor(0.2::DOUBLE * count(*) OVER (PARTITION BY event_type)) THEN 'test' ELSE 'train' END AS part FROM events""")
def train_test_split(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    ranked = group_rank(e, ["event_type"], [F.md5(F.concat(F.lit("42"), F.col("event_id").cast("string"))), F.col("event_id")])
    return ranked.select("event_id", "event_type", F.when(F.col("rank") <= F.floor(F.lit(0.2) * F.col("group_size")), "test").otherwise("train").alias("part"))


@query("""SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ROLLUP (event_type, user_id) HAVING user_id IS NULL""")
def label_rollup(spark, sf_dir):
    return table(spark, sf_dir, "events").rollup("event_type", "user_id").agg(F.count("*").alias("n")).where("user_id is null")
