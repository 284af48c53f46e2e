"""Label quality and statistics over the test tables: quality is one annotator's label, toxic (turned) another's."""

from pyspark.sql import functions as F

from tessera.operators import aggregates as agg
from tessera.operators import labels as lab
from tessera.plans.base import AS_OF, comments, query, table  # noqa: F401


def two(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("model"), (1 - F.col("toxic")).cast("string").alias("human"))


TWO = "two AS (SELECT doc_id, CAST(quality AS VARCHAR) AS model, CAST(1 - toxic AS VARCHAR) AS human FROM labels)"
KAPPA = f"""WITH {TWO}, p AS (SELECT model, human, count(*) AS n FROM two WHERE model IS NOT NULL AND human IS NOT NULL GROUP BY 1, 2),
t AS (SELECT sum(n)::BIGINT AS n, sum(n) FILTER (model = human)::DOUBLE / sum(n) AS po FROM p),
e AS (SELECT coalesce(sum(a.n::DOUBLE * b.n), 0) AS c FROM (SELECT model AS l, sum(n) AS n FROM p GROUP BY 1) a JOIN (SELECT human AS l, sum(n) AS n FROM p GROUP BY 1) b USING (l))
SELECT n, round(po, 6) AS agreement, round(c / (n::DOUBLE * n), 6) AS expected, round((po - c / (n::DOUBLE * n)) / (1 - c / (n::DOUBLE * n)), 6) AS kappa FROM t, e"""


@query(KAPPA)
def kappa(spark, sf_dir):
    k = lab.kappa(lab.confusion(two(spark, sf_dir), "model", "human"), "model", "human")
    return k.select("n", *[F.round(c, 6).alias(c) for c in ("agreement", "expected", "kappa")])


@query(f"WITH {TWO} SELECT model, human, count(*) AS n FROM two WHERE model IS NOT NULL AND human IS NOT NULL GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return lab.confusion(two(spark, sf_dir), "model", "human")


@query(f"""WITH {TWO}, l AS (SELECT model AS label FROM two UNION SELECT human FROM two), s AS (SELECT label, (SELECT count(*) FROM two WHERE human = label) AS support, (SELECT count(*) FROM two WHERE model = label) AS g, (SELECT count(*) FROM two WHERE human = label AND model = label) AS r FROM l),
m AS (SELECT label, support, CASE WHEN g = 0 THEN 0.0 ELSE r::DOUBLE / g END AS p, CASE WHEN support = 0 THEN 0.0 ELSE r::DOUBLE / support END AS q FROM s)
SELECT label, support, round(p, 6) AS precision, round(q, 6) AS recall, round(CASE WHEN p + q = 0 THEN 0.0 ELSE 2 * p * q / (p + q) END, 6) AS f1 FROM m""")
def class_report(spark, sf_dir):
    r = lab.class_report(lab.confusion(two(spark, sf_dir), "model", "human"), "model", "human")
    return r.select("label", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"WITH {TWO} SELECT model, human, count(*) AS n FROM two WHERE model <> human GROUP BY 1, 2")
def error_types(spark, sf_dir):
    return lab.confusion(two(spark, sf_dir), "model", "human").where("model <> human").orderBy(F.desc("n"), "model", "human")


@query("""WITH v AS (SELECT l_orderkey AS item, l_suppkey AS annotator, l_returnflag AS label FROM lineitem), c AS (SELECT item, count(DISTINCT annotator) AS n_validators, min(label) = max(label) AS accord, min(label) AS m FROM v GROUP BY item HAVING count(DISTINCT annotator) >= 2)
SELECT item, n_validators, accord, CASE WHEN accord THEN m ELSE 'desaccord' END AS label_final FROM c""")
def consensus(spark, sf_dir):
    votes = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("item"), F.col("l_suppkey").alias("annotator"), F.col("l_returnflag").alias("label"))
    return lab.consensus(votes, "item", "annotator", "label")


CORRECT = "CASE WHEN toxic = 1 THEN 'supprimer' WHEN quality = 0 THEN 'neutre' END"


def _corrections(spark, sf_dir):
    n = table(spark, sf_dir, "labels")
    return n.select("doc_id", F.when(F.col("toxic") == 1, "supprimer").when(F.col("quality") == 0, "neutre").alias("lang")).where("lang is not null")


@query(f"""WITH c AS (SELECT doc_id, {CORRECT} AS l FROM labels WHERE toxic = 1 OR quality = 0) SELECT d.doc_id, coalesce(c.l, d.lang) AS lang, c.doc_id IS NOT NULL AS corrected FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id WHERE c.l IS NULL OR c.l <> 'supprimer'""")
def apply_corrections(spark, sf_dir):
    return lab.apply_corrections(table(spark, sf_dir, "documents").select("doc_id", "lang"), _corrections(spark, sf_dir), "doc_id", "lang")


@query(f"""WITH c AS (SELECT doc_id, {CORRECT} AS l FROM labels WHERE toxic = 1 OR quality = 0), f AS (SELECT c.l, d.doc_id FROM c LEFT JOIN documents d ON d.doc_id = c.doc_id)
SELECT count(*) FILTER (doc_id IS NOT NULL AND l <> 'supprimer') AS updated, count(*) FILTER (doc_id IS NOT NULL AND l = 'supprimer') AS deleted, count(*) FILTER (doc_id IS NULL) AS not_found FROM f""")
def correction_counts(spark, sf_dir):
    return lab.correction_counts(table(spark, sf_dir, "documents"), _corrections(spark, sf_dir), "doc_id", "lang")


@query("""SELECT event_id, event_type, value, 'DOUTEUX' AS kind FROM events WHERE value < 5
UNION ALL SELECT * FROM (SELECT event_id, event_type, value, 'SAMPLE' AS kind FROM events WHERE value >= 5 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR))) <= 150)
UNION ALL SELECT event_id, event_type, value, 'CONF_INVALIDE' FROM events WHERE value IS NULL""")
def uncertain_sample(spark, sf_dir):
    """All rows of low confidence, a stratified sample of the others, and those without one."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    sure = agg.top_k(e.where("value >= 5"), ["event_type"], [F.md5(F.col("event_id").cast("string"))], 150).drop("rank")
    tag = lambda df, k: df.withColumn("kind", F.lit(k))
    return tag(e.where("value < 5"), "DOUTEUX").unionByName(tag(sure, "SAMPLE")).unionByName(tag(e.where("value is null"), "CONF_INVALIDE"))


@query("""WITH {comments} SELECT count(*) AS total, count(label) AS labelled, count(*) - count(label) AS pending, round(100.0::DOUBLE * count(label) / count(*), 1) AS pct FROM comments""")
def progress(spark, sf_dir):
    return comments(spark, sf_dir).agg(F.count("*").alias("total"), F.count("label").alias("labelled"), F.count_if(F.col("label").isNull()).alias("pending"), agg.percent(F.count("label"), F.count("*")).alias("pct"))


@query("""SELECT d.doc_id, 'pending' AS labeled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL ORDER BY d.doc_id LIMIT 300""")
def batch_claim(spark, sf_dir):
    """The next 300 rows without a label, in order of their id."""
    free = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    return free.orderBy("doc_id").limit(300).select("doc_id", F.lit("pending").alias("labeled"))


@query("""WITH c AS (SELECT c_mktsegment AS r, n_name AS k, count(*)::DOUBLE AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), t AS (SELECT sum(n) AS t, count(DISTINCT r) AS nr, count(DISTINCT k) AS nk FROM c),
g AS (SELECT a.r, b.k, a.n * b.n / t AS e FROM (SELECT r, sum(n) AS n FROM c GROUP BY r) a, (SELECT k, sum(n) AS n FROM c GROUP BY k) b, t)
SELECT max(t)::BIGINT AS n, round(sum((coalesce(c.n, 0) - e) * (coalesce(c.n, 0) - e) / e), 4) AS chi2, max((nr - 1) * (nk - 1))::BIGINT AS dof FROM g LEFT JOIN c ON g.r = c.r AND g.k = c.k, t""")
def chi2_stat(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("c_mktsegment", "n_name").agg(F.count("*").alias("n"))
    return lab.chi_square(c, "c_mktsegment", "n_name").select("n", F.round("chi2", 4).alias("chi2"), "dof")


@query("""WITH s AS (SELECT count(value) FILTER (event_type = 'click') AS n_a, count(value) FILTER (event_type = 'view') AS n_b, avg(value) FILTER (event_type = 'click') AS mean_a, avg(value) FILTER (event_type = 'view') AS mean_b, var_samp(value) FILTER (event_type = 'click') AS va, var_samp(value) FILTER (event_type = 'view') AS vb FROM events)
SELECT n_a, n_b, round(mean_a, 4) AS mean_a, round(mean_b, 4) AS mean_b, round((mean_a - mean_b) / sqrt(((n_a - 1) * va + (n_b - 1) * vb) / (n_a + n_b - 2) * (1.0::DOUBLE / n_a + 1.0::DOUBLE / n_b)), 4) AS t, n_a + n_b - 2 AS dof FROM s""")
def ttest_stat(spark, sf_dir):
    t = lab.t_test(table(spark, sf_dir, "events"), "value", "event_type", "click", "view")
    return t.select("n_a", "n_b", F.round("mean_a", 4).alias("mean_a"), F.round("mean_b", 4).alias("mean_b"), F.round("t", 4).alias("t"), "dof")


@query("SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS mean, round(median(c_acctbal), 4) AS median FROM customer GROUP BY 1")
def describe_by_class(spark, sf_dir):
    d = agg.distribution(table(spark, sf_dir, "customer"), ["c_mktsegment"], "c_acctbal")
    return d.select("c_mktsegment", "n", F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"))
