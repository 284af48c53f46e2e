"""Joins, set operations and exact duplicates."""

from pyspark.sql import functions as F

from tessera.operators import dedup, joins
from tessera.operators.work import saved
from tessera.plans.base import comments, query, table


@query("""SELECT d.doc_id, d.source, l.quality, c.item_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN benchmark c ON l.doc_id = c.item_id""")
def three_way_left(spark, sf_dir):
    d, n, b = (table(spark, sf_dir, t) for t in ("documents", "labels", "benchmark"))
    n = n.withColumnRenamed("doc_id", "label_id")
    return d.join(n, F.col("doc_id") == F.col("label_id"), "left").join(b.select("item_id"), F.col("label_id") == F.col("item_id"), "left").select("doc_id", "source", "quality", "item_id")


@query("""SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
def three_way_annotated(spark, sf_dir):
    o, c, n, r = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("o_orderkey", "c_name", "n_name", "r_name")


@query("""WITH l AS (SELECT doc_id, 'label-' || quality AS source FROM labels) SELECT d.doc_id, coalesce(l.source, d.source) AS source, d.lang FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id""")
def update_from_key(spark, sf_dir):
    s = table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("label-"), F.col("quality")).alias("source"))
    return joins.update_from(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), s, "doc_id", ["source"])


@query("""WITH f AS (SELECT text, source AS first_source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)
SELECT d.doc_id, f.first_source FROM documents d LEFT JOIN f ON d.text = f.text""")
def update_from_text_first(spark, sf_dir):
    """Each text takes the source of its first row; texts meet by hash, and only one row a text is looked up."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("h"))
    first = d.groupBy("h").agg(F.min_by("source", "doc_id").alias("first_source"))
    return d.join(first, "h", "left").select("doc_id", "first_source")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_missing(spark, sf_dir):
    return joins.missing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


@query("""SELECT CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'done' ELSE 'stuck' END AS state, count(*) AS n FROM documents GROUP BY 1""")
def semi_done_vs_stuck(spark, sf_dir):
    d, n = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    done = joins.present(d, n, "doc_id").agg(F.lit("done").alias("state"), F.count("*").alias("n"))
    return done.unionByName(joins.missing(d, n, "doc_id").agg(F.lit("stuck").alias("state"), F.count("*").alias("n"))).where("n > 0")


@query("""SELECT 'labels-documents' AS link, count(DISTINCT l.doc_id) AS n_keys, count(DISTINCT d.doc_id) AS n_linked, count(DISTINCT l.doc_id) - count(DISTINCT d.doc_id) AS n_orphans FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id
UNION ALL SELECT 'documents-labels', count(DISTINCT d.doc_id), count(DISTINCT l.doc_id), count(DISTINCT d.doc_id) - count(DISTINCT l.doc_id) FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
UNION ALL SELECT 'orders-customer', count(DISTINCT o.o_custkey), count(DISTINCT c.c_custkey), count(DISTINCT o.o_custkey) - count(DISTINCT c.c_custkey) FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def link_integrity(spark, sf_dir):
    d, n, o, c = (table(spark, sf_dir, t) for t in ("documents", "labels", "orders", "customer"))
    out = joins.link_counts(n, d, "doc_id", "labels-documents").unionByName(joins.link_counts(d, n, "doc_id", "documents-labels"))
    return out.unionByName(joins.link_counts(o.withColumnRenamed("o_custkey", "key"), c.withColumnRenamed("c_custkey", "key"), "key", "orders-customer"))


@query("""SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def upsert_latest(spark, sf_dir):
    last = F.max(F.struct("ts", "event_id", "value")).alias("m")
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(last).select("user_id", "event_type", "m.event_id", "m.value")


@query("""SELECT doc_id, coalesce(max(new), max(old)) AS label FROM (SELECT doc_id, 'doc-' || source AS old, NULL AS new FROM documents UNION ALL SELECT doc_id, NULL, 'label-' || quality FROM labels) GROUP BY doc_id""")
def upsert_rows(spark, sf_dir):
    old = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc-"), "source").alias("label"))
    new = table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("label-"), F.col("quality")).alias("label"))
    return joins.upsert(old, new, ["doc_id"])


@query("SELECT text, 'documents' AS origin FROM documents UNION ALL SELECT text, 'benchmark' FROM benchmark UNION ALL SELECT text, 'conversations' FROM conversations")
def union_all(spark, sf_dir):
    parts = [table(spark, sf_dir, t).select("text", F.lit(t).alias("origin")) for t in ("documents", "benchmark", "conversations")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def intersect_values(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def except_values(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").subtract(table(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT DISTINCT source, lang FROM documents")
def distinct_values(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("source", "lang").distinct()


@query("SELECT md5(text) AS hash, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE text <> '' GROUP BY 1 HAVING count(*) > 1")
def md5_dups(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text <> ''").groupBy(F.md5("text").alias("hash")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


GROUPS_SQL = r"""WITH {comments}, k AS (SELECT *, lower(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')) AS k FROM comments),
per AS (SELECT k, label, count(*) AS n, min(doc_id) AS f FROM k WHERE label IS NOT NULL GROUP BY 1, 2),
best AS (SELECT k, label, n, sum(n) OVER (PARTITION BY k) AS labelled, count(*) OVER (PARTITION BY k) AS n_labels FROM per QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, f) = 1),
g AS (SELECT k, min(doc_id) AS id, count(*) AS n, count(DISTINCT source) AS n_sources FROM k GROUP BY k)
SELECT g.id, g.n, g.n_sources, coalesce(n_labels, 0) AS n_labels,
       CASE WHEN b.n >= 0.6 * labelled THEN label WHEN labelled IS NOT NULL THEN 'CONFLIT_A_REVOIR' END AS label_final, coalesce(NOT b.n >= 0.6 * labelled, false) AS conflict
FROM g LEFT JOIN best b ON g.k = b.k"""


@query(GROUPS_SQL)
def group_by_text(spark, sf_dir):
    return dedup.group_by_text(comments(spark, sf_dir), dedup.compare_key(F.col("text")), "doc_id", "label", "source")


@query(GROUPS_SQL.replace("SELECT g.id, g.n, g.n_sources", "SELECT label_final, count(*) AS n_groups, sum(n)::BIGINT AS n_rows FROM (SELECT g.id, g.n, g.n_sources") + ") GROUP BY label_final")
def majority_label(spark, sf_dir):
    return group_by_text(spark, sf_dir).groupBy("label_final").agg(F.count("*").alias("n_groups"), F.sum("n").alias("n_rows"))


PREFIX_SQL = r"substr(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '(?i)(En voir plus|See more|أكثر)', '', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), 1, 60)"


@query(f"""WITH g AS (SELECT {PREFIX_SQL} AS k, count(*) AS n, count(DISTINCT source) AS n_sources, count(DISTINCT n_chars) AS n_days, count(DISTINCT lang) AS n_moderators FROM documents GROUP BY 1 HAVING count(*) > 1)
SELECT *, n_sources > 1 AS t1_sources, n_days > 1 AS t2_days, n_moderators > 1 AS t3_moderators, n_sources <= 1 AND n_days <= 1 AND n_moderators <= 1 AS t4_perfect FROM g""")
def prefix60_typology(spark, sf_dir):
    return dedup.typology(table(spark, sf_dir, "documents"), dedup.prefix_key(F.col("text")), "source", "n_chars", "lang")


def _day_rows(spark, sf_dir):
    """Events as rows with a text (type and whole value), day, source (user) and moderator (hour)."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.concat_ws(" ", "event_type", F.floor(F.col("value") / 10).cast("string")).alias("text"), F.to_date("ts").alias("day"), (F.col("user_id") % 7).alias("source"), F.hour("ts").alias("moderator"))


DAYS_SQL = "r AS (SELECT event_id, event_type || ' ' || floor(value / 10)::BIGINT AS text, CAST(ts AS DATE) AS day, user_id % 7 AS source, hour(ts) AS moderator FROM events)"


@query(f"WITH {DAYS_SQL}, g AS (SELECT text, day, source, moderator, count(*) AS n FROM r GROUP BY ALL HAVING count(*) > 1) SELECT event_id, n FROM r JOIN g USING (text, day, source, moderator)")
def rule_r1(spark, sf_dir):
    return dedup.rows_of_groups(_day_rows(spark, sf_dir), ["text", "day", "source", "moderator"], F.col("n") > 1, F.count("*").alias("n")).select("event_id", "n")


@query(f"WITH {DAYS_SQL}, g AS (SELECT text, day, count(DISTINCT source) AS n FROM r GROUP BY ALL HAVING count(DISTINCT source) > 1) SELECT event_id, n FROM r JOIN g USING (text, day)")
def rule_r2(spark, sf_dir):
    return dedup.rows_of_groups(_day_rows(spark, sf_dir), ["text", "day"], F.col("n") > 1, F.countDistinct("source").alias("n")).select("event_id", "n")


@query(f"WITH {DAYS_SQL}, g AS (SELECT text, count(DISTINCT day) AS n FROM r GROUP BY ALL HAVING count(DISTINCT day) > 1) SELECT event_id, n FROM r JOIN g USING (text)")
def rule_r3(spark, sf_dir):
    return dedup.rows_of_groups(_day_rows(spark, sf_dir), ["text"], F.col("n") > 1, F.countDistinct("day").alias("n")).select("event_id", "n")


@query(f"WITH {DAYS_SQL}, g AS (SELECT text, day, count(DISTINCT moderator) AS n FROM r GROUP BY ALL HAVING count(DISTINCT moderator) > 1) SELECT event_id, n FROM r JOIN g USING (text, day)")
def rule_r4(spark, sf_dir):
    return dedup.rows_of_groups(_day_rows(spark, sf_dir), ["text", "day"], F.col("n") > 1, F.countDistinct("moderator").alias("n")).select("event_id", "n")


@query(f"""WITH k AS (SELECT doc_id, {PREFIX_SQL} AS k, length(text) AS size FROM documents), g AS (SELECT k, max(size) AS longest FROM k GROUP BY k) SELECT doc_id, size::INT AS size, longest::INT AS longest FROM k JOIN g USING (k) WHERE size < longest""")
def rule_r5(spark, sf_dir):
    """Truncated versions: shorter than the longest text with the same beginning, which two hashes stand for."""
    key = dedup.prefix_key(F.col("text"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2"), F.length("text").alias("size"))
    d = saved(d, "prefix-keys")
    # groups with one size have nothing to say, so what joins is the few groups that have several
    groups = d.groupBy("k1", "k2").agg(F.max("size").alias("longest"), F.min("size").alias("least")).where("least < longest").drop("least")
    return d.join(groups, ["k1", "k2"]).where("size < longest").select("doc_id", "size", "longest")


@query(f"WITH {DAYS_SQL} SELECT event_id, text, day FROM r QUALIFY row_number() OVER (PARTITION BY text, day, source, moderator ORDER BY event_id) = 1")
def keep_policy(spark, sf_dir):
    r = _day_rows(spark, sf_dir)
    return r.groupBy("text", "day", "source", "moderator").agg(F.min("event_id").alias("event_id")).select("event_id", "text", "day")


@query("SELECT doc_id, count(*) OVER (PARTITION BY text) AS copies FROM documents QUALIFY copies > 1")
def all_duplicates_flagged(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    return dedup.rows_of_groups(d, ["h"], F.col("copies") > 1, F.count("*").alias("copies")).select("doc_id", "copies")


@query("""SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def keep_last_by_id(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.struct("event_id", "event_type")).alias("m")).select("user_id", "m.event_id", "m.event_type")


@query("""WITH g AS (SELECT text, count(*) AS n FROM documents GROUP BY text) SELECT count(*) FILTER (n > 1) AS groups, coalesce(sum(n - 1), 0)::BIGINT AS extra, sum(n)::BIGINT AS total, round(100.0::DOUBLE * sum(n - 1) / sum(n), 1) AS rate FROM g""")
def dup_extra_count(spark, sf_dir):
    g = table(spark, sf_dir, "documents").groupBy(F.md5("text").alias("h")).agg(F.count("*").alias("n"))
    return g.agg(F.count_if(F.col("n") > 1).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"), F.sum("n").alias("total"), F.round(F.lit(100.0) * F.sum(F.col("n") - 1) / F.sum("n"), 1).alias("rate"))


@query("""SELECT text, list_sort(list(DISTINCT source)) AS sources, min(doc_id) AS id FROM documents GROUP BY text HAVING count(*) > 1""")
def collected_sources(spark, sf_dir):
    """The sources of each repeated text; sources are few, ids of a group are not collected."""
    d = table(spark, sf_dir, "documents").withColumn("h", F.md5("text"))
    g = d.groupBy("h").agg(F.sort_array(F.collect_set("source")).alias("sources"), F.min("doc_id").alias("id"), F.count("*").alias("n")).where("n > 1")
    return g.join(d.select(F.col("doc_id").alias("id"), "text"), "id").select("text", "sources", "id")


@query("""SELECT c_custkey, c_name, count(*) OVER (PARTITION BY c_nationkey) AS n_same FROM customer""")
def count_over(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return dedup.rows_of_groups(c, ["c_nationkey"], F.lit(True), F.count("*").alias("n_same")).select("c_custkey", "c_name", "n_same")
