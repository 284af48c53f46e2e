"""Annotation work, typed updates, text joins and the cleaning of the intent model, over the test tables."""

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import aggregates as agg
from tessera.operators import joins, similarity
from tessera.operators import labels as lab
from tessera.operators.work import saved
from tessera.plans.base import comments, query, table
from tessera.plans.quality import TWO, two
from tessera.plans.re2 import SPACE, WORD
from tessera.plans.re2 import sql as literal
from tessera.plans.similar import WORD_LINKS, WORD_THRESHOLD, greedy_sql, word_sets

def stripped(column: str) -> str:
    return rf"regexp_replace({column}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


@query(f"""WITH {TWO}, l AS (SELECT model AS label FROM two UNION SELECT human FROM two), s AS (SELECT label, (SELECT count(*) FROM two WHERE human = label) AS support, (SELECT count(*) FROM two WHERE model = label) AS g, (SELECT count(*) FROM two WHERE human = label AND model = label) AS r FROM l),
f AS (SELECT support, coalesce(2.0::DOUBLE * r / nullif(support + g, 0), 0) AS f1 FROM s)
SELECT round((SELECT count(*) FILTER (model = human)::DOUBLE / count(*) FROM two WHERE model IS NOT NULL AND human IS NOT NULL), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM f""")
def report_totals(spark, sf_dir):
    pairs = lab.confusion(two(spark, sf_dir), "model", "human")
    out = lab.report_totals(lab.class_report(pairs, "model", "human"), pairs, "model", "human")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(f"WITH {TWO} SELECT doc_id, model, human FROM two WHERE model <> human")
def disagreements(spark, sf_dir):
    return lab.disagreements(two(spark, sf_dir), "model", "human")


@query("""WITH v AS (SELECT l_orderkey AS k, CAST(l_suppkey AS VARCHAR) AS a, max(l_returnflag) AS v FROM lineitem GROUP BY 1, 2), p AS (SELECT k, list(a || '=' || v ORDER BY a) AS validations, arg_max(v, a) AS last FROM v GROUP BY k)
SELECT o_orderkey, coalesce(last, o_orderstatus) AS o_orderstatus, o_orderstatus AS label_original, coalesce(last <> o_orderstatus, false) AS corrige, validations FROM orders LEFT JOIN p ON k = o_orderkey""")
def import_validations(spark, sf_dir):
    """Each supplier of an order as an annotator who validates its status."""
    votes = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").cast("string").alias("a"), F.col("l_returnflag").alias("v"))
    out = lab.import_validations(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), votes, "o_orderkey", "a", "v", "o_orderstatus")
    entries = F.transform(F.map_entries("validations"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return out.withColumn("validations", entries)


@query("""WITH {comments}, r AS (SELECT doc_id, CASE WHEN label = 'neutre' AND quality = toxic THEN 'neutre+conflit' WHEN label = 'neutre' THEN 'neutre' WHEN quality = toxic THEN 'conflit' END AS cas FROM comments)
SELECT doc_id, cas FROM r WHERE cas IS NOT NULL""")
def review_extract(spark, sf_dir):
    """Neutral comments, and those whose two labels contradict each other."""
    return lab.review_extract(comments(spark, sf_dir), "label", F.coalesce(F.col("quality") == F.col("toxic"), F.lit(False))).select("doc_id", "cas")


@query(f"WITH {TWO} SELECT model, count(*) AS n, count(*) FILTER (model = human) AS \"right\", round(count(*) FILTER (model = human)::DOUBLE / count(*), 6) AS accuracy FROM two WHERE model IS NOT NULL GROUP BY ROLLUP (model)")
def judged_accuracy(spark, sf_dir):
    rows = two(spark, sf_dir).where("model is not null")
    return lab.judged_accuracy(rows, "model", F.col("model") == F.col("human")).withColumn("accuracy", F.round("accuracy", 6))


@query("SELECT user_id, arg_min(props, (ts, event_id)) FILTER (props IS NOT NULL AND lower(trim(props)) NOT IN ('', 'nan', '[]')) AS props FROM (SELECT user_id, ts, event_id, CASE WHEN event_id % 3 = 0 THEN 'nan' WHEN event_id % 3 = 1 THEN event_type END AS props FROM events) GROUP BY user_id")
def first_nonempty(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 3 == 0, "nan").when(F.col("event_id") % 3 == 1, F.col("event_type")).alias("props")
    return agg.first_nonempty(e.select("user_id", "ts", "event_id", value), ["user_id"], "props", ["ts", "event_id"])


@query("SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM documents) AS rows, true AS ok")
def sum_check(spark, sf_dir):
    """Copies counted a text add up to all documents."""
    d = table(spark, sf_dir, "documents")
    return agg.sum_check(d.groupBy(F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).agg(F.count("*").alias("nb_occurrences")), "nb_occurrences", d)


SCRUB = {"number": r"[0-9]{10,}", "address": r"http", "mention": r"@[A-Za-z]", "tag": r"#[A-Za-z]", "upper": r"[A-Z]{4,}"}


@query("SELECT * FROM (VALUES " + ", ".join(f"({literal(k)}, (SELECT count(*) FROM documents WHERE regexp_matches(text, {literal(p)})))" for k, p in SCRUB.items()) + ") x(pattern, n)")
def scrub_statistics(spark, sf_dir):
    return agg.pattern_counts(table(spark, sf_dir, "documents"), "text", SCRUB)


@query(f"""WITH s AS (SELECT {stripped('text')} AS t, max(source) AS source FROM documents WHERE doc_id % 2 = 0 AND text IS NOT NULL GROUP BY 1)
SELECT doc_id, coalesce(s.source, d.source) AS source FROM documents d LEFT JOIN s ON t = {stripped('d.text')}""")
def update_all_by_text(spark, sf_dir):
    """Every document takes the source of the even-numbered documents with its text."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return joins.update_all_by_text(d, d.where("doc_id % 2 = 0"), "text", ["source"]).select("doc_id", "source")


@query("""WITH f AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN try_cast(trim(' ' || round(c_acctbal) || ' ') AS DOUBLE) END AS bal, c_custkey % 3 <> 0 AS flag FROM customer WHERE c_custkey % 2 = 0)
SELECT c.c_custkey, coalesce(f.bal, c.c_acctbal) AS c_acctbal, coalesce(f.flag, false) AS flag FROM customer c LEFT JOIN f USING (c_custkey)""")
def update_typed(spark, sf_dir):
    """Text fields of every second customer, some of which are no numbers, parsed and applied by key."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"), F.lit(False).alias("flag"))
    fields = c.where("c_custkey % 2 = 0").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), F.round("c_acctbal").cast("string"), F.lit(" "))).otherwise("none").alias("c_acctbal"), F.when(F.col("c_custkey") % 3 == 0, " Non").otherwise("OUI").alias("flag"))
    return joins.update_typed(c, fields, "c_custkey", {"c_acctbal": "double", "flag": "bool"})[0]


@query(f"""SELECT a.doc_id AS doc_id_moi, b.doc_id AS doc_id_camarade, a.lang AS lang_moi, b.lang AS lang_camarade FROM documents a JOIN documents b ON {stripped('a.text')} = {stripped('b.text')} WHERE a.doc_id % 2 = 0 AND b.doc_id % 2 = 1""")
def both_annotators(spark, sf_dir):
    """Documents with even and odd ids as the sheets of two annotators."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return joins.both_annotators(d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1"), "text").drop("text")


@query(f"SELECT doc_id FROM documents a WHERE doc_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM documents b WHERE b.doc_id % 2 = 1 AND {stripped('a.text')} = {stripped('b.text')})")
def missing_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return joins.missing_text(d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1"), "text").select("doc_id")


@query("SELECT event_id, TRY_CAST(CASE WHEN event_id % 4 = 0 THEN event_type ELSE CAST(round(value) AS VARCHAR) END AS DOUBLE) AS number FROM events")
def to_double(spark, sf_dir):
    """Text that may be no number, as numbers."""
    raw = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(F.round("value").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", raw.try_cast("double").alias("number"))


@query("""WITH p AS (SELECT label, unnest(range(1, 65)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings WHERE vec_id % 3 <> 0), m AS (SELECT label, i, avg(x) AS x FROM p GROUP BY 1, 2)
SELECT label, list(round(x, 6) ORDER BY i) AS pooled FROM m GROUP BY label""")
def mean_pool(spark, sf_dir):
    e = agg.mean_pool(table(spark, sf_dir, "embeddings"), ["label"], "embedding", F.col("vec_id") % 3 != 0)
    return e.select("label", F.transform("pooled", lambda x: F.round(x, 6)).alias("pooled"))


@query(r"SELECT doc_id, regexp_replace(strip_accents(lower(text)), '[^\x00-\x7F]', '', 'g') AS folded FROM documents")
def ascii_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.ascii_fold(F.col("text")).alias("folded"))


_CODES = "[" + ", ".join(literal(c) for c in text.CONTRACTIONS) + "]"


@query(rf"""SELECT token, count(*) AS n FROM (SELECT unnest(list_transform(regexp_extract_all(coalesce(text, ''), '[{WORD}'']+|[^{WORD}{SPACE}]'), lambda x: CASE WHEN list_contains({_CODES}, lower(x)) THEN upper(replace(strip_accents(lower(x)), '''', '_')) ELSE x END)) AS token FROM
(SELECT 'J''ai dit : ' || coalesce(text, '') || ' c''est d''accord, aujourd''hui' AS text FROM documents)) GROUP BY token HAVING count(*) > 1""")
def contraction_tokens(spark, sf_dir):
    """Tokens of the documents, each put between contractions, that occur twice or more."""
    t = F.concat(F.lit("J'ai dit : "), F.coalesce("text", F.lit("")), F.lit(" c'est d'accord, aujourd'hui"))
    return table(spark, sf_dir, "documents").select(F.explode(text.contraction_tokens(t)).alias("token")).groupBy("token").agg(F.count("*").alias("n")).where("n > 1")


_CLEAN = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '{text.SCRUB_EMOJI}', ' ', 'g'), 'http[^{SPACE}]+|www\.[^{SPACE}]+', '', 'g'), '@[{WORD}]+', '', 'g'), '#[{WORD}]+', '', 'g'), '[^{WORD}{SPACE}\x{{0600}}-\x{{06FF}}]', ' ', 'g')"
_CLEAN = f"lower(regexp_replace(regexp_replace({_CLEAN}, '[{SPACE}]+', ' ', 'g'), '^ | $', '', 'g'))"


@query(f"SELECT doc_id, {_CLEAN} AS clean FROM documents")
def nettoyer(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.nettoyer(F.col("text")).alias("clean"))


_LISTS = "[" + ", ".join(map(literal, text.FRENCH)) + "]", "[" + ", ".join(map(literal, text.ENGLISH)) + "]"


@query(rf"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '[^{WORD}{SPACE}]', '', 'g'), '^[{SPACE}]+|[{SPACE}]+$', '', 'g') AS t FROM documents),
b AS (SELECT *, list_filter(regexp_split_to_array(lower(t), '\s+'), lambda x: x <> '') AS w FROM a), c AS (SELECT *, len(list_filter(w, lambda x: list_contains({_LISTS[0]}, x))) AS fr, len(list_filter(w, lambda x: list_contains({_LISTS[1]}, x))) AS en FROM b)
SELECT doc_id, CASE WHEN t = '' THEN 'inconnu' WHEN regexp_matches(t, '[2379]') THEN 'darija_latin' WHEN regexp_matches(t, '[\x{{0600}}-\x{{06FF}}]') THEN 'ar' WHEN fr > en THEN 'fr' ELSE 'darija_latin' END AS language FROM c""")
def darija_language(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.darija_language(F.col("text")).alias("language"))


@query(r"""SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS text_tokens, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))::INT AS text_count, list_filter(regexp_split_to_array(source, '\s+'), lambda x: x <> '') AS source_tokens, len(list_filter(regexp_split_to_array(source, '\s+'), lambda x: x <> ''))::INT AS source_count FROM documents""")
def token_columns(spark, sf_dir):
    return text.token_columns(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["text", "source"]).select("doc_id", "text_tokens", "text_count", "source_tokens", "source_count")


_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '')"
#: Pairs linked by word sets whose cosine, under weights fitted on the two alone, is 0.85 or more.
PRODUCTION = rf"""tf AS (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest({_WORDS}) AS x FROM documents) GROUP BY 1, 2),
pw AS (SELECT l.a, l.b, x.x, x.n FROM links l JOIN tf x ON x.doc_id = l.a WHERE l.a < l.b), qw AS (SELECT l.a, l.b, x.x, x.n FROM links l JOIN tf x ON x.doc_id = l.b WHERE l.a < l.b),
bw AS (SELECT coalesce(p.a, q.a) AS a, coalesce(p.b, q.b) AS b, coalesce(p.n, 0) AS n, coalesce(q.n, 0) AS m, CASE WHEN p.n IS NULL OR q.n IS NULL THEN 1 + ln(1.5) ELSE 1 END AS w FROM pw p FULL JOIN qw q ON p.a = q.a AND p.b = q.b AND p.x = q.x),
cs AS (SELECT a, b FROM bw GROUP BY a, b HAVING sum(n * w * m * w) / (sqrt(sum(n * w * n * w)) * sqrt(sum(m * w * m * w))) >= 0.85 - 1e-9), sure AS (SELECT a, b FROM cs UNION ALL SELECT b, a FROM cs)"""


@query(f"WITH RECURSIVE {WORD_LINKS}, {PRODUCTION}, {greedy_sql('g', 'sure')} SELECT a AS id, a NOT IN (SELECT id FROM g) AS kept FROM ids")
def production_fusion(spark, sf_dir):
    """Word sets first, then the pair's own cosine over words with repeats, then greedy removal of what both call copies."""
    d = table(spark, sf_dir, "documents")
    words = text.tokens(F.lower("text"))
    # texts of one word set may repeat words otherwise, so contents are those of equal sorted words
    members, distinct = similarity.contents(d, "doc_id", F.array_sort(words))
    sets = distinct.select("content", "copies", F.array_distinct("features").alias("features"))
    pairs = similarity.jaccard_links(sets, WORD_THRESHOLD)
    left, right = (distinct.select(F.col("content").alias(c), F.col("features").alias(f"f{c}")) for c in ("a", "b"))
    sure = pairs.join(left, "a").join(right, "b").where(similarity.pair_tfidf(F.col("fa"), F.col("fb")) >= 0.85 - 1e-9)
    return similarity.greedy_kept(members, saved(sure.select("a", "b", "score"), "production-links"))


@query(f"WITH {WORD_LINKS}, k AS (SELECT min(doc_id) AS a FROM documents GROUP BY text) SELECT count(*) AS pairs FROM links WHERE a < b AND a IN (SELECT a FROM k) AND b IN (SELECT a FROM k)")
def false_positive_scan(spark, sf_dir):
    """Pairs that are still similar among what exact removal keeps."""
    d = table(spark, sf_dir, "documents")
    first = d.groupBy(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    members, distinct = word_sets(d.join(first, "doc_id", "left_semi"))
    between = similarity.jaccard_links(distinct, WORD_THRESHOLD).join(distinct.select(F.col("content").alias("a"), F.col("copies").alias("na")), "a").join(distinct.select(F.col("content").alias("b"), F.col("copies").alias("nb")), "b")
    inside = distinct.agg(F.coalesce(F.sum(F.col("copies") * (F.col("copies") - 1) / 2), F.lit(0)).alias("inside"))
    return between.agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).alias("n")).crossJoin(inside).select((F.col("n") + F.col("inside")).cast("long").alias("pairs"))  # one row each


@query()
def char_ngram_links(spark, sf_dir):
    """Links by the cosine of character 3- to 5-grams of 0.995 and more, the truth that other methods are held against."""
    members, distinct = similarity.contents(table(spark, sf_dir, "documents"), "doc_id", F.array(F.lower(F.nullif("text", F.lit("")))))
    grams = distinct.select("content", "copies", text.character_ngrams(F.col("features")[0], 3, 5).alias("features"))
    return similarity.classes(members, saved(similarity.cosine_links(saved(similarity.tfidf(grams, sublinear=False), "weights"), 0.995), "ngram-links"))


@query("""SELECT event_type, count(*) AS n, max(ts) AS last FROM events WHERE contains(event_type, 'c') GROUP BY event_type""")
def progress_events(spark, sf_dir):
    """The events whose type holds a given text, and when each came last."""
    e = table(spark, sf_dir, "events").where(F.contains("event_type", F.lit("c")))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.max("ts").alias("last"))


@query("""WITH h AS (SELECT l_orderkey, l_quantity, l_extendedprice, l_discount FROM lineitem WHERE l_linenumber = 1), s AS (SELECT l_orderkey, l_quantity / 50 AS a, l_extendedprice / 50000 AS b, l_discount * 10 AS c FROM h),
e AS (SELECT l_orderkey, a, b, c, exp(a) + exp(b) + exp(c) AS t, greatest(a, b, c) AS m FROM s)
SELECT l_orderkey, CASE WHEN exp(m) / t < 0.4 THEN 'incompris' WHEN a = m THEN 'a' WHEN b = m THEN 'b' ELSE 'c' END AS intent FROM e""")
def decided_intents(spark, sf_dir):
    """The intent of the best score after softmax, or none where its share is under 0.40."""
    i = table(spark, sf_dir, "lineitem").where("l_linenumber = 1")
    scores = F.array((F.col("l_quantity") / 50).cast("double"), (F.col("l_extendedprice") / 50000).cast("double"), (F.col("l_discount") * 10).cast("double"))
    return i.select("l_orderkey", lab.decide(lab.softmax_top(scores, 1), ["a", "b", "c"]).alias("intent"))

