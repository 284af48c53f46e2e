"""Queries of single functions: language and translation, dates in many forms, values, and what judges say."""

from pyspark.sql import functions as F

from tessera.functions import dates, text, values
from tessera.operators import labels as lab
from tessera.plans import annotations, texts  # noqa: F401 -- their SQL is used here
from tessera.plans.base import ORACLE_SQL, query, table
from tessera.plans.quality import KAPPA, two
from tessera.plans.re2 import WORD
from tessera.streaming.comments import normalised


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


_SOUNDS = "text"
for _k, _v in text.PHONEMES.items():
    _SOUNDS = f"replace({_SOUNDS}, '{_k}', '{_v}')"


@query(f"SELECT doc_id, {_SOUNDS} AS spelled FROM documents")
def phonemes(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.phonemes(F.col("text")).alias("spelled"))


_AR = r"regexp_matches({0}, '[\x{{0600}}-\x{{06FF}}]')"


@query(rf"""SELECT doc_id, CASE WHEN {_AR.format('text')} THEN 'ar' ELSE 'fr' END AS script,
    CASE WHEN {_AR.format('text')} THEN 'ar' WHEN regexp_matches(lower(text), '(^|[^{WORD}])[23789]($|[^{WORD}])|3likom|wach|chnou|bezzaf|machi|kayn|ndir|sahbi|slm|kifak') THEN 'dz' ELSE 'fr' END AS dialect FROM documents""")
def script_and_dialect(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.script(F.col("text")).alias("script"), text.dialect(F.col("text")).alias("dialect"))


#: A dictionary of single words of the given texts' languages.
WORDS = {"der": "the", "die": "the", "und": "and", "of": "de", "la": "the", "le": "the", "que": "that", "in": "dans", "une": "a"}
_WORDS = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in WORDS.items()) + "}"


def _translated(c):
    return rf"array_to_string(list_transform(list_filter(regexp_split_to_array(coalesce({c}, ''), '\s+'), lambda x: x <> ''), lambda x: coalesce({_WORDS}[x], x)), ' ')"


@query(f"SELECT doc_id, {_translated('text')} AS translated FROM documents")
def translate_words(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.translate_tokens(F.col("text"), WORDS).alias("translated"))


@query(f"""WITH cleaned AS ({ORACLE_SQL["nettoyer"]}), documents AS (SELECT doc_id, clean AS text FROM cleaned), kind AS ({ORACLE_SQL["darija_language"]})
SELECT doc_id, CASE WHEN language = 'darija_latin' THEN {_translated(_SOUNDS)} ELSE text END AS translated FROM documents JOIN kind USING (doc_id)""")
def translate_by_language(spark, sf_dir):
    """Cleaned texts, those in dialect by sounds and then by words; none of the given texts is Arabic."""
    return _docs(spark, sf_dir).select("doc_id", text.normalise_by_language(F.col("text"), WORDS, {"شكرا": "merci"}).alias("translated"))


_FORMS = ("dd/MM/yyyy HH:mm", "dd/MM/yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


@query("""SELECT event_id, CASE event_id % 8 WHEN 5 THEN 'inconnu' WHEN 6 THEN 'hier ' || left(event_type, 5) WHEN 7 THEN strftime(ts, '%d.%m.%Y') ELSE strftime(ts, '%Y-%m-%d') END AS day,
CASE event_id % 8 WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN date_trunc('day', ts)::TIMESTAMP WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('second', ts) WHEN 4 THEN date_trunc('day', ts)::TIMESTAMP END AS moment FROM events""")
def dates_of_many_forms(spark, sf_dir):
    """Times written in five forms, as nothing, as words, and in a form that is not read: the day that they name, and the moment or null."""
    k = F.col("event_id") % 8
    written = F.when(k == 5, F.lit(" ")).when(k == 6, F.concat(F.lit("hier "), F.col("event_type"))).when(k == 7, F.date_format("ts", "dd.MM.yyyy HH:mm"))
    for n, form in enumerate(_FORMS):
        written = written.when(k == n, F.date_format("ts", form))
    e = table(spark, sf_dir, "events").select("event_id", written.alias("w"))
    return e.select("event_id", dates.day(F.col("w")).alias("day"), dates.parse(F.col("w")).alias("moment"))


@query(f"SELECT doc_id, clean AS texte_normalise, md5(clean) AS hash_texte FROM ({ORACLE_SQL['clean_stream']}) WHERE clean <> ''")
def messages_normalised(spark, sf_dir):
    return normalised(_docs(spark, sf_dir).select("doc_id", "text"), "text").drop("text")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN -1 ELSE CAST(props->>'$.k' AS BIGINT) END AS k, '{"k":' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE props->>'$.k' END || ',"type":"' || event_type || '"}' AS written FROM events""")
def json_values(spark, sf_dir):
    """A number out of JSON texts, of which every fifth is cut and gets the default; and values as JSON."""
    e = table(spark, sf_dir, "events").withColumn("p", F.when(F.col("event_id") % 5 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props")))
    k = values.load_json(F.col("p"), "struct<k: bigint>")["k"]
    return e.select("event_id", F.coalesce(k, F.lit(-1)).alias("k"), values.dump_json(F.struct(k.alias("k"), F.col("event_type").alias("type"))).alias("written"))


@query("SELECT l_orderkey AS item, count(DISTINCT flag) AS labels FROM (SELECT l_orderkey, l_suppkey, max(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def labels_of_maps(spark, sf_dir):
    """Validations as a map from annotator to label, and how many labels it holds."""
    given = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.max("l_returnflag").alias("flag"))
    maps = given.groupBy(F.col("l_orderkey").alias("item")).agg(F.map_from_entries(F.collect_list(F.struct("l_suppkey", "flag"))).alias("validations"))
    return maps.select("item", F.size(F.array_distinct(F.map_values("validations"))).cast("long").alias("labels"))


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('7-' || CAST(doc_id AS VARCHAR)), doc_id) AS place FROM documents")
def shuffled_rows(spark, sf_dir):
    return values.shuffled(_docs(spark, sf_dir).select("doc_id"), "doc_id", 7)


@query("SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR quality NOT IN (1)")
def not_in_or_missing(spark, sf_dir):
    """Rows whose quality is not 1, those without one included."""
    joined = _docs(spark, sf_dir).select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.where(values.not_in(F.col("quality"), 1)).select("doc_id", "quality", "toxic")


@query("""SELECT doc_id, list_filter([CASE WHEN quality IS NULL THEN 'label' END, CASE WHEN n_chars > 5000 THEN 'length' END, CASE WHEN source NOT IN ('src0', 'src1', 'src2', 'src3', 'src4') OR source IS NULL THEN 'source' END], lambda x: x IS NOT NULL) AS errors, quality IS NOT NULL AND n_chars <= 5000 AND coalesce(source IN ('src0', 'src1', 'src2', 'src3', 'src4'), false) AS valid
FROM documents LEFT JOIN labels USING (doc_id)""")
def domain_check(spark, sf_dir):
    """Rows with values in their domains apart from the others, and what is wrong with these."""
    d = _docs(spark, sf_dir).select("doc_id", "n_chars", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    good, bad = values.split_valid(d, label=F.col("quality").isin(0, 1), length=F.col("n_chars") <= 5000, source=F.col("source").isin(*[f"src{k}" for k in range(5)]))
    return good.select("doc_id", F.expr("cast(array() as array<string>)").alias("errors"), F.lit(True).alias("valid")).unionByName(bad.select("doc_id", "errors", F.lit(False).alias("valid")))


_LEVELS = " ".join(f"WHEN kappa >= {low} THEN '{name}'" for low, name in reversed(lab.ANNOTATOR_LEVELS))


@query(f"SELECT n, round(100 * agreement, 2) AS agreement_pct, kappa, CASE {_LEVELS} ELSE '{lab.ANNOTATOR_BELOW}' END AS level FROM ({KAPPA})")
def annotator_kappa(spark, sf_dir):
    """The agreement of two annotators in their own words."""
    k = lab.kappa(lab.confusion(two(spark, sf_dir), "model", "human"), "model", "human").select("n", F.round("agreement", 6).alias("agreement"), F.round("kappa", 6).alias("kappa"))
    return k.select("n", F.round(100 * F.col("agreement"), 2).alias("agreement_pct"), "kappa", lab.kappa_level(F.col("kappa"), lab.ANNOTATOR_LEVELS, lab.ANNOTATOR_BELOW).alias("level"))


@query("""WITH j AS (SELECT l_shipmode_judge AS judge, v, s, t FROM (SELECT 'judge' || CAST(l_linenumber % 4 AS VARCHAR) AS l_shipmode_judge, CASE WHEN l_quantity < 49 THEN l_returnflag END AS v, l_discount * 100 + l_tax * 10 AS s, l_linestatus AS t FROM lineitem))
SELECT judge, count(*) AS n, count(*) FILTER (v IS NULL) AS failures, round(count(*) FILTER (v IS NOT NULL AND (v = 'N') = (t = 'O'))::DOUBLE / count(*) FILTER (v IS NOT NULL AND t IS NOT NULL), 6) AS agreement, round(avg(s), 6) AS mean_latency, round(quantile_cont(s, 0.5), 6) AS p50, round(quantile_cont(s, 0.95), 6) AS p95 FROM j GROUP BY judge""")
def judges_compared(spark, sf_dir):
    """Four judges by their verdicts, failures and latency; lines of orders stand in for judged comments."""
    li = table(spark, sf_dir, "lineitem").withColumn("judge", F.concat(F.lit("judge"), (F.col("l_linenumber") % 4).cast("string")))
    verdict = F.when(F.col("l_quantity") < 49, F.when(F.col("l_returnflag") == "N", "O").otherwise("F"))
    found = lab.compare_judges(li, "judge", verdict, F.col("l_discount") * 100 + F.col("l_tax") * 10, F.col("l_linestatus"))
    return found.select("judge", "n", "failures", *[F.round(c, 6).alias(c) for c in ("agreement", "mean_latency", "p50", "p95")])
