"""Text cleaning, language, key words and flags over whole texts."""

from pyspark.sql import functions as F

from tessera.functions import automaton, dates, flags, normaliser, text
from tessera.plans.base import comments, query, table
from tessera.plans.re2 import SPACE, WORD, found_in, meets
from tessera.plans.re2 import sql as literal




def _t():
    return F.col("text")


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), 'http[^\s]+', '', 'g'), '@[\p{L}\p{N}\p{M}_]+', '', 'g'), '[^\p{L}\p{N}\p{M}_\s]', '', 'g'), '^\s+|\s+$', '', 'g') AS clean FROM documents""")
def clean_basic(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_basic(_t()).alias("clean"))


_EMOJI = "t"
for _k, _v in text.EMOJI_WORDS.items():
    _EMOJI = f"replace({_EMOJI}, {literal(_k)}, {literal(f' {_v} ')})"


def _squeezed(sql: str) -> str:
    return f"regexp_replace(regexp_replace({sql}, '[{SPACE}]+', ' ', 'g'), '^ | $', '', 'g')"


@query(rf"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), 'http[^{SPACE}]+|www\.[^{SPACE}]+|ftp\.[^{SPACE}]+', '', 'g'), '@[{WORD}]+', '', 'g'), '#[{WORD}]+', '', 'g') AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace({_EMOJI}, '{text.STREAM_EMOJI}', '', 'g'), '[إأآا]', 'ا', 'g'), '[ـ\x{{064B}}-\x{{065F}}]', '', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_extract_all(regexp_replace(t, '[^{WORD}{SPACE}\x{{0600}}-\x{{06FF}}]', ' ', 'g'), '(?s).') AS s FROM b),
d AS (SELECT doc_id, array_to_string(list_filter(s, lambda x, i: NOT coalesce(i > 1 AND x <> chr(10) AND s[i - 1] = x AND (
    (i > 3 AND s[i - 2] = x AND s[i - 3] = x) OR (i > 2 AND s[i - 2] = x AND s[i + 1] = x) OR (s[i + 1] = x AND s[i + 2] = x)), false)), '') AS t FROM c)
SELECT doc_id, lower({_squeezed("t")}) AS clean FROM d""")
def clean_stream(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_stream(_t()).alias("clean"))


_SAME = "|".join(f"{d}{{6,}}" for d in range(10))
_EDGE = f"(^|[^{WORD}])", f"($|[^{WORD}])"
_DIGITS = "text"
for _p in (r"\p{Nd}{10,}", r"0[5-7]\p{Nd}{8}", r"0[2-4]\p{Nd}{7,8}"):
    for _ in range(2):  # a sign between two numbers can stand for one of its sides only
        _DIGITS = rf"regexp_replace({_DIGITS}, '{_EDGE[0]}{_p}{_EDGE[1]}', '\1 \2', 'g')"
for _ in range(2):
    _DIGITS = rf"regexp_replace({_DIGITS}, '(^|[^\p{{Nd}}])(?:{_SAME})($|[^\p{{Nd}}])', '\1 \2', 'g')"


@query(f"SELECT doc_id, nullif(t, '') AS clean, coalesce(t <> '', false) AS kept FROM (SELECT doc_id, {_squeezed(_DIGITS)} AS t FROM documents)")
def strip_digits(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_numbers(_t()).alias("clean"), text.strip_numbers(_t()).isNotNull().alias("kept"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[\x{1F1E0}-\x{1F1FF}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F8FF}\x{1F900}-\x{1FBFF}\x{2600}-\x{27BF}\x{231A}\x{231B}\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{25AA}\x{25AB}\x{25B6}\x{25C0}\x{25FB}-\x{25FE}\x{2934}\x{2935}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}\x{3030}\x{303D}\x{3297}\x{3299}\x{FE0F}\x{200D}]+', '', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS clean FROM documents""")
def strip_emoji(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_emoji(_t()).alias("clean"))


@query(r"""SELECT count(*) FILTER (n > 0) AS docs, coalesce(sum(n), 0)::BIGINT AS emoji FROM (SELECT len(regexp_extract_all(text, '[\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{2600}-\x{27BF}\x{1F900}-\x{1FBFF}\x{2300}-\x{23FF}\x{2B50}-\x{2B55}\x{FE0F}\x{200D}][\x{1F3FB}-\x{1F3FF}]?(?:\x{200D}[^\x{200D}]+)*')) AS n FROM documents)""")
def count_emoji(spark, sf_dir):
    n = table(spark, sf_dir, "documents").select(text.count_emoji(_t()).alias("n"))
    return n.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("emoji"))


@query(r"""SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS tokens FROM documents""")
def tokenize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.tokens(_t()).alias("tokens"))


@query(r"""SELECT lang, count(*) AS docs, sum(n)::BIGINT AS tokens, max(n)::BIGINT AS longest, round(avg(n), 4) AS mean FROM (SELECT lang, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS n FROM documents) GROUP BY lang""")
def token_stats(spark, sf_dir):
    n = table(spark, sf_dir, "documents").select("lang", F.size(text.tokens(_t())).alias("n"))
    return n.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"), F.max("n").cast("long").alias("longest"), F.round(F.avg("n"), 4).alias("mean"))


@query(r"""WITH t AS (SELECT list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM documents), g AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM t WHERE len(w) >= 2)
SELECT gram, count(*) AS n FROM g GROUP BY gram HAVING count(*) > 1""")
def ngrams2(spark, sf_dir):
    grams = table(spark, sf_dir, "documents").select(F.explode(text.ngrams(text.tokens(F.lower(_t())), 2)).alias("gram"))
    return grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")


@query(r"""WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM documents),
c AS (SELECT *, len(list_filter(w, lambda x: list_contains(['le','la','les','un','une','des','je','tu','il','elle','nous','vous','ils','elles','et','ou','mais','donc','est','sont','ce','cet','cette','dans','pour','par','sur','avec','tres','bien','mal','trop','aujourd'], x))) AS fr,
  len(list_filter(w, lambda x: list_contains(['the','a','an','and','or','but','if','because','as','of','at','by','for','with','about','in','on','very','good','bad','this','that','these','those'], x))) AS en FROM w)
SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 'unknown' WHEN regexp_matches(text, '[\x{0600}-\x{06FF}]') THEN 'ar' WHEN fr > en THEN 'fr' WHEN en > fr THEN 'en' ELSE 'mixed' END AS language FROM c""")
def lang_keywords(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.language(_t()).alias("language"))


@query(r"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}\p{M}_]+')) AS word FROM (WITH {comments} SELECT text FROM comments WHERE label = 'negatif'))
WHERE regexp_full_match(word, '[a-zàâçéèêëîïôûùüÿ]{4,}') AND word NOT IN ('le','la','les','de','des','et','est','pas','très','trop') GROUP BY word ORDER BY n DESC, word LIMIT 10""")
def keyword_topk(spark, sf_dir):
    words = comments(spark, sf_dir).where("label = 'negatif'").select(F.explode(text.keywords(_t())).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(10)


@query("SELECT word, count(*) AS docs FROM (SELECT unnest(" + str(list(text.COMPLAINTS)) + ") AS word) w JOIN documents d ON contains(lower(d.text), lower(w.word)) GROUP BY word")
def term_presence(spark, sf_dir):
    """Texts that hold each word of the lexicon: one pass, and one conditional count a word."""
    counts = table(spark, sf_dir, "documents").select(F.lower(_t()).alias("t")).agg(*[F.count_if(F.contains("t", F.lit(w.lower()))).alias(f"w{i}") for i, w in enumerate(text.COMPLAINTS)])
    rows = F.explode(F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"w{i}").alias("docs")) for i, w in enumerate(text.COMPLAINTS)]))
    return counts.select(rows.alias("r")).select("r.word", "r.docs").where("docs > 0")


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%W') AS week FROM orders""")
def first_date_parse(spark, sf_dir):
    """Dates written in one of the list formats, read back from the first element."""
    o = table(spark, sf_dir, "orders").withColumn("list", F.concat(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"), F.lit(",24/11/2025 10:00")))
    ts = dates.first_of_list(F.col("list"))
    return o.select("o_orderkey", F.date_format(ts, "yyyy-MM-dd").alias("day"), dates.week_key(ts).alias("week"))


#: A small dictionary of each kind; larger ones are read from a file.
DICTIONARIES = {
    "unicode_arabic": dict(zip("أإآٱ", "اااا", strict=True)),
    "emojis": {"👍": "bravo", "❤️": "mliha bzaf"},
    "arabizi_upper": {"SVP": "s'il vous plaît"},
    "arabizi_words": {"bezzaf": "بزاف", "the": "le", "of the": "du"},
    "mixed_ar_fr_regex": {r"(\w+)tion\b": r"\1sion"},
    "network_variants": {"normalized_form": "شبكة", "latin": ["reseau", "réseau"], "arabic": ["الشبكة"]},
    "abbreviations": {"and": "et", "pb": "problème"},
    "telecom_tech": {"4g": "4G", "adsl": "ADSL", "wifi": "Wi-Fi"},
    "french_corrections_regex": {r"\bprobleme\b": "problème"},
}


@query()
def normalise_core(spark, sf_dir):
    """The core normaliser with a small dictionary of each kind."""
    return table(spark, sf_dir, "documents").select("doc_id", normaliser.normalise(_t(), DICTIONARIES).alias("n")).select("doc_id", F.col("n.reason").alias("reason"), F.col("n.text").alias("clean"))


def _flags(spark, sf_dir, flag):
    return table(spark, sf_dir, "documents").select("doc_id", flag(_t()).alias("f")).select("doc_id", "f.flag", "f.type")


def _cases(*rows: tuple[str, int, str | None], default: int = 0) -> str:
    """DuckDB SQL of a decision table: (condition, flag, type), the first that holds."""
    when = lambda k, last: "CASE " + " ".join(f"WHEN {r[0]} THEN {r[k] if k == 1 else 'NULL' if r[2] is None else literal(r[2])}" for r in rows) + f" ELSE {last} END"
    return f"SELECT doc_id, ({when(1, default)})::INT AS flag, ({when(2, 'NULL')})::VARCHAR AS type FROM documents"


@query(_cases((f"{meets('text', flags.MIXED_POSITIVE)} AND {meets('text', flags.MIXED_NEGATIVE)}", 1, "pos_neg")))
def flag_mixte(spark, sf_dir):
    return _flags(spark, sf_dir, flags.mixed)


@query(_cases((f"NOT {meets('text', flags.ENCOURAGEMENT)}", 0, None), (meets("text", flags.ENCOURAGEMENT_NEGATIVE, True), 0, "negatif"), (meets("text", flags.OFF_TOPIC), 0, "offtopic"), (meets("text", flags.PRODUCT), 1, "produit"), ("true", 1, "pur")))
def flag_encouragement(spark, sf_dir):
    return _flags(spark, sf_dir, flags.encouragement)


_COMPOSED = [(meets("lower(text)", (p,)), 1, "neg_pos" if found_in(p, flags.NEGATION_POSITIVE) else "neg_neg" if found_in(p, flags.NEGATION_NEGATIVE) else "neg_seule") for p in flags.NEGATION_COMPOSED]
_POSITIVE, _NEGATIVE = (meets("lower(text)", x) for x in (flags.NEGATION_POSITIVE, flags.NEGATION_NEGATIVE))


@query(_cases(*_COMPOSED, (f"NOT {meets('lower(text)', flags.NEGATION)}", 0, None), (f"{_POSITIVE} AND NOT {_NEGATIVE}", 1, "neg_pos"), (f"{_NEGATIVE} AND NOT {_POSITIVE}", 1, "neg_neg"), ("true", 1, "neg_seule")))
def flag_negation(spark, sf_dir):
    return _flags(spark, sf_dir, flags.negation)


@query(f"SELECT doc_id, ({meets('text', flags.SOCIAL)} AND NOT {meets('text', flags.SOCIAL_NEGATIVE)})::INT AS flag FROM documents")
def flag_social(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", flags.social(_t()).alias("flag"))


_CONTACT, _TROUBLE = meets("text", flags.CONTACT), meets("text", flags.FRUSTRATION, True)


@query(_cases((meets("text", flags.ANGER), 1, "neglex"), (f"{meets('text', flags.OFFICIAL_REPLY)} AND NOT {_TROUBLE}", -1, "at_response"), (f"{_CONTACT} AND {_TROUBLE}", 1, "prv"), (f"{_CONTACT} AND {meets('text', flags.POLITE)}", 0, None), (_CONTACT, -1, "prv_implicit")))
def flag_plainte(spark, sf_dir):
    return _flags(spark, sf_dir, flags.complaint)


_RESERVED = f"{meets('text', flags.SUGGESTION_POSITIVE)} AND {meets('text', flags.CONTRAST)}"
_BETTER, _BLAME = meets("text", flags.IMPROVE), meets("text", flags.SUGGESTION_NEGATIVE, True)


@query(_cases((f"{_RESERVED} AND {_BETTER} AND {_BLAME}", -1, "masked_neg"), (f"{_RESERVED} AND {_BETTER}", 1, "pur"), (f"{_RESERVED} AND NOT {_BLAME}", 1, "pos_adv")))
def flag_suggestion(spark, sf_dir):
    return _flags(spark, sf_dir, flags.suggestion)


@query("SELECT * FROM (VALUES " + ", ".join(f"({literal(k)}, (SELECT count(*) FROM documents WHERE {meets('text', v)}))" for k, v in flags.LEXICONS.items()) + ") x(lexicon, docs)")
def lexicon_counts(spark, sf_dir):
    """Texts that meet each lexicon: one pass, and one conditional count a lexicon."""
    counts = table(spark, sf_dir, "documents").agg(*[F.count_if(flags.meets(_t(), v)).alias(k) for k, v in flags.LEXICONS.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("lexicon"), F.col(k).alias("docs")) for k in flags.LEXICONS])).alias("r")).select("r.lexicon", "r.docs")


@query(f"""SELECT expression, count(*) AS n FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+'))) AS expression FROM documents) WHERE regexp_full_match(expression, {literal("|".join(flags.COMMON_WORDS))}) GROUP BY expression ORDER BY n DESC, expression LIMIT 20""")
def flag_topk(spark, sf_dir):
    """The words of the positive and negative lexicons that most texts hold."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(_t(), F.lit(""))), F.lit("([a-z0-9]+)")))
    found = F.filter(words, lambda w: w.rlike(f"^(?:{'|'.join(flags.COMMON_WORDS)})$"))
    return table(spark, sf_dir, "documents").select(F.explode(found).alias("expression")).groupBy("expression").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "expression").limit(20)


#: A dictionary of 625 entries by a rule: two consonants with vowels, which become one with the vowels around it.
SYLLABLES = {a + u + b + v: u + a + v for a in "rtlsn" for u in "aeiou" for b in "dmcpb" for v in "aeiou"}
_ORDERED = "text"
for _k, _v in SYLLABLES.items():
    _ORDERED = f"replace({_ORDERED}, '{_k}', '{_v}')"


@query(f"SELECT doc_id, {_ORDERED} AS translated FROM documents")
def translate_in_order(spark, sf_dir):
    """A whole dictionary's expressions replaced in its order, each in what the ones before it left."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return automaton.replaced_texts(d, "text", [automaton.Entry(k, v) for k, v in SYLLABLES.items()], "translated").drop("text")


@query(f"""WITH t AS (SELECT unnest([{', '.join(f"'{k}'" for k in SYLLABLES)}]) AS term), o AS (SELECT doc_id, term, (length(low) - length(replace(low, term, ''))) // 4 AS n FROM (SELECT doc_id, lower(coalesce(text, '')) AS low FROM documents) JOIN t ON contains(low, term))
SELECT term, count(*) AS documents, sum(n)::BIGINT AS occurrences FROM o GROUP BY term""")
def dictionary_terms(spark, sf_dir):
    """How many documents hold each term of a whole dictionary, and how often; no term overlaps itself."""
    found = automaton.terms_of(table(spark, sf_dir, "documents"), "doc_id", "text", [k for k in SYLLABLES])
    return found.groupBy("term").agg(F.count("*").alias("documents"), F.sum("n").alias("occurrences"))
