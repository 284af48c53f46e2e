"""Rows that every operator has to stand: nulls, empty and long texts, ties, repeats, clashing names."""

import duckdb
from pyspark.sql import types as T

#: Names that operators use for columns of their own.
CLASHING = "copies copy row r1 t1 root content host part salt size pivot bands at".split()
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("component_id", T.StringType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("key", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
PASSAGE = " ".join(f"{WORDS[i % 20]}{i * 7 % 11}" for i in range(70))
ODD = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "ONE two",
    "Ünï ÖDE İstanbul straße ﬁ",
    "a b c a b c a b c",
    "x  y\t\tz \n w ",
    "tab\tend\x0b\x0c\r\n next\x00nul\x85nel\xa0nbsp",
    "same line\nsame line\n\nother\nsame line",
    "<|endoftext|> <s> </s> [INST] ▁x a▁b",
    "don't we'll   I'm  \n  ok",
    "😀 emoji 👩‍👩‍👧 family 漢字かな العربية",
    PASSAGE,
    PASSAGE,
    PASSAGE.upper(),
    "intro words here " + PASSAGE + " outro words there",
    "#$%&|<>* " * 20,
    ("long " + PASSAGE + " ") * 200,
    "x" * 50_000,
]


def odd_rows():
    more = ("c", "n", "s", "k", *CLASHING)
    none = (None,) * len(more)
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None if t is None else len(t), *more) for i, t in enumerate(ODD)]
    lone = [(100, "alpha beta", None, "Z", 1), (None, "no id here at all", "en", "s1", 1), (None, PASSAGE, "en", "s1", 1), (100, "another text with the id of a text that differs", "en", "Z", 1), (None, None, None, None, None), (None, "no id, and its only copy has none", "en", "s2", 1), (None, "no id, and its only copy has none", "en", "s2", 2)]
    return rows + [rows[14], rows[0], *[(*r, *none) for r in lone]]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def table(sf, name):
    return duckdb.connect().execute(f"select * from '{sf}/{name}.parquet'").fetchall()


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
