"""Ordered replacements and terms of whole dictionaries, against one entry after another."""

import json
import random

from pyspark.sql import functions as F

from tessera.functions import automaton as au
from tessera.functions import normaliser
from tessera.sources import readers


def test_order_is_kept():
    """An entry that an earlier one makes possible applies; one that would have come before does not; case and limits of words."""
    E = au.Entry
    rules = [E("ab", "c"), E("cc", "d"), E("x", "ab"), E("ad", "Wi fi"), E("wi", "WI", words=True, case=False), E(r"(\w)\1", r"\1", regex=True), E("straße", "s", case=False), E("", "never"), E("(", "[", regex=True), E("(", r"\1")]
    good = [r for r in rules if r.pattern and not (r.regex and r.pattern == "(")]
    for t in ("", "abab", "xab", "aabc", "aabab wi widow WI", "aab cc", "STRASSE STRAßE", "((", "İI ıi", "no match"):
        assert au.Replacements(rules).apply(t) == au.in_order(t, good)
    assert au.Replacements([]).apply("t") == "t"
    kelvin = [E("k", "q", case=False), E("s", "z", words=True, case=False)]
    assert au.Replacements(kelvin).apply("K ſ K") == au.in_order("K ſ K", kelvin) == "q z q"


def test_random_dictionaries():
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abAB é") for _ in range(rng.randint(1, n)))
    for _ in range(300):
        rules = [au.Entry(word(3), word(3), words=rng.random() < 0.4, case=rng.random() < 0.5) for _ in range(rng.randint(1, 12))]
        text = word(25)
        assert au.Replacements(rules).apply(text) == au.in_order(text, rules)


def dictionary(rng):
    """More entries than any of the real ones together, of every kind."""
    word = lambda k: "".join(rng.choice("bcdfglmnrst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) + str(k % 7) * (k % 5 == 0)
    words = lambda n: {word(k): word(k + 1) for k in range(n)}
    return {
        "unicode_arabic": {"أ": "ا", "ى": "ي", "ﻻ": "لا"}, "emojis": {chr(0x1F600 + k): f"emo{k}" for k in range(80)}, "arabizi_upper": {k.upper(): v.upper() for k, v in words(60).items()}, "arabizi_words": words(220),
        "mixed_ar_fr_regex": {rf"\b{w}(\w)\1\b": rf"{v} \1" for w, v in words(40).items()}, "network_variants": {"latin": ["mobilis", "mobil is"], "arabic": ["موبيليس"], "normalized_form": "MOBILIS"},
        "abbreviations": words(150), "telecom_tech": {"adsl": "ADSL", "4g": "4G"} | words(150), "french_corrections_regex": {r"\bconn?ex+ion\b": "connexion"},
    }


def test_whole_dictionaries_from_a_file(spark, tmp_path):
    rng = random.Random(6)
    made = dictionary(rng)
    (tmp_path / "d.json").write_text(json.dumps(made, ensure_ascii=False), encoding="utf-8")
    read = readers.dictionaries(spark, str(tmp_path / "d.json"))
    entries = normaliser.sequence(read)
    assert read == made and len(entries) > 600
    known = [k for n in ("arabizi_words", "abbreviations", "arabizi_upper", "telecom_tech") for k in made[n]]
    texts = [None, "", "0551234567", "500 da", "4g"] + [" ".join(rng.choice([rng.choice(known), rng.choice(known).title(), "le", "😀", "mobil is", "connnexxion", "أمى", "#tag", "x4g"]) for _ in range(rng.randint(3, 40))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r.id: (r.reason, r.clean) for r in normaliser.normalised(df, "t", read).collect()}
    plain = spark.createDataFrame([(k, au.in_order((t or "").strip(), entries)) for k, t in enumerate(texts)], "id long, t string")
    want = {r.id: r.c for r in plain.select("id", normaliser.text.core_form(F.col("t")).alias("c")).collect()}
    assert {got[k][0] for k in range(5)} == {"vide", "telephone_detecte", "prix_detecte", "technique_seul"}
    assert all(got[k] == (None, want[k]) for k in range(5, len(texts)) if got[k][0] is None) and sum(r is None for r, _ in got.values()) > 50


def test_terms(spark):
    df = spark.createDataFrame([(1, "Aba aBAba"), (2, None), (3, "zz")], "id long, t string")
    got = {(r.id, r.term): r.n for r in au.terms_of(df, "id", "t", ["aba", "BA", "ABA", "", "q"]).collect()}
    assert got == {(1, "aba"): 3, (1, "BA"): 3} and au.terms_of(df, "id", "t", []).count() == 0
