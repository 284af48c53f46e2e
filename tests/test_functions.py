"""Text, date and flag functions against small tables of inputs and results."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import dates, flags, normaliser, text
from tessera.operators import labels as lab
from tessera.operators import similarity as sim


def values(spark, rows, f):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c string")
    return [r[1] for r in sorted(df.select("i", f(F.col("c")).alias("v")).collect(), key=lambda r: r[0])]


def test_strip_numbers(spark):
    cases = [("ريزوووووووو 0000000000", True), ("تخفيض 9999 دينار جزائري", False), ("10000 دج و مقوي", False), ("منذ سنة 2009", False), ("20250927181446511421 du 27 09", True), ("0664514558 رقم الهاتف", True), ("027955127 ولا عيطولي", True), ("60 ميغا بسرعة", False), ("0000 مكالمة", False), ("الاتصالات بالهاتف الثابت 000000 مكالمة", True)]
    got = values(spark, [c for c, _ in cases], text.strip_numbers)
    assert [g != c for (c, _), g in zip(cases, got)] == [changed for _, changed in cases]
    assert values(spark, ["0664514558", None], text.strip_numbers) == [None, None]


def test_clean_stream(spark):
    cases = {"Hello @you http://x.y/z #tag !!": "hello", "مرحبـــا أهلاً إسلام": "مرحبا اهلا اسلام", "sooooo gooood": "so god", "👍 ok 😀": "bravo ok", "": "", None: "", "A-B_c": "a b_c", "❤️x": "mliha bzaf x"}
    assert values(spark, list(cases), text.clean_stream) == list(cases.values())


def test_language_and_tokens(spark):
    assert values(spark, ["le chat est bon", "the cat is good", "xyz", "سلام the", "", None], text.language) == ["fr", "en", "mixed", "ar", "unknown", "unknown"]
    assert values(spark, ["a  b\tc", "", None], text.tokens) == [["a", "b", "c"], [], []]
    assert values(spark, ["a b c", "a"], lambda c: text.ngrams(text.tokens(c), 2)) == [["a b", "b c"], []]
    assert values(spark, ["wach rak 3likom", "bonjour", "سلام"], text.dialect) == ["dz", "fr", "ar"]
    assert values(spark, ["3andi 7aja 9dima"], text.phonemes) == ["ainandi haja qdima"]


def test_translate_long_texts(spark):
    """Runs of pairs, and the work of a text: words are put into a list once each."""
    table = {"a a": "2", "b": "1", "a b": "3"}
    assert values(spark, ["a a a", "a a a a b b", "b a b a", "a"], lambda c: text.translate_tokens(c, table)) == ["2 a", "2 2 1 1", "1 3 a", "a"]
    df = spark.range(1).select(F.lit("x").alias("t"))
    for d in (table, {"b": "1"}):
        assert "array_append" not in df.select(text.translate_tokens(F.col("t"), d))._jdf.queryExecution().optimizedPlan().toString()
        assert "array_append" not in str(text.translate_tokens(F.col("t"), d))


def test_a_text_is_cleaned_once_for_its_language(spark):
    df = spark.range(1).select(F.lit("x").alias("t")).select(text.normalise_by_language(F.col("t"), {"b": "1"}, {"c": "2"}))
    assert df._jdf.queryExecution().analyzed().toString().count(r"[^\w\s],") < 10  # each of two uses was written out for each of the others


def test_translate(spark):
    table = {"ma kanch": "il n'y a pas", "ma": "ne", "bezzaf": "beaucoup", "kanch rien": "!"}

    def plain(t):
        words, out, i = t.split(), [], 0
        while i < len(words):
            pair = " ".join(words[i : i + 2])
            step = 2 if i + 1 < len(words) and pair in table else 1
            out.append(table.get(pair if step == 2 else words[i], words[i]))
            i += step
        return " ".join(out)

    rows = ["ma kanch rien bezzaf", "ma ma kanch", "bezzaf", "", "x ma", "kanch rien ma kanch"]
    assert values(spark, rows, lambda c: text.translate_tokens(c, table)) == [plain(r) for r in rows]


def plain_core(t, d):
    """The core normaliser's passes by Python's patterns, one after another."""
    words = lambda x, flags: [(rf"\b{re.escape(k)}\b", v.replace("\\", r"\\"), flags) for k, v in sorted(x.items(), key=lambda kv: -len(kv[0]))]
    t = t.strip().translate(str.maketrans(d["unicode_arabic"]))
    for k, v in sorted(d["emojis"].items(), key=lambda kv: -len(kv[0])):
        t = t.replace(k, f" {v} ")
    net = d["network_variants"]
    steps = words(d["arabizi_upper"], 0) + words(d["arabizi_words"], re.I) + [(p, r, re.I) for p, r in d["mixed_ar_fr_regex"].items()]
    steps += [(r"\b(?:" + "|".join(map(re.escape, net["latin"])) + r")\b|(?:" + "|".join(map(re.escape, net["arabic"])) + ")", net["normalized_form"], re.I)]
    steps += words(d["abbreviations"], re.I) + words(d["telecom_tech"], re.I) + [(p, r, re.I) for p, r in d["french_corrections_regex"].items()]
    for p, r, flags in steps:
        t = re.sub(p, r, t, flags=flags)
    t = re.sub(r"#\w+", "", t.lower())
    t = re.sub(r"([a-zA-Z\u0621-\u064A])(\d)", r"\1 \2", t)
    t = re.sub(r"(\d)([a-zA-Z\u0621-\u064A])", r"\1 \2", t)
    return re.sub(r"\s{2,}", " ", t).strip()


def test_core_normaliser(spark, sf):
    """Refusals by their rules, and all passes in order: a phrase before its words, case where it counts, lower case after spelling."""
    from tessera.plans.texts import DICTIONARIES as d

    texts = ["Wach 4G  #tag أهلا bezzaf", "of the road and the rest", "svp SVP pb 👍❤️", "Notre réseau et الشبكة : probleme !", "la nation 4g12 c'est l'adsl", "x" * 3 + " $1 \\1"]
    got = values(spark, texts, lambda c: normaliser.normalise(c, d))
    assert [(r.text, r.reason) for r in got] == [(plain_core(t, d), None) for t in texts]
    assert got[0].text.startswith("wach 4 g") and "du road et le rest" in got[1].text and got[2].text.startswith("svp s'il vous plaît problème bravo mliha bzaf")
    refused = [(None, "vide"), ("  ", "vide"), ("2500 DA", "prix_detecte"), ("055 01 23 45", "telephone_detecte"), ("4g wifi", "technique_seul"), ("bcdfghjk", "charabia_clavier"), ("ههههههه", "charabia_arabe"), ("le prix est de 2500 DA", None)]
    assert [(r.text is None, r.reason) for r in values(spark, [t for t, _ in refused], lambda c: normaliser.normalise(c, d))] == [(r is not None, r) for _, r in refused]
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("text", normaliser.normalise(F.col("text"), d).alias("n")).collect()
    kept = [r for r in rows if r.n.reason is None]
    assert len(kept) > 100 and all(r.n.text == plain_core(r.text, d) for r in kept)
    assert normaliser.normalise(F.lit("x"), {}) is not None


def test_a_large_dictionary_is_a_small_plan(spark):
    d = {"arabizi_words": {f"mot{k}": f"word{k}" for k in range(600)}}
    df = spark.createDataFrame([("mot7 et MOT599 motif",)], "t string").select(normaliser.normalise(F.col("t"), d).alias("n"))
    assert df.first().n.text == "word 7 et word 599 motif"


def test_evidence(spark):
    assert values(spark, ["bien mais nul", "rien"], flags.mixed_evidence) == ["bien ↔ nul", ""]
    assert values(spark, ["machi bien"], flags.negation_evidence) == ["machi ⊗ bien"]
    assert values(spark, ["inbox svp, 3 jours"], flags.complaint_evidence) == ["inbox | 3 jours"]


def test_languages_of_the_intent_model(spark):
    assert values(spark, ["", "! ?", "wach 3likom", "السلام عليكم", "le service est dans la ville", "hello"], text.darija_language) == ["inconnu", "inconnu", "darija_latin", "ar", "fr", "darija_latin"]
    got = values(spark, ["Wach 7al @x http://y.z #t 😊!", "السلام صديقي", "le prix"], lambda c: text.normalise_by_language(c, {"wach hal": "comment", "hal": "état"}, {"السلام": "bonjour"}))
    assert got == ["comment", "bonjour صديقي", "le prix"]


def test_kappa_levels(spark):
    df = spark.createDataFrame([(k,) for k in (-0.1, 0.0, 0.3, 0.5, 0.7, 0.9)], "k double")
    assert [r[0] for r in df.select(lab.kappa_level(F.col("k"))).collect()] == ["mauvais", "mauvais", "faible", "modere", "bon", "excellent"]


def test_emoji(spark):
    assert values(spark, ["a 😀 b", "👍🏽", "none"], text.strip_emoji) == ["a b", "", "none"]
    assert values(spark, ["😀😀 x ⭐", "x", None], text.count_emoji) == [3, 0, 0]


def test_dates(spark):
    rows = ["25/11/2025 08:06", "25/11/2025", "2025-11-25T08:06:00", "2025-11-25 08:06:00", "2025-11-25", "", None, "garbage text"]
    assert values(spark, rows, dates.day) == ["2025-11-25"] * 5 + ["inconnu", "inconnu", "garbage te"]
    import datetime as dt

    days = [dt.date(2019, 1, 1) + dt.timedelta(days=11 * k) for k in range(240)]
    got = values(spark, [d.isoformat() for d in days], lambda c: dates.week_key(c.cast("timestamp")))
    assert got == [d.strftime("%Y-%W") for d in days]


def flag(spark, f, rows):
    return [tuple(x) for x in values(spark, rows, f)]


def test_mixed(spark):
    cases = {"connexion mliha ms coupure": (1, "pos_neg"), "c'est bien mais coupure tout le temps": (1, "pos_neg"), "الانترنت تمام بس مقطوعة أحيانا": (1, "pos_neg"), "super application ne fonctionne pas depuis hier": (1, "pos_neg"), "connexion correcte mais prix trop cher": (1, "pos_neg"), "connexion mliha bezzaf": (0, None), "كارثة هذه الخدمة": (0, None), "bon courage à toute l'équipe": (0, None)}
    assert flag(spark, flags.mixed, list(cases)) == list(cases.values())


def test_encouragement(spark):
    cases = {"Bon courage les gars !": (1, "pur"), "Bravo et bonne continuation": (1, "pur"), "Félicitations": (1, "pur"), "ربي يوفقكم": (1, "pur"), "bravo bonne continuation le service internet": (1, "produit"), "bon courage mais le service est nul": (0, "negatif"), "عام جديد وما زالنا مع خيوط النحاس adsl": (0, "negatif"), "nothing": (0, None)}
    assert flag(spark, flags.encouragement, list(cases)) == list(cases.values())


def test_negation(spark):
    cases = {"machi mliha du tout": (1, "neg_pos"), "الخدمة ليست جيدة": (1, "neg_pos"), "machi zwin": (1, "neg_pos"), "machi nul en fait": (1, "neg_neg"), "machi khaybe": (1, "neg_neg"), "مكانش الانترنت": (1, "neg_seule"), "مبعد ساهل": (1, "neg_seule"), "connexion mliha bezzaf": (0, None), "merci beaucoup": (0, None)}
    assert flag(spark, flags.negation, list(cases)) == list(cases.values())


def test_social(spark):
    cases = {"ربي يوفقكم": 1, "barak allah fik": 1, "bon courage": 1, "mabrouk": 1, "بالتوفيق والسداد": 1, "تعبتونا والله": 0, "المودم مكانش": 0, "قدمت عدت شكاوي جزاكم الله خيرا": 0, "ست اشهر يستنى انترنت هل يعقل": 0}
    assert values(spark, list(cases), flags.social) == list(cases.values())


def test_complaint(spark):
    cases = {"ردو في الخاص le service est nul": (1, "prv"), "repondiw prv 3 jours sans réponse": (1, "prv"), "هرمنا من هاد الخدمه": (1, "neglex"), "مافيا هذا الاتصالات": (1, "neglex"), "لقد تم التواصل معك في الخاص": (-1, "at_response"), "ردو عليا": (-1, "prv_implicit"), "bravo مبروك ردو عليا في الخاص": (0, None), "connexion mliha bezzaf": (0, None)}
    assert flag(spark, flags.complaint, list(cases)) == list(cases.values())
    assert flag(spark, lambda c: flags.complaint(c, implicit=1), ["ردو عليا"]) == [(1, "prv_implicit")]


def test_suggestion(spark):
    cases = {"connexion mliha ms tehseno fiha": (1, "pur"), "مليح بصح يلزم تحسن": (1, "pur"), "bon début mais il reste des améliorations à faire": (1, "pur"), "mliha ms bezzaf": (1, "pos_adv"), "bon par contre un peu lent": (1, "pos_adv"), "connexion mliha ms coupure tzidou corrigi": (-1, "masked_neg"), "bon courage": (0, None), "مليح": (0, None)}
    assert flag(spark, flags.suggestion, list(cases)) == list(cases.values())


def test_scores(spark):
    df = spark.createDataFrame([("abc", "abd", "a b", "b c")], "a string, b string, x string, y string")
    r = df.select(sim.edit_similarity(F.col("a"), F.col("b")), sim.jaccard(sim.character_set(F.col("a")), sim.character_set(F.col("b"))), sim.pair_tfidf(text.tokens(F.col("x")), text.tokens(F.col("y")))).first()
    assert r[0] == pytest.approx(2 / 3) and r[1] == 0.5
    idf = 1 + __import__("math").log(1.5)
    assert r[2] == pytest.approx(1 / (1 + idf**2))


def test_p_values():
    assert lab.chi_square_p(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert lab.chi_square_p(18.307, 10) == pytest.approx(0.05, abs=1e-5)
    assert lab.t_p(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert lab.t_p(0.0, 10) == pytest.approx(1.0)


def test_softmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0, 3.0],)], "s array<double>")
    top = df.select(lab.softmax_top(F.col("s"), 3)).first()[0]
    assert [x["index"] for x in top] == [1, 3, 2] and sum(x["p"] for x in top) < 1


def test_patterns_compile():
    for name in dir(flags):
        if isinstance(getattr(flags, name), tuple):
            for p in getattr(flags, name):
                re.compile(p)
