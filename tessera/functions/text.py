"""Cleaning, tokens and language of short multilingual comments, as column expressions.

Patterns carry ``(?U)`` where word, space or boundary have to be Unicode's, and
``(?iU)`` to ignore case beyond ASCII.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Emoji and what they are replaced by.
EMOJI_WORDS = {
    "😊": "mliha", "😍": "mziana bzaf", "👍": "bravo", "❤️": "mliha bzaf", "😡": "ghezeb", "😠": "ghezeb", "👎": "mazyench", "😢": "mhazoun",
    "😭": "mhazoun bzaf", "🔥": "top", "✅": "mlih", "❌": "machi mlih", "⭐": "mziana", "💯": "top bzaf", "🙏": "chokran",
}
# Emoji ranges of the light normaliser, of the emoji scrub, and of the emoji count.
STREAM_EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}]+"
SCRUB_EMOJI = r"[\x{1F1E0}-\x{1F1FF}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F8FF}\x{1F900}-\x{1FBFF}\x{2600}-\x{27BF}\x{231A}\x{231B}\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{25AA}\x{25AB}\x{25B6}\x{25C0}\x{25FB}-\x{25FE}\x{2934}\x{2935}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}\x{3030}\x{303D}\x{3297}\x{3299}\x{FE0F}\x{200D}]+"
COUNT_EMOJI = r"[\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{2600}-\x{27BF}\x{1F900}-\x{1FBFF}\x{2300}-\x{23FF}\x{2B50}-\x{2B55}\x{FE0F}\x{200D}][\x{1F3FB}-\x{1F3FF}]?(?:\x{200D}[^\x{200D}]+)*"
# Phone and claim numbers, and repeated digits.
NUMBERS = (r"(?U)\b\d{10,}\b", r"(?U)\b0[5-7]\d{8}\b", r"(?U)\b0[2-4]\d{7,8}\b", r"(?U)(?<!\d)(\d)\1{5,}(?!\d)")
# Key words of the language test.
FRENCH = (
    "le", "la", "les", "un", "une", "des", "je", "tu", "il", "elle", "nous", "vous", "ils", "elles", "et", "ou", "mais", "donc", "est", "sont", "ce", "cet", "cette", "dans", "pour", "par", "sur", "avec", "tres", "bien", "mal", "trop", "aujourd",
)
ENGLISH = (
    "the", "a", "an", "and", "or", "but", "if", "because", "as", "of", "at", "by", "for", "with", "about", "in", "on", "very", "good", "bad", "this", "that", "these", "those",
)
# Words that key words leave out, and the lexicon of complaints.
STOP_WORDS = ("le", "la", "les", "de", "des", "et", "est", "pas", "très", "trop")
COMPLAINTS = (
    "5ayeb", "خايب", "problème", "مشكل", "nul", "connexion", "réseau", "service", "lent", "بطيء", "mauvais", "cher", "غالي", "facture",
    "fibre", "فيبر", "installation", "تركيب", "retard", "تأخير", "client", "support", "réponse", "رد", "coupé", "مقطوع",
)
# Digits that stand for sounds.
PHONEMES = {"2": "a", "3": "ain", "7": "h", "9": "q"}

ARABIC = r"[\x{0600}-\x{06FF}]"


def _sub(c: Column, *steps: tuple[str, str]) -> Column:
    return reduce(lambda x, s: F.regexp_replace(x, s[0], s[1]), steps, c)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def clean_basic(c: Column) -> Column:
    """Lower case without web addresses, mentions and punctuation; null becomes empty."""
    return strip(_sub(F.lower(F.coalesce(c, F.lit(""))), (r"(?U)http\S+", ""), (r"(?U)@\w+", ""), (r"(?U)[^\w\s]", "")))


def clean_stream(c: Column) -> Column:
    """The light normaliser of the live path: addresses, mentions, tags, emoji, Arabic letter forms, punctuation, repeats."""
    t = F.coalesce(c, F.lit(""))
    t = F.when(t.rlike(r"http|www\.|ftp\.|[@#]"), _sub(t, (r"(?U)http\S+|www\.\S+|ftp\.\S+", ""), (r"(?U)@\w+", ""), (r"(?U)#\w+", ""))).otherwise(t)

    def plain(t: Column) -> Column:
        """Emoji are looked for one by one only where there is one."""
        words = reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(f" {e[1]} ")), EMOJI_WORDS.items(), t)
        return F.when(t.rlike(f"[{''.join(sorted({k[0] for k in EMOJI_WORDS}))}]|{STREAM_EMOJI}"), F.regexp_replace(words, STREAM_EMOJI, "")).otherwise(t)

    def letters(t: Column) -> Column:
        return F.when(t.rlike(ARABIC), _sub(t, ("[إأآا]", "ا"), (r"[ـ\x{064B}-\x{065F}]", ""))).otherwise(t)

    def signs(t: Column) -> Column:
        return F.lower(squeeze(_sub(t, (r"(?U)[^\w\s\x{0600}-\x{06FF}]", " "), (r"(?d)(.)\1{3,}", "$1"))))

    return let(let(let(t, plain), letters), signs)


def strip_numbers(c: Column) -> Column:
    """Without phone numbers, claim numbers and six or more of one digit; null where nothing is left."""
    return F.nullif(squeeze(reduce(lambda x, p: F.regexp_replace(x, p, " "), NUMBERS, c)), F.lit(""))


def strip_emoji(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, SCRUB_EMOJI, ""))


def count_emoji(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(COUNT_EMOJI)), F.lit(0))


def clean_words(c: Column) -> Column:
    """The preparation of similarity: lower case, words and single spaces only."""
    return squeeze(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[^\w\s]", " "))


def tokens(c: Column) -> Column:
    """Words between white space; null and empty texts have none."""
    return F.filter(F.split(strip(F.coalesce(c, F.lit(""))), r"(?U)\s+"), lambda x: x != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once a row however often ``body`` uses it; a column that a lambda reads would else be computed for each element."""
    return F.transform(F.array(value), body)[0]


def ngrams(words: Column, n: int) -> Column:
    """Runs of ``n`` words joined by a space; fewer words have none."""

    def runs(w: Column) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.expr("cast(array() as array<int>)"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))

    return let(words, runs)


def character_ngrams(c: Column, least: int, most: int) -> Column:
    """All runs of ``least`` to ``most`` characters, repeats included."""

    def runs(ch: Column) -> Column:
        of = lambda n: F.when(F.size(ch) >= n, F.transform(F.sequence(F.lit(0), F.size(ch) - n), lambda i: F.concat(*[F.get(ch, i + k) for k in range(n)]))).otherwise(F.expr("cast(array() as array<string>)"))
        return F.concat(*[of(n) for n in range(least, most + 1)])

    return let(F.filter(F.split(c, ""), lambda x: x != ""), runs)


def language(c: Column) -> Column:
    """``ar`` by script, else ``fr`` or ``en`` by the larger number of key words, else ``mixed``; ``unknown`` for no text."""
    words = F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda x: x != "")
    count = lambda keys: F.size(F.filter(words, lambda w: w.isin(*keys)))
    fr, en = count(FRENCH), count(ENGLISH)
    return F.when(c.isNull() | (c == ""), "unknown").when(c.rlike(ARABIC), "ar").when(fr > en, "fr").when(en > fr, "en").otherwise("mixed")


def script(c: Column) -> Column:
    return F.when(F.coalesce(c.rlike(ARABIC), F.lit(False)), "ar").otherwise("fr")


def dialect(c: Column, fallback: str = "fr") -> Column:
    """``ar`` by script, ``dz`` by single digits or dialect words, else the fallback."""
    words = r"(?U)\b[23789]\b|3likom|wach|chnou|bezzaf|machi|kayn|ndir|sahbi|slm|kifak"
    return F.when(c.rlike(ARABIC), "ar").when(F.lower(c).rlike(words), "dz").otherwise(fallback)


def phonemes(c: Column) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), PHONEMES.items(), c)


def translate_tokens(c: Column, dictionary: dict[str, str]) -> Column:
    """Pairs of words, else single words, replaced by the dictionary from left to right; a replaced pair is passed over."""
    if not dictionary:
        return F.array_join(tokens(c), " ")
    table = F.create_map(*[F.lit(x) for kv in dictionary.items() for x in kv])
    alone = lambda w: F.coalesce(F.try_element_at(table, w), w)
    if not any(" " in k for k in dictionary):
        return F.array_join(F.transform(tokens(c), alone), " ")
    pair = lambda words, i: F.try_element_at(table, F.concat(words[i], F.lit(" "), F.get(words, i + 1)))

    def replaced(words: Column) -> Column:
        """Where a pair is replaced, the one that begins in it is not: in a run of places that begin a pair every second one is left out."""
        begins = F.array_join(F.transform(words, lambda w, i: F.when(pair(words, i).isNotNull(), "1").otherwise("0")), "")
        return let(F.split(F.replace(begins, F.lit("11"), F.lit("10")), ""), lambda taken: emitted(words, taken))

    def emitted(words: Column, taken: Column) -> Column:
        after = lambda i: (i > 0) & (F.get(taken, i - 1) == "1")
        return F.array_join(F.transform(words, lambda w, i: F.when(F.get(taken, i) == "1", pair(words, i)).when(~after(i), alone(w))), " ")  # nulls are left out

    return let(tokens(c), replaced)


def keywords(c: Column) -> Column:
    """Words of four letters or more, lower-cased, without stop words."""
    return F.filter(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"(?U)\b([a-zàâçéèêëîïôûùüÿ]{4,})\b")), lambda w: ~w.isin(*STOP_WORDS))


def strip_code_fence(c: Column) -> Column:
    """A reply without the marks of a fenced block around it."""
    return strip(_sub(strip(c), (r"^```[a-zA-Z]*\s*\n?", ""), (r"\n?```$", "")))


# What the core normaliser rejects.
PRICE = r"(?iU)\b\d[\d\s]*(?:da|dz|dzd|دج|دينار|dinars?|euros?|€)\b|\b(?:da|dz|dzd|دج|دينار)\s*\d[\d\s]*\b|\b\d+\s*(?:da|dz)\b"
PHONE = r"(?U)\b(?:0|\+213|00213)[\s\-]?[5-7]\d[\s\-]?\d{2}[\s\-]?\d{2}[\s\-]?\d{2}\b|\b0[5-7]\d{8}\b"
LATIN_RUN = r"(?iU)\b[b-df-hj-np-tv-z]{6,}\b"
ARABIC_RUN = r"[\x{0621}-\x{064A}]{1,2}([\x{0621}-\x{064A}])\1{3,}"


def rejection(c: Column, technical: tuple[str, ...] = ()) -> Column:
    """Why the core normaliser refuses a text: blank, mostly a price, a phone number or gibberish, or technical terms alone; else null."""
    t = strip(F.coalesce(c, F.lit("")))

    def mostly(pattern: str, share: float) -> Column:
        return t.rlike(pattern) & (F.length(strip(F.regexp_replace(t, pattern, ""))) < F.length(t) * share)

    out = F.when(t == "", "vide").when(mostly(PRICE, 0.3), "prix_detecte").when(mostly(PHONE, 0.3), "telephone_detecte")
    if technical:
        terms = "|".join(f"\\Q{x}\\E" for x in sorted(technical, key=len, reverse=True))
        rest = F.regexp_replace(F.regexp_replace(t, rf"(?iU)\b(?:{terms})\b", ""), r"(?U)[\d\s\W]+", "")
        out = out.when((rest == "") & (F.size(tokens(t)) <= 5), "technique_seul")
    return out.when(mostly(LATIN_RUN, 0.4), "charabia_clavier").when(mostly(ARABIC_RUN, 0.4), "charabia_arabe")


def core_form(c: Column) -> Column:
    """Lower case, no tags, letters and digits apart, single spaces."""
    return strip(_sub(F.lower(c), (r"(?U)#\w+", ""), (r"(?U)([a-zA-Z\x{0621}-\x{064A}])(\d)", "$1 $2"), (r"(?U)(\d)([a-zA-Z\x{0621}-\x{064A}])", "$1 $2"), (r"(?U)\s{2,}", " ")))


# French contractions that stay one token.
CONTRACTIONS = (
    "aujourd'hui", "j'aime", "j'ai", "j'étais", "j'aurais", "j'avais", "j'aurai", "c'est", "c'était", "c'étais", "c'étaient", "m'aime", "m'ai", "m'as", "m'a",
    "t'aime", "t'ai", "t'as", "t'a", "s'aime", "s'ai", "s'est", "s'était", "n'aime", "n'ai", "n'est", "n'était", "n'aurais", "l'aime", "l'ai", "l'a", "l'as", "l'avait",
    "d'accord", "d'abord", "d'ailleurs", "d'habitude", "d'orange", "d'ooredoo", "d'aide", "d'eau", "d'un", "d'une", "d'entre", "qu'il", "qu'elle", "qu'on", "qu'ils", "qu'elles", "qu'importe",
)
#: Letters beyond ASCII whose canonical form begins with an ASCII letter, and these.
ACCENTED = {c: base for k in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if (base := unicodedata.normalize("NFD", c := chr(k))[0]) != c and base.isascii()}
COMBINING = r"[\x{0300}-\x{036F}]"


def ascii_fold(c: Column) -> Column:
    """Lower case without accents; what is not ASCII then goes."""
    return F.regexp_replace(F.translate(F.lower(c), "".join(ACCENTED), "".join(ACCENTED.values())), r"[^\x00-\x7F]", "")


def contraction_tokens(c: Column) -> Column:
    """Words and single signs; a contraction is one token, written as a code: ``j'étais`` is ``J_ETAIS``."""
    pieces = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?U)([\w']+|[^\w\s])"))
    return F.transform(pieces, lambda w: F.when(F.lower(w).isin(*CONTRACTIONS), F.upper(F.replace(ascii_fold(w), F.lit("'"), F.lit("_")))).otherwise(w))


def nettoyer(c: Column) -> Column:
    """The cleaning of the intent model: emoji, addresses, mentions, tags and signs out, single spaces, lower case."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), SCRUB_EMOJI, " ")
    return F.lower(squeeze(_sub(t, (r"(?U)http\S+|www\.\S+", ""), (r"(?U)@\w+", ""), (r"(?U)#\w+", ""), (r"(?U)[^\w\s\x{0600}-\x{06FF}]", " "))))


def darija_language(c: Column) -> Column:
    """``inconnu`` for no words, ``darija_latin`` by digits that stand for sounds, else ``ar`` by script, ``fr`` by key words, ``darija_latin`` for the rest."""

    def named(t: Column) -> Column:
        return let(language(t), lambda kind: F.when(t == "", "inconnu").when(t.rlike("[2379]"), "darija_latin").when(kind == "ar", "ar").when(kind == "fr", "fr").otherwise("darija_latin"))

    return let(strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[^\w\s]", "")), named)


def normalise_by_language(c: Column, darija: dict[str, str], arabic: dict[str, str]) -> Column:
    """Cleaned text, translated by its language: Arabic expressions in the dictionary's order, Latin dialect by sounds and then by pairs of words and words."""

    def translated(t: Column) -> Column:
        return let(darija_language(t), lambda kind: by_kind(t, kind))

    def by_kind(t: Column, kind: Column) -> Column:
        out = F.when(kind == "ar", reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), arabic.items(), t))
        return squeeze(out.when(kind == "darija_latin", translate_tokens(phonemes(t), darija)).otherwise(t))

    return let(nettoyer(c), translated)


def token_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with the tokens, their number and the language of each of ``columns``; null gives no tokens, 0 and ``unknown``."""
    out = df
    for name in columns:
        out = out.withColumn(f"{name}_tokens", tokens(F.col(name))).withColumn(f"{name}_count", F.size(f"{name}_tokens")).withColumn(f"{name}_lang", language(F.col(name)))
    return out
