"""Texts whose sets of characters are alike, as classes and counts of links, never as pairs of texts.

Nearly all long texts have nearly the same characters, so the links themselves
grow with the square of the texts. Two things keep the work apart from them:
equal sets are one content, and sets are grouped by their ``COMMON`` most
frequent characters (a bit mask) and their size. What two groups share in the
mask and how many other characters they have bounds the similarity of their
sets from both sides. Most pairs of groups are settled by that, and then count
with all of their texts at once; only in the others are sets compared, which
have to share some of their rare characters, and meet by these.

Pairs of groups come from the pigeonhole principle: sets that differ in d
characters at most agree in one of d + 1 parts of the mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedup import compare_key
from tessera.operators.similarity import character_set, contents
from tessera.operators.work import components, saved

COMMON = 60
#: Stands for the set of an empty text; no character is as long.
NONE = "none"


def _masked(distinct: DataFrame) -> DataFrame:
    """Rows (content, copies, mask, n, rare): ``rare`` has the characters beyond the mask."""
    often = distinct.select(F.explode("features").alias("ch")).where(F.length("ch") == 1).groupBy("ch").agg(F.count("*").alias("c"))
    letters = "".join(r["ch"] for r in often.orderBy(F.desc("c"), "ch").limit(COMMON).collect())  # at most 60 rows
    place = lambda x: F.when(F.length(x) == 1, F.call_function("locate", x, F.lit(letters))).otherwise(0)
    bit = lambda x: F.when(place(x) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), place(x) - 1)).otherwise(F.lit(0).cast("long"))
    mask = F.aggregate("features", F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(bit(x)))
    return distinct.select("content", "copies", mask.alias("mask"), F.size("features").alias("n"), F.filter("features", lambda x: place(x) == 0).alias("rare"))


def _parts(most: int) -> Column:
    """By the number of parts, the bits of each part; frequent characters are dealt over all parts."""
    rows = [[sum(1 << b for b in range(COMMON) if b % n == k) for k in range(n)] for n in range(1, most + 1)]
    return F.array(F.array(F.lit(0).cast("long")), *[F.array(*[F.lit(x).cast("long") for x in r]) for r in rows])


def _group_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups (m1, n1, m2, n2), the smaller sets first, with what they ``share`` in the mask and what they ``need`` beyond it."""
    differ = lambda n: F.expr(f"2 * {n} * {100 - percent} div {100 + percent}").cast("int")
    largest = groups.agg(F.max("n")).first()[0] or 1
    most = min(COMMON, 2 * largest * (100 - percent) // (100 + percent) + 1)
    bits = _parts(most)
    number = lambda c: F.when(c <= COMMON, c).otherwise(0)  # noqa: E731 -- sets too large for parts of one bit have one empty part
    part = F.posexplode(F.element_at(bits, F.col("parts") + 1)).alias("part", "of")
    wide = groups.select("mask", "n", number(differ("n") + 1).alias("parts"))
    narrow = groups.select("mask", "n", F.explode(F.array_distinct(F.transform(F.sequence(differ("n"), differ(f"(n * 100 div {percent})")), lambda d: number(d + 1)))).alias("parts")).where(F.col("parts") <= most)
    x, y = (t.select("mask", "n", "parts", part).select("mask", "n", "parts", "part", F.col("mask").bitwiseAND(F.col("of")).alias("key")).alias(k) for t, k in ((narrow, "x"), (wide, "y")))
    on = (F.col("x.parts") == F.col("y.parts")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.key") == F.col("y.key"))
    on &= (F.struct("x.n", "x.mask") <= F.struct("y.n", "y.mask")) & (F.col("y.n") * percent <= F.col("x.n") * 100)
    pairs = x.join(y, on).select(F.col("x.mask").alias("m1"), F.col("x.n").alias("n1"), F.col("y.mask").alias("m2"), F.col("y.n").alias("n2"))
    share = F.bit_count(F.col("m1").bitwiseAND(F.col("m2")))
    need = F.ceil((F.col("n1") + F.col("n2")) * percent / (100 + percent) - 1e-9) - share
    rest = F.least(F.col("n1") - F.bit_count("m1"), F.col("n2") - F.bit_count("m2"))
    return pairs.withColumn("need", need.cast("int")).where(F.col("need") <= rest).distinct()


def character_classes(df: DataFrame, id_col: str, text: Column, percent: int = 85) -> DataFrame:
    """Rows (id, class_id, n_links) of all texts, in lower case and trimmed: the class is the least id that links reach.

    ``n_links`` counts the other rows whose set of characters has a Jaccard
    similarity of ``percent`` hundredths or more to the row's own. Null texts are
    left out; empty ones are linked with each other only.
    """
    chars = character_set(compare_key(text))
    members, distinct = contents(df.where(text.isNotNull()), id_col, F.when(F.size(chars) == 0, F.array(F.lit(NONE))).otherwise(chars))
    sets = saved(_masked(distinct), "character-sets")
    groups = saved(sets.groupBy("mask", "n").agg(F.sum("copies").alias("weight"), F.min("content").alias("first")), "character-groups")
    pairs = saved(_group_pairs(groups.select("mask", "n"), percent), "character-pairs")
    settled, open_ = pairs.where("need <= 0"), pairs.where("need > 0")

    one, other = ["m1", "n1"], ["m2", "n2"]
    turned = lambda t: t.select(*[F.col(a).alias(b) for a, b in zip(other + one, one + other, strict=True)])
    alone = (F.col("m1") == F.col("m2")) & (F.col("n1") == F.col("n2"))
    both = settled.select(*one, *other).unionByName(turned(settled.where(~alone)))
    named = groups.select(F.col("mask").alias("m2"), F.col("n").alias("n2"), "weight", "first")
    reach = both.join(named, other).groupBy(*one).agg(F.sum("weight").alias("reach"), F.bool_or(alone).alias("own"))

    rare = sets.select("mask", "n", "content", F.explode("rare").alias("ch"))
    x = rare.select(F.col("mask").alias("m1"), F.col("n").alias("n1"), F.col("content").alias("a"), "ch")
    y = rare.select(F.col("mask").alias("m2"), F.col("n").alias("n2"), F.col("content").alias("b"), "ch")
    met = x.join(open_, one).join(y, [*other, "ch"]).where(~alone | (F.col("a") < F.col("b")))
    links = saved(met.groupBy("a", "b", "need").agg(F.count("*").alias("shared")).where(F.col("shared") >= F.col("need")).select("a", "b"), "character-links")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = ends.join(sets.select(F.col("content").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("linked"))

    at = sets.join(reach, (F.col("mask") == F.col("m1")) & (F.col("n") == F.col("n1")), "left").join(groups.select(F.col("mask").alias("gm"), F.col("n").alias("gn"), "first"), (F.col("mask") == F.col("gm")) & (F.col("n") == F.col("gn")))
    at = saved(at.select("content", "copies", "reach", F.coalesce("own", F.lit(False)).alias("own"), "first"), "character-reach")
    firsts = settled.where(~alone).join(groups.select(F.col("mask").alias("m1"), F.col("n").alias("n1"), F.col("first").alias("a")), one).join(named.select(*other, F.col("first").alias("b")), other).select("a", "b")
    roots = components(links.unionByName(firsts).unionByName(at.where("reach is not null").select(F.col("content").alias("a"), F.col("first").alias("b"))))
    count = F.coalesce("reach", F.lit(0)) + F.coalesce("linked", F.lit(0)) + F.when(F.col("own"), -1).otherwise(F.col("copies") - 1)
    per = at.join(linked, F.col("content") == F.col("a"), "left").join(roots, F.col("content") == F.col("node"), "left").select("content", F.coalesce("root", "content").alias("class_id"), count.alias("n_links"))
    return members.select("id", "content").join(per, "content").select("id", "class_id", "n_links")
