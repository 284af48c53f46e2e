"""Links between contents that meet in buckets, without pairing whole buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved
from tessera.operators.work import components

#: Least Jaccard similarity of a link, as a fraction.
SIMILARITY = (4, 5)
#: Words of 64 bits in a sketch, a power of two.
SKETCH = 16


def may_be_similar(x: Column, y: Column) -> Column:
    """Whether two texts with places ``x`` and ``y`` (position in the prefix, size) of a shared shingle reach the similarity if it is the first that they share.

    They then have at most what is left of either from there on in common, and
    need 4/9 of the sum of their sizes. A similar pair passes at the first
    shingle it shares, which both prefixes hold.
    """
    size = lambda p: p.bitwiseAND(F.lit(0x7FFFFFFF))
    left = F.least(size(x) - F.shiftright(x, 32), size(y) - F.shiftright(y, 32))
    return left * sum(SIMILARITY) >= (size(x) + size(y)) * SIMILARITY[0]


def may_be_similar_sets(x: Column, y: Column) -> Column:
    """``may_be_similar`` for the places of ``prefix_members``, and whether the sets' sketches allow it.

    A sketch has a bit for each of ``64 * SKETCH`` classes of shingles. Sets that differ in d
    shingles differ in d bits at most, and similar ones in a ninth of the sum of
    their sizes, so no similar pair is barred.
    """
    differing = sum((F.bit_count(x[f"k{i}"].bitwiseXOR(y[f"k{i}"])) for i in range(1, SKETCH)), F.bit_count(x["k0"].bitwiseXOR(y["k0"])))
    sizes = x["p"].bitwiseAND(F.lit(0x7FFFFFFF)) + y["p"].bitwiseAND(F.lit(0x7FFFFFFF))
    return may_be_similar(x["p"], y["p"]) & (differing * sum(SIMILARITY) <= sizes * (SIMILARITY[1] - SIMILARITY[0]))


def several(entries: DataFrame) -> DataFrame:
    """``entries`` (s, content, place) of buckets with more than one content, and how many these are, ``n``."""
    sizes = entries.groupBy("s").agg(F.count("*").alias("n")).where("n > 1")
    return saved(entries.join(sizes, "s"), "buckets")


def prefix_members(sets: DataFrame) -> DataFrame:
    """Rows (s, content, place): the shingles of which sets (content, s) that are similar share one, where several do.

    A set of n shingles has at least 0.8 n in common with any that is similar,
    so its first n - 0.8 n + 1 in one order of all shingles hold one of them; the
    rarest come first. ``place`` has the position and n, and a sketch of the set,
    for ``may_be_similar_sets``.
    """
    tokens = saved(sets.select("content", F.size("s").alias("n"), F.explode("s").alias("t")), "tokens")
    often = tokens.groupBy("t").agg(F.count("*").alias("often"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("t").bitwiseAND(F.lit(63)).cast("int"))
    of = F.shiftrightunsigned("t", 6).bitwiseAND(F.lit(SKETCH - 1))
    sketch = [F.bit_or(F.when(of == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"k{i}") for i in range(SKETCH)]
    ordered = tokens.join(often, "t").groupBy("content", "n").agg(F.array_sort(F.collect_list(F.struct("often", "t"))).alias("ts"), *sketch)
    keep = F.col("n") - F.ceil(F.col("n") * SIMILARITY[0] / SIMILARITY[1] - 1e-9) + 1
    sketch = [f"k{i}" for i in range(SKETCH)]
    prefix = ordered.select("content", "n", *sketch, F.posexplode(F.slice("ts", F.lit(1), keep.cast("int"))).alias("at", "x")).where("x.often > 1")
    return several(prefix.select(F.col("x.t").alias("s"), "content", F.struct((F.shiftleft(F.col("at").cast("long"), 32) + F.col("n")).alias("p"), *sketch).alias("place")))


def stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``several``: each content with one hub of its buckets, so that a large group costs a pair a member.

    A bucket's hub is the content that meets most others in all its buckets: of
    many variants of one text that text itself, which is similar to them all.
    """
    weights = members.groupBy("content").agg(F.sum("n").alias("w"))
    hubs = members.join(weights, "content").groupBy("s").agg(F.max(F.struct("w", "content")).alias("m")).select("s", F.col("m.content").alias("hub"))
    return most_met(members.join(hubs, "s").select("content", "hub"))


def most_met(met: DataFrame) -> DataFrame:
    """Pairs (a, b) from (content, hub): each content with the hub that it meets most often."""
    counts = met.where("content <> hub").groupBy(F.col("content").alias("a"), F.col("hub").alias("b")).count()
    return saved(counts.groupBy("a").agg(F.max(F.struct("count", "b")).alias("m")).select("a", "m.b"), "stars")


def open_members(members: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (s, content, place, root) of the buckets that ``links`` leave in more than one component."""
    roots = components(links).select(F.col("node").alias("content"), "root")
    rooted = saved(members.select("s", "content", "place").join(roots, "content", "left").withColumn("root", F.coalesce("root", "content")), "rooted-buckets")
    ends = rooted.groupBy("s").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("s")
    return saved(rooted.join(ends, "s", "left_semi"), "open-buckets")


def bucket_links(members: DataFrame, may: Callable[[Column, Column], Column], similar: Callable[[DataFrame], DataFrame], first: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Links (a, b) that join all contents which are similar and share a bucket into the right components.

    ``members`` has rows (s, content, place): a content in bucket ``s``. ``may``
    tells by two places whether a pair can be similar, ``similar`` picks the
    similar ones of pairs (a, b). After the pairs ``first``, in buckets that are
    not yet one component, all that are outside the largest component are
    compared with all of other components. So each pair that is similar is
    either compared or linked through others. ``links`` are known before.
    """
    found = similar(first)
    links = saved(found if links is None else links.unionByName(found), "similar")
    members = open_members(members, links)
    largest = members.groupBy("s", "root").agg(F.count("*").alias("n")).groupBy("s").agg(F.max(F.struct("n", "root")).alias("top")).select("s", F.col("top.root").alias("top"))
    marked = saved(members.join(largest, "s"), "marked-buckets")
    outside = marked.where("root <> top").select("s", F.col("content").alias("x"), F.col("place").alias("x_place"), F.col("root").alias("x_root"))
    rest = outside.join(marked.select("s", F.col("content").alias("y"), F.col("place").alias("y_place"), F.col("root").alias("y_root")), "s").where("x_root <> y_root").where(may(F.col("x_place"), F.col("y_place")))
    rest = rest.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    second = saved(rest.join(first, ["a", "b"], "left_anti"), "pairs")
    return saved(links.unionByName(similar(second)), "similar")
