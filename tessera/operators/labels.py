"""Label quality, annotation work and statistics over labelled rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Counts of each pair of labels, rows without one left out."""
    return df.where(F.col(predicted).isNotNull() & F.col(actual).isNotNull()).groupBy(predicted, actual).agg(F.count("*").alias("n"))


def kappa(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row (n, agreement, expected, kappa) from counts ``n`` of label pairs."""
    total = pairs.agg(F.sum("n").alias("total"), F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).alias("same"))
    left = pairs.groupBy(F.col(a).alias("label")).agg(F.sum("n").alias("na"))
    right = pairs.groupBy(F.col(b).alias("other")).agg(F.sum("n").alias("nb"))
    chance = left.join(right, F.col("label") == F.col("other")).agg(F.coalesce(F.sum(F.col("na").cast("double") * F.col("nb")), F.lit(0.0)).alias("chance"))
    out = total.crossJoin(chance)  # one row each
    po, pe = F.col("same") / F.col("total"), F.col("chance") / (F.col("total").cast("double") * F.col("total"))
    return out.select(F.col("total").alias("n"), po.alias("agreement"), pe.alias("expected"), F.try_divide(po - pe, 1 - pe).alias("kappa"))


# The five levels of agreement.
KAPPA_LEVELS = ((0.0, "mauvais"), (0.2, "faible"), (0.4, "modere"), (0.6, "bon"), (0.8, "excellent"))


#: The levels that two annotators are told.
ANNOTATOR_LEVELS = ((0.0, "Très faible"), (0.2, "Faible"), (0.4, "Modérée"), (0.6, "Forte"), (0.8, "Presque parfaite"))
ANNOTATOR_BELOW = "Très faible (désaccord)"


def kappa_level(k: Column, levels: tuple[tuple[float, str], ...] = KAPPA_LEVELS, below: str = "mauvais") -> Column:
    """The name of the level that a kappa reaches; ``below`` for one under zero."""
    out = F.lit(None).cast("string")
    for low, name in levels:
        out = F.when(k >= low, F.lit(name)).otherwise(out)
    return F.when(k < 0, below).otherwise(out)


def compare_judges(df: DataFrame, judge: str, verdict: Column, latency: Column, truth: Column) -> DataFrame:
    """One row a judge: rows, failures (no verdict), share of right verdicts where there is a truth, and mean, median and 95 % latency.

    Quantiles are exact, from counts of equal latencies.
    """
    rows = df.select(F.col(judge).alias("judge"), verdict.alias("v"), latency.cast("double").alias("s"), truth.alias("t"))
    both = F.col("v").isNotNull() & F.col("t").isNotNull()
    return rows.groupBy("judge").agg(
        F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("failures"), F.try_divide(F.count_if(both & (F.col("v") == F.col("t"))).cast("double"), F.count_if(both)).alias("agreement"),
        F.avg("s").alias("mean_latency"), F.percentile("s", 0.5).alias("p50"), F.percentile("s", 0.95).alias("p95"),
    )


def class_report(pairs: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Rows (label, support, precision, recall, f1) from counts ``n`` of label pairs; 0 where a denominator is."""
    got = pairs.select(F.col(predicted).alias("label"), F.col("n").alias("guessed"), F.lit(0).cast("long").alias("support"), F.when(F.col(predicted) == F.col(actual), F.col("n")).otherwise(0).alias("right"))
    real = pairs.select(F.col(actual).alias("label"), F.lit(0).cast("long").alias("guessed"), F.col("n").alias("support"), F.lit(0).cast("long").alias("right"))
    sums = got.unionByName(real).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("guessed", "support", "right")])
    p = F.coalesce(F.try_divide(F.col("right").cast("double"), F.col("guessed")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("right").cast("double"), F.col("support")), F.lit(0.0))
    return sums.select("label", "support", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def report_totals(report: DataFrame, pairs: DataFrame, predicted: str, actual: str) -> DataFrame:
    """One row (accuracy, macro_f1, weighted_f1) of a ``class_report`` and its counts ``n``."""
    right = pairs.agg(F.try_divide(F.sum(F.when(F.col(predicted) == F.col(actual), F.col("n")).otherwise(0)).cast("double"), F.sum("n")).alias("accuracy"))
    means = report.agg(F.avg("f1").alias("macro_f1"), F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"))
    return right.crossJoin(means)  # one row each


def disagreements(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows on whose label two annotators differ."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))


def import_validations(rows: DataFrame, votes: DataFrame, key: str, annotator: str, vote: str, label: str) -> DataFrame:
    """``rows`` with ``validations`` (annotator to label), the label of the last annotator by name, ``label_original`` and ``corrige``.

    Of several votes of one annotator on a row the greatest counts; rows without votes keep their label.
    """
    one = votes.where(F.col(annotator).isNotNull() & F.col(vote).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(annotator).alias("_a")).agg(F.max(vote).alias("_v"))
    per = one.groupBy("_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_a", "_v")))).alias("validations"), F.max_by("_v", "_a").alias("_last"))
    joined = rows.join(per, F.col(key) == F.col("_key"), "left").withColumn("label_original", F.col(label))
    changed = F.coalesce(F.col("_last") != F.col(label), F.col("_last").isNotNull())
    return joined.withColumn("corrige", changed).withColumn(label, F.coalesce("_last", label)).drop("_key", "_last")


def review_extract(rows: DataFrame, label: str, conflict: Column, neutral: str = "neutre") -> DataFrame:
    """The rows to look at again: neutral ones and those in conflict, with their ``cas``."""
    neutral_row = F.coalesce(F.col(label) == neutral, F.lit(False))
    case = F.when(neutral_row & conflict, "neutre+conflit").when(neutral_row, "neutre").when(conflict, "conflit")
    return rows.withColumn("cas", case).where("cas is not null")


def judged_accuracy(judged: DataFrame, predicted: str, ok: Column) -> DataFrame:
    """Rows (predicted, n, right, accuracy) for each predicted label and, with a null label, for all."""
    out = judged.rollup(predicted).agg(F.count("*").alias("n"), F.count_if(ok).alias("right"))
    return out.withColumn("accuracy", F.try_divide(F.col("right").cast("double"), F.col("n")))


def consensus(votes: DataFrame, item: str, annotator: str, label: str, least: int = 2) -> DataFrame:
    """Rows (item, n_validators, accord, label_final) of items with enough annotators; ``desaccord`` where they differ."""
    out = votes.where(F.col(label).isNotNull()).groupBy(item).agg(F.countDistinct(annotator).alias("n_validators"), (F.min(label) == F.max(label)).alias("accord"), F.min(label).alias("least_label")).where(F.col("n_validators") >= least)
    return out.select(item, "n_validators", "accord", F.when(F.col("accord"), F.col("least_label")).otherwise("desaccord").alias("label_final"))


def apply_corrections(rows: DataFrame, corrections: DataFrame, key: str, label: str, delete: str = "supprimer") -> DataFrame:
    """``rows`` with corrected labels and ``corrected``, without those marked for deletion.

    Of several corrections for one key a deletion counts, else the greatest label; a key that is null matches nothing.
    """
    c = corrections.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.col(label), F.struct(F.col(label) == delete, F.col(label))).alias("_label"))
    joined = rows.join(c, F.col(key) == F.col("_key"), "left").where(F.col("_label").isNull() | (F.col("_label") != delete))
    return joined.withColumn("corrected", F.col("_key").isNotNull()).withColumn(label, F.coalesce("_label", F.col(label))).drop("_key", "_label")


def correction_counts(rows: DataFrame, corrections: DataFrame, key: str, label: str, delete: str = "supprimer") -> DataFrame:
    """One row: how many corrections updated, deleted, or found no row."""
    c = corrections.join(rows.select(F.col(key).alias("_key")).distinct(), F.col(key) == F.col("_key"), "left")
    found = F.col("_key").isNotNull()
    return c.agg(F.count_if(found & (F.col(label) != delete)).alias("updated"), F.count_if(found & (F.col(label) == delete)).alias("deleted"), F.count_if(~found).alias("not_found"))


def chi_square(counts: DataFrame, row: str, col: str) -> DataFrame:
    """One row (n, chi2, dof) of the contingency counts ``n``, with Yates' correction where dof is 1. Cells without rows count."""
    r = counts.groupBy(F.col(row).alias("_r")).agg(F.sum("n").alias("nr"))
    c = counts.groupBy(F.col(col).alias("_c")).agg(F.sum("n").alias("nc"))
    t = counts.agg(F.sum("n").cast("double").alias("total"), F.countDistinct(row).alias("rows"), F.countDistinct(col).alias("cols"))
    # empty cells add their expected count: the sum over full cells of (o-e)^2/e - e, plus the total
    cells = counts.join(r, F.col(row) == F.col("_r")).join(c, F.col(col) == F.col("_c")).crossJoin(F.broadcast(t))  # one row
    e = F.col("nr") * F.col("nc") / F.col("total")
    dof = (F.col("rows") - 1) * (F.col("cols") - 1)
    off = F.abs(F.col("n") - e)
    near = F.when(dof == 1, off - F.least(F.lit(0.5), off)).otherwise(off)
    empty = F.when(dof == 1, F.lit(None).cast("double")).otherwise(e)
    out = cells.agg(F.sum(near * near / e).alias("full"), F.sum(empty).alias("covered"), F.max("total").alias("total"), F.max(dof).alias("dof"))
    return out.select(F.col("total").cast("long").alias("n"), (F.col("full") + F.coalesce(F.col("total") - F.col("covered"), F.lit(0.0))).alias("chi2"), F.col("dof"))


def t_test(df: DataFrame, value: str, group: str, a: str, b: str) -> DataFrame:
    """One row (n_a, n_b, mean_a, mean_b, t, dof): Student's t with equal variances."""
    of = lambda g: F.when(F.col(group) == g, F.col(value))
    s = df.agg(*[f(of(g)).alias(f"{k}_{x}") for x, g in (("a", a), ("b", b)) for k, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))])
    pooled = ((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / (F.col("n_a") + F.col("n_b") - 2)
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(pooled * (1 / F.col("n_a") + 1 / F.col("n_b"))))
    return s.select("n_a", "n_b", "mean_a", "mean_b", t.alias("t"), (F.col("n_a") + F.col("n_b") - 2).alias("dof"))


def chi_square_p(chi2: float, dof: int) -> float:
    """The upper tail of the chi-square distribution, by the series or the continued fraction of the incomplete gamma function."""
    if chi2 <= 0:
        return 1.0
    a, x = dof / 2, chi2 / 2
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        for k in range(1, 10_000):
            term *= x / (a + k)
            total += term
            if term < total * 1e-15:
                break
        return 1 - total * scale
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for k in range(1, 10_000):
        an = -k * (k - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h * scale


def t_p(t: float, dof: int) -> float:
    """Two-sided p of Student's t, by the continued fraction of the incomplete beta function."""
    x = dof / (dof + t * t)
    a, b = dof / 2, 0.5

    def fraction(a: float, b: float, x: float) -> float:
        c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
        h = d
        for m in range(1, 1000):
            for n in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 / (1 + n * d), 1 + n / c
                h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return h

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b


def softmax_top(scores: Column, k: int = 3) -> Column:
    """The ``k`` largest of softmax(scores) as (index, p), largest first."""
    top = F.array_max(scores)
    exps = F.transform(scores, lambda x: F.exp(x - top))
    total = F.aggregate(exps, F.lit(0.0), lambda s, x: s + x)
    ranked = F.array_sort(F.transform(exps, lambda x, i: F.struct((-x / total).alias("p"), i.alias("i"))))
    return F.transform(F.slice(ranked, 1, k), lambda r: F.struct(r["i"].alias("index"), (-r["p"]).alias("p")))


def decide(top: Column, names: list[str], least: float = 0.40, unsure: str = "incompris") -> Column:
    """The name of the best of ``softmax_top``, or ``unsure`` where its p is below ``least``."""
    best = top[0]
    return F.when(best["p"] >= least, F.element_at(F.array(*[F.lit(n) for n in names]), best["index"] + 1)).otherwise(F.lit(unsure))
