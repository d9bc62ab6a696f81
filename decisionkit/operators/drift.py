"""Distribution drift between a reference and a current window, for many features in one plan.

Input is tall: (feature, value, part) with part 'ref' or 'cur'. Statistics come from binned counts or
running counts over distinct values, never from rows held together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..session import staged
from .ordered import match_keys
from .quantiles import bin_left_closed, exact_quantiles, ordered_distinct
from .resampling import bootstrap_totals

FLOOR = 1e-6
PSI_WARN, PSI_CRITICAL = 0.10, 0.25


def in_part(name: str) -> Column:
    return (F.col("part") == name).cast("bigint")


def value_cells(tidy: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """(feature, value, ref, cur): the rows collapsed to distinct values, written once; edges, bins and KS all read this."""
    cells = tidy.groupBy(*by, "value").agg(F.sum(in_part("ref")).alias("ref"), F.sum(in_part("cur")).alias("cur"))
    return staged(cells, "cells")


def reference_edges(cells: DataFrame, by: Sequence[str] = ("feature",), bins: int = 10) -> DataFrame:
    """Distinct interpolated quantiles of the reference values, per feature."""
    points = [i / bins for i in range(bins + 1)]
    edges = exact_quantiles(cells, by, "value", points, "_q", weight="ref")
    # Used by several later steps; a few numbers per feature, so they are written down once.
    return staged(edges.select(*by, F.array_distinct("_q").alias("edges")), "edges")


def binned(tidy: DataFrame, edges: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """Rows with their bin; the outer bins are open-ended, so that no current value is lost."""
    return match_keys(tidy.filter(F.col("value").isNotNull()), edges, list(by), "inner").withColumn(
        "bin", bin_left_closed(F.col("value"), F.col("edges"))
    )


def share_table(cells: DataFrame, edges: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """(feature, bin, p, q) with every bin present and shares clipped from below, not renormalised."""
    by = list(by)
    counts = binned(cells, edges, by).groupBy(*by, "bin").agg(F.sum("ref").alias("_r"), F.sum("cur").alias("_c"))
    bins = edges.filter(F.size("edges") >= 3).select(
        *by, F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin")
    )
    full = match_keys(bins, counts, [*by, "bin"])
    whole = Window.partitionBy(*by)
    ref, cur = F.coalesce("_r", F.lit(0)), F.coalesce("_c", F.lit(0))
    p = ref / F.nullif(F.sum(ref).over(whole).cast("double"), F.lit(0.0))
    q = cur / F.nullif(F.sum(cur).over(whole).cast("double"), F.lit(0.0))
    return full.select(
        *by, "bin", ref.alias("n_ref"), cur.alias("n_cur"),
        F.greatest(p, F.lit(FLOOR)).alias("p"), F.greatest(q, F.lit(FLOOR)).alias("q"),
    )


def psi_of(p: Column, q: Column) -> Column:
    return F.sum((q - p) * F.ln(q / p))


def divergences(shares: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """PSI and squared Jensen-Shannon distance (base 2, shares renormalised) per feature."""
    by = list(by)
    sums = shares.groupBy(*by).agg(F.sum("p").alias("_ps"), F.sum("q").alias("_qs"))
    work = match_keys(shares, sums, by).select(
        *by, "p", "q", (F.col("p") / F.col("_ps")).alias("_p"), (F.col("q") / F.col("_qs")).alias("_q")
    )
    p, q = F.col("_p"), F.col("_q")
    middle = (p + q) / 2
    js = F.sum((p * F.log2(p / middle) + q * F.log2(q / middle)) / 2)
    return work.groupBy(*by).agg(r6(psi_of(F.col("p"), F.col("q"))).alias("psi"), r6(js).alias("js"))


def kolmogorov_tail(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value: 2 * sum (-1)^(j-1) exp(-2 j^2 x^2)."""
    x2 = n.cast("double") * m / (n + m) * statistic * statistic
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda j: F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * x2),
    )
    total = 2.0 * F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
    return F.when(x2 < 0.04, 1.0).otherwise(F.greatest(F.least(total, F.lit(1.0)), F.lit(0.0)))


def ks_two_sample(tidy: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    return ks_of(value_cells(tidy, by), by)


def ks_of(cells: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    by = list(by)
    cells = ordered_distinct(cells, by, "value", {"ref": F.col("ref"), "cur": F.col("cur")})
    left = (F.col("ref_before") + F.col("ref")) / F.nullif(F.col("ref_all").cast("double"), F.lit(0.0))
    right = (F.col("cur_before") + F.col("cur")) / F.nullif(F.col("cur_all").cast("double"), F.lit(0.0))
    stats = cells.groupBy(*by).agg(
        F.max(F.abs(left - right)).alias("ks_stat"), F.max("ref_all").alias("n_ref"), F.max("cur_all").alias("n_cur")
    )
    # The tail is taken from the unrounded statistic, so it is computed before the rounding.
    tailed = stats.withColumn("_tail", kolmogorov_tail(F.col("ks_stat"), F.col("n_ref"), F.col("n_cur")))
    return tailed.select(*by, "n_ref", "n_cur", r6(F.col("ks_stat")).alias("ks_stat"), r6(F.col("_tail")).alias("ks_p"))


def numeric_drift(tidy: DataFrame, by: Sequence[str] = ("feature",), bins: int = 10, ks: bool = True) -> DataFrame:
    """PSI, Jensen-Shannon and, with ``ks``, KS per feature; fewer than three distinct edges count as no drift."""
    by = list(by)
    cells = value_cells(tidy, by)
    edges = reference_edges(cells, by, bins)
    table = match_keys(edges, divergences(share_table(cells, edges, by), by), by)
    usable = F.size("edges") >= 3
    neutral = {"psi": 0.0, "js": 0.0}
    if ks:
        table = match_keys(table, ks_of(cells, by).select(*by, "ks_stat", "ks_p"), by)
        neutral |= {"ks_stat": 0.0, "ks_p": 1.0}
    return table.select(*by, *[F.when(usable, F.col(c)).otherwise(F.lit(v)).alias(c) for c, v in neutral.items()])


def level_table(tidy: DataFrame) -> DataFrame:
    """(feature, level, n_ref, n_cur) over the union of levels; NULL is its own level."""
    named = tidy.withColumn("level", F.coalesce(F.col("value").cast("string"), F.lit("None")))
    return named.groupBy("feature", "level").agg(
        F.sum(in_part("ref")).alias("n_ref"), F.sum(in_part("cur")).alias("n_cur")
    )


def with_totals(levels: DataFrame) -> DataFrame:
    """Totals per feature joined to its levels, so that many levels never meet in one task."""
    totals = levels.groupBy("feature").agg(
        F.sum("n_ref").cast("double").alias("_r"),
        F.sum("n_cur").cast("double").alias("_c"),
        (F.count(F.lit(1)) - 1).alias("df"),
    )
    return match_keys(levels, totals, ["feature"])


def chi_square(levels: DataFrame) -> DataFrame:
    """Homogeneity statistic of the 2 x L table, with Yates' correction when there is one degree of freedom."""
    work = with_totals(levels)
    both = (F.col("n_ref") + F.col("n_cur")) / F.nullif(F.col("_r") + F.col("_c"), F.lit(0.0))

    def part(seen: str, total: str) -> Column:
        expected = F.col(total) * both
        gap = F.abs(F.col(seen) - expected)
        gap = F.when(F.col("df") == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.when(expected > 0, gap * gap / expected).otherwise(0.0)

    return work.groupBy("feature").agg(
        r6(F.sum(part("n_ref", "_r") + part("n_cur", "_c"))).alias("chi2"), F.max("df").alias("df")
    )


def level_shares(levels: DataFrame) -> DataFrame:
    p = F.col("n_ref") / F.nullif(F.col("_r"), F.lit(0.0))
    q = F.col("n_cur") / F.nullif(F.col("_c"), F.lit(0.0))
    return with_totals(levels).select(
        "feature", "level", F.greatest(p, F.lit(FLOOR)).alias("p"), F.greatest(q, F.lit(FLOOR)).alias("q")
    )


def chi_square_tail(table: DataFrame) -> DataFrame:
    """p-value of each chi-square statistic: closed sums over the degrees of freedom.

    Even df is a Poisson tail. Odd df starts from the normal tail, which a rational approximation
    (absolute error below 1.5e-7) provides.
    """
    half = F.greatest(F.col("chi2") / 2.0, F.lit(1e-300))
    z = F.sqrt(half)
    t = 1.0 / (1.0 + 0.3275911 * z)
    # Published coefficients of the error-function approximation.
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    normal_tail = poly * F.exp(-half)
    steps = F.floor(F.col("df") / 2).cast("int")

    def tail(first: Column, start: Column, shift: float) -> Column:
        """Sum of ``steps`` terms; each is kept as its logarithm, for the first ones may be too small for a double."""
        zero = F.struct(first.alias("log_term"), start.alias("total"))
        grown = lambda s, i: F.struct((s["log_term"] + F.ln(half / (i + shift))).alias("log_term"), (s["total"] + F.exp(s["log_term"])).alias("total"))
        return F.when(steps < 1, start).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), zero, grown)["total"])

    even = tail(-half, F.lit(0.0), 0.0)
    odd = tail(F.ln(2.0 * z / F.sqrt(F.lit(3.141592653589793))) - half, normal_tail, 0.5)
    p = F.when(F.col("df") < 1, 1.0).when(F.col("df") % 2 == 0, even).otherwise(odd)
    return table.withColumn("p_value", r6(F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0))))


def benjamini_hochberg(tests: DataFrame, p: str = "p_value", name: str = "p_adjusted", order: str = "feature") -> DataFrame:
    """Step-up adjustment over one family of checks (a short table)."""
    rank = F.row_number().over(Window.orderBy(p, order))
    m = F.count(F.lit(1)).over(Window.partitionBy())
    work = tests.withColumn("_rank", rank).withColumn("_raw", F.col(p) * m / F.col("_rank"))
    upward = Window.orderBy(F.col("_rank").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    adjusted = F.least(F.greatest(F.min("_raw").over(upward), F.lit(0.0)), F.lit(1.0))
    return work.withColumn(name, r6(adjusted)).drop("_rank", "_raw")


def status(value: Column, warn: float = PSI_WARN, critical: float = PSI_CRITICAL) -> Column:
    return F.when(value >= critical, "critical").when(value >= warn, "warning").otherwise("ok")


def status_board(signals: DataFrame, warn: float = PSI_WARN, critical: float = PSI_CRITICAL) -> DataFrame:
    return signals.select(
        "signal", "value", F.lit(warn).alias("warn"), F.lit(critical).alias("critical"),
        status(F.col("value"), warn, critical).alias("status"),
    )


def psi_control_limit(tidy: DataFrame, key: str, replicates: int, level: float = 0.95) -> DataFrame:
    """PSI limits from the reference itself: each replicate redraws the reference and is compared with it."""
    reference = tidy.filter("part = 'ref'")
    edges = reference_edges(value_cells(reference))
    rows = binned(reference, edges).select(key, "feature", "bin")
    drawn = bootstrap_totals(rows, key, replicates, {"_w": F.lit(1)}, "limits", by=["feature", "bin"]).filter("_w > 0")
    base = rows.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("_n"))
    per = Window.partitionBy("feature", "replicate")
    p_all = Window.partitionBy("feature")
    base = base.withColumn("p", F.greatest(F.col("_n") / F.sum("_n").over(p_all), F.lit(FLOOR)))
    shares = match_keys(drawn, base, ["feature", "bin"]).withColumn(
        "q", F.greatest(F.col("_w") / F.sum("_w").over(per), F.lit(FLOOR))
    )
    values = shares.groupBy("feature", "replicate").agg(psi_of(F.col("p"), F.col("q")).alias("psi"))
    return values.groupBy("feature").agg(
        F.count(F.lit(1)).alias("replicates"), r6(F.percentile("psi", F.lit(level))).alias("psi_limit")
    )


def breach_runs(table: DataFrame, step: str, breach: str, by: Sequence[str] = ()) -> DataFrame:
    """Length of the current run of consecutive breaches at each step of a short series."""
    ordered = Window.partitionBy(*by).orderBy(step)
    calm = F.sum((~F.col(breach)).cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    work = table.withColumn("_island", calm)
    inside = Window.partitionBy(*by, "_island").orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.sum(F.col(breach).cast("bigint")).over(inside)
    return work.withColumn("run_length", F.when(F.col(breach), run).otherwise(F.lit(0).cast("bigint"))).drop("_island")


def retraining_gate(series: DataFrame, needed_run: int) -> DataFrame:
    """Retrain only when drift is sustained AND labels show degradation AND the candidate passes its gates."""
    return series.withColumn(
        "retrain", (F.col("run_length") >= needed_run) & F.col("degraded") & F.col("candidate_passes")
    )
