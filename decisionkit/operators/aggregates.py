"""Counts, crosstabs, histograms, dispersion, correlation and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import r6, ratio
from .ordered import match_keys
from .quantiles import bin_left_closed, ordered_distinct


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share per level, most frequent first."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    share = ratio(F.col("n"), df.agg(F.count(F.lit(1))).scalar())
    return counts.select(*columns, "n", r6(share).alias("rate")).orderBy(F.col("n").desc(), *columns)


def crosstab_rates(df: DataFrame, row: str, column: str, levels: Sequence) -> DataFrame:
    """P(column | row): counts and shares with one column per level."""
    n = F.count(F.lit(1))
    parts = []
    for level in levels:
        hits = F.count_if(F.col(column) == level)
        parts += [hits.alias(f"n_{level}"), r6(ratio(hits, n)).alias(f"rate_{level}")]
    return df.groupBy(row).agg(*parts)


def histogram(df: DataFrame, by: Sequence[str], value: str, edges: Column, density: bool = False) -> DataFrame:
    """Rows per left-closed bin (the last bin is closed); values outside the edges are not counted."""
    v, bins = F.col(value), F.size(edges) - 1
    inside = (v >= F.get(edges, F.lit(0))) & (v <= F.get(edges, bins))
    counted = (
        df.filter(inside).groupBy(*by, bin_left_closed(v, edges).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    if not density:
        return counted
    width = F.get(edges, F.col("bin") + 1) - F.get(edges, F.col("bin"))
    total = F.sum("n").over(Window.partitionBy(*by))
    return counted.withColumn("density", r6(F.col("n") / (total * width)))


def equal_width_histogram(df: DataFrame, by: Sequence[str], value: str, bins: int) -> DataFrame:
    """``bins`` equal bins over the common range, with each group's own density."""
    low, high = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    work = df.withColumns({"_low": low, "_width": (high - low) / float(bins)})
    place = F.floor((F.col(value) - F.col("_low")) / F.nullif(F.col("_width"), F.lit(0.0)))
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = work.groupBy(*by, bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.max("_width").alias("_width")
    )
    total = F.sum("n").over(Window.partitionBy(*by))
    return counted.select(
        *by, "bin", "n", r6(ratio(F.col("n"), total * F.col("_width"))).alias("density")
    )


def dispersion(tidy: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Mean, sample SD and standard error of a tidy metric table."""
    sd, n = F.stddev_samp(value), F.count(value)
    return tidy.groupBy(*by).agg(
        n.alias("n"),
        r6(F.avg(value)).alias("mean"),
        r6(sd).alias("sd"),
        r6(sd / F.sqrt(F.nullif(n.cast("double"), F.lit(0.0)))).alias("sem"),
    )


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, from one aggregate."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    lines = F.array(
        *[
            F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), r6(F.col(f"_c{i}")).alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one.select(F.inline(lines))


def average_ranks(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """(by, value) -> average rank of the ties; ranks come from running counts of distinct values."""
    cells = ordered_distinct(df, by, value, {"_n": F.lit(1)})
    return cells.select(*by, value, (F.col("_n_before") + (F.col("_n") + 1) / 2.0).alias(name))


def spearman(df: DataFrame, left: str, right: str, by: Sequence[str] = ()) -> DataFrame:
    by = list(by)
    both = df.filter(F.col(left).isNotNull() & F.col(right).isNotNull()).select(*by, left, right)
    cells = both.groupBy(*by, left, right).agg(F.count(F.lit(1)).alias("_w"))
    ranked = match_keys(cells, average_ranks(both, by, left, "_rl"), [*by, left])
    ranked = match_keys(ranked, average_ranks(both, by, right, "_rr"), [*by, right])
    # Weighted by the number of rows in each (left, right) cell.
    w, x, y = F.col("_w").cast("double"), F.col("_rl"), F.col("_rr")
    n = F.sum(w)
    mx, my = F.sum(w * x) / n, F.sum(w * y) / n
    sums = ranked.groupBy(*by).agg(
        (F.sum(w * x * y) / n - mx * my).alias("_xy"),
        (F.sum(w * x * x) / n - mx * mx).alias("_xx"),
        (F.sum(w * y * y) / n - my * my).alias("_yy"),
        F.sum("_w").alias("n"),
    )
    rho = F.col("_xy") / F.nullif(F.sqrt(F.col("_xx") * F.col("_yy")), F.lit(0.0))
    return sums.select(*by, "n", r6(rho).alias("spearman"))


def group_mean(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Group mean on every row (the leaky baseline): an aggregate joined back, so no group is one task."""
    means = df.groupBy(by).agg(F.avg(value).alias(name))
    return match_keys(df, means, [by])


def by_slice(df: DataFrame, slices: Sequence[str]) -> DataFrame:
    """Each row once per slice and once overall, as columns (slice, level)."""
    lines = [F.struct(F.lit("overall").alias("slice"), F.lit("all").alias("level"))]
    lines += [F.struct(F.lit(s).alias("slice"), F.col(s).cast("string").alias("level")) for s in slices]
    return df.withColumn("_slice", F.explode(F.array(*lines))).select(*df.columns, "_slice.slice", "_slice.level")


def melt_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    doubles = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics])
    return doubles.unpivot(list(keys), list(metrics), "metric", "value")


def pivot_metrics(tidy: DataFrame, row: str, levels: Sequence[str], column: str = "metric", value: str = "value") -> DataFrame:
    """Tidy to wide with the levels named, so that no extra job looks for them."""
    return tidy.groupBy(row).pivot(column, list(levels)).agg(F.first(value))


def running_best(df: DataFrame, step: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Best value so far along a short curve, and the step that reached it."""
    so_far = Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("best_so_far", F.min(value).over(so_far)).withColumn(
        "best_step", F.min(F.struct(value, step)).over(so_far)[step]
    )


def shares_by(df: DataFrame, by: Sequence[str], parts: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[r6(F.avg(c.cast("int"))).alias(n) for n, c in parts.items()]
    )


def key_difference(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    return left.select(*key).join(right.select(*key), list(key), "left_anti")
