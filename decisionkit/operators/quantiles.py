"""Exact quantiles, running counts over values, and histograms.

Values are first collapsed to (value, count); the distinct values are then cut into ranges by
approximate quantiles, so that the ordered pass runs in many tasks. The result is exact: the
approximation only decides where the ranges are cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .ordered import match_keys

RANGES = 256  # least number of ranges, a power of four


def range_count(df: DataFrame) -> int:
    """Ranges to cut an order into: follows the shuffle partitions, so that a range stays a task's work. No result depends on it."""
    ranges, wanted = RANGES, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while ranges < wanted:
        ranges *= 4
    return ranges


def _with_range(df: DataFrame, value: str, cuts: str, ranges: int, name: str = "_range") -> DataFrame:
    """Add how many cuts lie below the value: a four-way search, a dozen plain comparisons."""
    out = df.withColumn(name, F.lit(0))
    step = ranges // 4
    while step:
        here = [F.get(F.col(cuts), F.col(name) + (i * step - 1)) < F.col(value) for i in (1, 2, 3)]
        out = out.withColumn(name, F.col(name) + sum((h.cast("int") for h in here[1:]), here[0].cast("int")) * step)
        step //= 4
    return out.drop(cuts)


def _ranges(df: DataFrame, by: Sequence[str], value: str, totals: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Distinct values with their range, and per range the totals before it and of the whole group."""
    present = df.filter(F.col(value).isNotNull())
    distinct = present.groupBy(*by, value).agg(*[F.sum(e).alias(n) for n, e in totals.items()])
    ranges = range_count(df)
    points = ", ".join(f"{i / ranges}D" for i in range(1, ranges))
    cuts = F.percentile_approx(value, F.expr(f"array({points})"), 16 * ranges).alias("_cuts")
    if by:
        # Written down first: Spark then knows its size and broadcasts it only if it is small.
        ranged = match_keys(distinct, staged(present.groupBy(*by).agg(cuts), "cuts"), by)
    else:
        ranged = distinct.withColumn("_cuts", present.agg(cuts).scalar())
    ranged = _with_range(ranged, value, "_cuts", ranges)
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy(*by, "_range")
        .agg(*[F.sum(n).alias(f"_r_{n}") for n in totals])
        .select(
            *by,
            "_range",
            *[f"_r_{n}" for n in totals],
            *[F.coalesce(F.sum(f"_r_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in totals],
            *[F.sum(f"_r_{n}").over(whole).alias(f"{n}_all") for n in totals],
        )
    )
    return ranged, carried


def _running(ranged: DataFrame, carried: DataFrame, by: Sequence[str], value: str, names: Sequence[str], how: str) -> DataFrame:
    inside = (
        Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return match_keys(ranged, carried, [*by, "_range"], how).select(
        *by,
        value,
        *names,
        *[
            (F.coalesce(F.sum(n).over(inside), F.lit(0)) + F.col(f"_c_{n}")).alias(f"{n}_before")
            for n in names
        ],
        *[f"{n}_all" for n in names],
    )


def ordered_distinct(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    totals: Mapping[str, Column],
) -> DataFrame:
    """One row per (by, value): each total, ``<name>_before`` over smaller values and ``<name>_all``."""
    by = list(by)
    ranged, carried = _ranges(df, by, value, totals)
    return _running(ranged, carried, by, value, list(totals), "left")


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], name: str = "quantiles", weight: str | None = None
) -> DataFrame:
    """One row per group: array of linearly interpolated quantiles of the non-NULL values.

    ``weight`` names a column that says how many rows a row stands for.

    Range counts show which ranges hold the wanted positions; only their values are put in order.
    """
    by = list(by)
    count = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    work = df.select(*by, F.col(value).cast("double").alias("_value"), count.alias("_w")).filter("_w > 0")
    ranged, carried = _ranges(work, by, "_value", {"_n": F.col("_w")})
    positions = [F.lit(float(p)) * (F.col("_n_all") - 1) for p in probs]
    last = F.col("_c__n") + F.col("_r__n") - 1
    wanted = F.lit(False)
    for at in positions:
        wanted = wanted | F.floor(at).between(F.col("_c__n"), last) | F.ceil(at).between(F.col("_c__n"), last)
    # The few wanted ranges are written down, so that the join can drop all other values before a shuffle.
    ranked = _running(ranged, staged(carried.filter(wanted), "ranges"), by, "_value", ["_n"], "inner")
    low, high = F.col("_n_before"), F.col("_n_before") + F.col("_n") - 1
    aggregates, parts = [], []
    for i, at in enumerate(positions):
        floor, ceil = F.floor(at), F.ceil(at)
        aggregates += [
            F.max(F.when(floor.between(low, high), F.col("_value"))).alias(f"_lo_{i}"),
            F.max(F.when(ceil.between(low, high), F.col("_value"))).alias(f"_hi_{i}"),
            F.max(at - floor).alias(f"_w_{i}"),
        ]
        parts.append(F.col(f"_lo_{i}") + (F.col(f"_hi_{i}") - F.col(f"_lo_{i}")) * F.col(f"_w_{i}"))
    return ranked.groupBy(*by).agg(*aggregates).select(*by, F.array(*parts).alias(name))


def tall(df: DataFrame, keep: Sequence[str], columns: Sequence[str], name: str = "feature", value: str = "value",
         cast: str = "double") -> DataFrame:
    """Wide to long: one row per (kept columns, feature)."""
    return df.select(*keep, *[F.col(c).cast(cast).alias(c) for c in columns]).unpivot(
        list(keep), list(columns), name, value
    )


def bin_right_closed(value: Column, edges: Column) -> Column:
    """0-based bin for edges e0 < e1 < ... : (e_i, e_i+1], the first bin also holds e0 and below."""
    inner = F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    return F.size(F.filter(inner, lambda e: e < value))


def bin_left_closed(value: Column, edges: Column) -> Column:
    """0-based bin [e_i, e_i+1), the last bin also holds its right edge and above."""
    inner = F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    return F.size(F.filter(inner, lambda e: e <= value))
