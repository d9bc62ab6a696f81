"""Declared approximate forms: mergeable sketches stored per load, with their error bound in every row.

A load is read once; afterwards any set of loads is answered by merging their sketches, without their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_K, HLL_BITS = 200, 12


def rank_bound(k: int = KLL_K) -> float:
    """Twice the normalised rank error that a KLL sketch of size k keeps with 99 percent confidence."""
    return 2 * 2.296 / k**0.9723


def distinct_bound(bits: int = HLL_BITS) -> float:
    """Five standard errors of a HyperLogLog count, as a share of the count."""
    return 5 * 1.04 / (1 << bits) ** 0.5


def load_sketches(df: DataFrame, load: str, by: Sequence[str], value: str, key: str, k: int = KLL_K, bits: int = HLL_BITS) -> DataFrame:
    """One row per load and group: rows, values, the KLL sketch of ``value``, the HLL sketch of ``key``. Null values and keys are not in the sketches."""
    return df.groupBy(load, *by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("values"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("kll"),
        F.hll_sketch_agg(F.col(key), F.lit(bits)).alias("hll"),
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sketches of all given loads as one row per group."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("values").alias("values"), F.kll_merge_agg_double("kll").alias("kll"), F.hll_union_agg("hll").alias("hll")
    )


def sketched_quantiles(merged: DataFrame, by: Sequence[str], probabilities: Sequence[float], k: int = KLL_K) -> DataFrame:
    """(by, values, probability, estimate, low, high): the value at each rank, and the values a rank bound below and above it. The exact quantile lies between them."""
    bound = rank_bound(k)
    at = lambda p: F.kll_sketch_get_quantile_double(F.col("kll"), F.lit(float(min(max(p, 0.0), 1.0))))
    answers = [F.struct(F.lit(float(p)).alias("probability"), at(p).alias("estimate"), at(p - bound).alias("low"), at(p + bound).alias("high")) for p in probabilities]
    return merged.filter("values > 0").select(*by, "values", F.inline(F.array(*answers)), F.lit(bound).alias("rank_error"))


def sketched_distinct(merged: DataFrame, by: Sequence[str], bits: int = HLL_BITS) -> DataFrame:
    """(by, estimate, low, high, relative_error) of the distinct keys."""
    bound, n = distinct_bound(bits), F.hll_sketch_estimate("hll")
    return merged.select(*by, n.alias("estimate"), F.floor(n / (1 + bound)).alias("low"), F.ceil(n / (1 - bound)).alias("high"), F.lit(bound).alias("relative_error"))
