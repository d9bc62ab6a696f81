"""Reliability curves and calibration error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import mean_score, r6
from .ordered import match_keys
from .quantiles import bin_right_closed, exact_quantiles


def _curve(binned: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    return binned.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        mean_score(F.col(score)).alias("mean_predicted"),
        r6(F.avg(label)).alias("observed_rate"),
    )


def quantile_curve(df: DataFrame, by: Sequence[str], bins: int = 10, label: str = "y", score: str = "p") -> DataFrame:
    """Bins between exact score quantiles, right-closed; bins without rows do not appear."""
    edges = exact_quantiles(df, by, score, [i / bins for i in range(bins + 1)], "_edges")
    if by:
        work = match_keys(df, edges, list(by))
    else:
        work = df.withColumn("_edges", edges.scalar())
    return _curve(work.withColumn("bin", bin_right_closed(F.col(score), F.col("_edges"))), by, label, score)


def fixed_bin(score: Column, bins: int) -> Column:
    """Right-closed equal-width bin of a six-digit score, in whole millionths."""
    millionths = F.round(score * 1e6).cast("bigint")
    return F.greatest(F.ceil(millionths * bins / F.lit(1e6)) - 1, F.lit(0)).cast("int")


def fixed_curve(df: DataFrame, by: Sequence[str], bins: int = 10, label: str = "y", score: str = "p") -> DataFrame:
    return _curve(df.withColumn("bin", fixed_bin(F.col(score), bins)), by, label, score)


def expected_calibration_error(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    gap = F.sum(F.col("n") * F.abs(F.col("observed_rate") - F.col("mean_predicted")))
    return curve.groupBy(*by).agg(F.sum("n").alias("rows"), r6(gap / F.sum("n")).alias("ece"))
