"""Explanation summaries of additive scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket, hash_order
from ..functions.scalars import mean_score, r6
from .aggregates import spearman
from .ordered import ordered_state
from .scoring import Scorecard


def linear_attributions(df: DataFrame, card: Scorecard, key: str) -> DataFrame:
    """(key, feature, phi): each term minus its mean; the parts add up to score minus mean score."""
    terms = card.terms()
    means = df.agg(F.struct(*[F.avg(t).alias(n) for n, t in terms.items()]).alias("m"))
    work = df.withColumn("_mean", means.scalar())
    wide = work.select(key, *[(t - F.col(f"_mean.{n}")).alias(n) for n, t in terms.items()])
    return wide.unpivot([key], list(terms), "feature", "phi")


def level_attributions(df: DataFrame, card: Scorecard, key: str, column: str) -> DataFrame:
    """(key, level, phi) of the one-hot columns of one source feature."""
    weights = card.levels[column]
    flags = {level: F.lit(w) * (F.col(column) == level).cast("double") for level, w in weights.items()}
    means = df.agg(F.struct(*[F.avg(f).alias(n) for n, f in flags.items()]).alias("m"))
    work = df.withColumn("_mean", means.scalar())
    wide = work.select(key, *[(f - F.col("_mean").getField(n)).alias(n) for n, f in flags.items()])
    return wide.unpivot([key], list(flags), "level", "phi")


def global_importance(attributions: DataFrame, name: str = "feature") -> DataFrame:
    table = attributions.groupBy(name).agg(r6(F.avg(F.abs("phi"))).alias("mean_abs_phi"))
    return table.orderBy(F.col("mean_abs_phi").desc(), name)


def local_explanation(attributions: DataFrame, scores: DataFrame, key: str, score: str = "p") -> DataFrame:
    """Sorted contributions of the highest-scoring row; ties to the smallest key."""
    top = scores.agg(F.max_by(key, F.struct(F.col(score), -F.col(key)))).scalar()
    return attributions.filter(F.col(key) == top).orderBy(F.abs("phi").desc(), "feature")


def permuted(df: DataFrame, key: str, column: str, seed: int = 5) -> DataFrame:
    """Replace a column by its own values in another hash order: rank join, both sides spread over tasks."""
    def ranked(tag: int) -> DataFrame:
        work = df.withColumn("_h", hash_order(f"{seed}-{tag}", key))
        return ordered_state(work, [], ["_h", key], hash_bucket(F.col("_h")), rank="_rank").drop("_h")

    donor = ranked(1).select("_rank", F.col(column).alias("_new"))
    return ranked(0).drop(column).join(donor, "_rank").withColumnRenamed("_new", column).select(*df.columns)


def monotonicity(df: DataFrame, feature: str, bin_of: Column, score: str = "p") -> DataFrame:
    """Mean score per feature bin; a bin below its predecessor is a violation."""
    bins = df.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"), mean_score(F.col(score)).alias("mean_score"))
    step = F.col("mean_score") - F.lag("mean_score").over(Window.orderBy("bin"))
    return bins.select(
        F.lit(feature).alias("feature"), "bin", "n", "mean_score", F.coalesce(step < 0, F.lit(False)).alias("violation")
    )


def importance_stability(first: DataFrame, second: DataFrame, names: Sequence[str] = ("feature",)) -> DataFrame:
    """Spearman correlation of two importance tables."""
    both = first.withColumnRenamed("mean_abs_phi", "a").join(second.withColumnRenamed("mean_abs_phi", "b"), list(names))
    return spearman(both, "a", "b")
