"""Asset catalog rows and data dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..operators.sketches import HLL_BITS, distinct_bound


def asset_row(df: DataFrame, facts: Mapping[str, str]) -> DataFrame:
    """One row of catalog metadata with the measured row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        *[F.lit(v).alias(k) for k, v in facts.items()], "rows", F.lit(len(df.columns)).cast("bigint").alias("columns")
    )


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) over all columns: one shuffle, partial counts on the map side."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        text.unpivot([], list(columns), "feature", "value").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def data_dictionary(df: DataFrame, roles: Mapping[str, str], available: Mapping[str, bool]) -> DataFrame:
    """Per column: role, type, missing count and share, distinct values, availability, an example."""
    columns = list(roles)
    types = dict(df.dtypes)
    facts = F.create_map(
        *[
            x
            for c in columns
            for x in (
                F.lit(c),
                F.struct(
                    F.lit(roles[c]).alias("role"),
                    F.lit(types[c]).alias("dtype"),
                    F.lit(available.get(c, False)).alias("available_at_prediction"),
                ),
            )
        ]
    )
    profile = level_counts(df, columns).groupBy("feature").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.sum("n").alias("_rows"),
        F.count("value").alias("distinct_values"),
        F.min("value").alias("example"),
    )
    fact = facts[F.col("feature")]
    return profile.select(
        "feature",
        fact["role"].alias("role"),
        fact["dtype"].alias("dtype"),
        "missing",
        r6(100.0 * F.col("missing") / F.col("_rows")).alias("missing_pct"),
        "distinct_values",
        fact["available_at_prediction"].alias("available_at_prediction"),
        "example",
    )


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct levels per column, ascending. The approximate form keeps one sketch per column and task instead of the
    values, and says between which bounds the exact count lies."""
    if approximate:
        counts = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_BITS))).alias(c) for c in columns])
        table, bound = counts.unpivot([], list(columns), "feature", "levels"), distinct_bound()
        low, high = F.floor(F.col("levels") / (1 + bound)), F.ceil(F.col("levels") / (1 - bound))
        return table.select("feature", "levels", low.alias("low"), high.alias("high"), F.lit(bound).alias("relative_error")).orderBy("levels", "feature")
    levels = level_counts(df, columns).groupBy("feature").agg(F.count("value").alias("levels"))
    return levels.orderBy("levels", "feature")
