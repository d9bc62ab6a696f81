"""Ordered running state inside groups of any size.

A plain ``Window.partitionBy(key)`` puts a whole group into one task. Here groups above ``hot_rows``
are cut into buckets of their own order (a hash prefix, a day, ...): one small aggregate per bucket,
a running state over those few buckets, and a window inside each bucket. Groups below the limit keep
the single plain window, so the extra work is one counting aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on equally named keys where NULL matches NULL; the left side's keys are kept."""
    if not keys:
        raise ValueError("match_keys needs at least one key")
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def group_sizes(df: DataFrame, by: Sequence[str], name: str = "_size") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def hot_groups(df: DataFrame, by: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows. Their number is bounded by rows / hot_rows, so they are broadcast: a shuffle by so few keys would bring a whole group into one task."""
    return F.broadcast(group_sizes(df, by).filter(F.col("_size") > hot_rows))


def ordered_state(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    *,
    rank: str | None = None,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    total: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add, for every row, what its group looked like strictly before it in ``order``.

    rank   1-based position of the row in its group
    sums   running sum of an expression over the earlier rows (0 when there are none)
    lasts  latest non-NULL value of an expression among the earlier rows
    total  rows in the whole group
    bucket must be a non-negative integer that never decreases along ``order``.
    """
    sums, lasts = dict(sums or {}), dict(lasts or {})
    order_cols = [F.col(c) for c in order]
    work = df.select(
        "*",
        *[F.coalesce(e, F.lit(0)).alias(f"_s_{n}") for n, e in sums.items()],
        *[e.alias(f"_l_{n}") for n, e in lasts.items()],
        bucket.cast("bigint").alias("_order_bucket"),
    )
    if by:
        work = match_keys(work, hot_groups(df, by, hot_rows), by)
        hot = F.col("_size").isNotNull()
        work = work.withColumn("_bucket", F.when(hot, F.col("_order_bucket")).otherwise(F.lit(-1)))
        hot_part = work.filter(hot)
    else:
        work = work.withColumn("_bucket", F.col("_order_bucket"))
        hot_part = work

    order_key = F.struct(*order_cols)
    per_bucket = hot_part.groupBy(*by, "_bucket").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_s_{n}").alias(f"_b_{n}") for n in sums],
        *[
            F.max_by(f"_l_{n}", F.when(F.col(f"_l_{n}").isNotNull(), order_key)).alias(f"_b_{n}")
            for n in lasts
        ],
    )
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(
        *by,
        "_bucket",
        F.sum("_n").over(before).alias("_c_rank"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_c_total"),
        *[F.sum(f"_b_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_b_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in lasts],
    )
    keys = [*by, "_bucket"]
    joined = match_keys(work, carried, keys)
    inside = Window.partitionBy(*keys).orderBy(*order_cols)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    added = []
    if rank:
        added.append((F.row_number().over(inside) + F.coalesce("_c_rank", F.lit(0))).cast("bigint").alias(rank))
    for n in sums:
        here = F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0))
        added.append((here + F.coalesce(f"_c_{n}", F.lit(0))).alias(n))
    for n in lasts:
        here = F.last(f"_l_{n}", ignorenulls=True).over(earlier)
        added.append(F.coalesce(here, F.col(f"_c_{n}")).alias(n))
    if total:
        # A hot group's size comes from its buckets; any other group is whole inside its window.
        added.append(F.coalesce("_c_total", F.count(F.lit(1)).over(Window.partitionBy(*keys))).alias(total))
    return joined.select(*df.columns, *added)
