"""Deterministic, leakage-safe row assignment. Order is a hash of the key, never a random draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket, hash_order, hash_unit
from ..functions.scalars import r6
from ..session import staged
from .ordered import HOT_ROWS, group_sizes, match_keys, ordered_state

SPLIT_NAMES = ("development", "validation", "test")


def stratum_rank(
    df: DataFrame,
    key: str,
    label: str | None = "y",
    order: Column | None = None,
    seed: int | str = 42,
    rank: str = "rn",
    total: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """1-based hash-order position of each row inside its label (or overall when label is None)."""
    work = df.withColumn("_h", hash_order(seed, key) if order is None else order)
    ranked = ordered_state(
        work, [label] if label else [], ["_h", key], hash_bucket(F.col("_h")), rank=rank, total=total, hot_rows=hot_rows
    )
    return ranked.drop("_h")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = "y",
    shares: Sequence[float] = (0.6, 0.8),
    names: Sequence[str] = SPLIT_NAMES,
    hot_rows: int = HOT_ROWS,
    **rank_args,
) -> DataFrame:
    """Exact class-preserving split: positions are cut at floor(n * share)."""
    ranked = stratum_rank(df, key, label, rank="_rn", total="_total", hot_rows=hot_rows, **rank_args)
    case = F.when(F.col("_rn") <= F.floor(F.col("_total") * shares[0]), names[0])
    for share, name in zip(shares[1:], names[1:]):
        case = case.when(F.col("_rn") <= F.floor(F.col("_total") * share), name)
    return ranked.withColumn("split", case.otherwise(names[len(shares)])).drop("_rn", "_total")


def class_cuts(df: DataFrame, key: str, label: str, shares: Sequence[float], order: Column) -> DataFrame:
    """(label, cut_0, cut_1, ...): the (hash, key) of the last row within floor(n * share) of each class; null where that is no row.

    Rows are counted by class and hash prefix, and only the rows of the prefixes that hold a cut are put in order.
    """
    rows = df.select(F.col(label).alias("_class"), order.alias("_h"), F.col(key).alias("_key"))
    cells = rows.groupBy("_class", hash_bucket(F.col("_h")).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_class")
    upto = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = cells.withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(whole)})
    targets = F.array(*[F.struct(F.lit(i).alias("cut"), F.floor(F.col("_total") * share).alias("last")) for i, share in enumerate(shares)])
    held = counted.select("*", F.explode(targets).alias("_t")).filter((F.col("_t.last") > F.col("_upto") - F.col("_n")) & (F.col("_t.last") <= F.col("_upto")))
    held = staged(held.select("_class", "_cell", "_t.cut", (F.col("_t.last") - F.col("_upto") + F.col("_n")).alias("place")), "cut-cells")  # a row per class and share
    near = match_keys(rows.withColumn("_cell", hash_bucket(F.col("_h"))), held, ["_class", "_cell"], "inner")
    near = near.withColumn("_rn", F.row_number().over(Window.partitionBy("_class", "cut").orderBy("_h", "_key"))).filter("_rn = place")
    at = F.struct(F.col("_h").alias("h"), F.col("_key").alias("key"))
    cuts = [F.max(F.when(F.col("cut") == i, at)).alias(f"cut_{i}") for i in range(len(shares))]
    classes = staged(near.groupBy("_class").agg(*cuts), "cuts")  # a written table has a known size, so it is broadcast while it is small
    return classes.withColumnRenamed("_class", label)


def split_at_cuts(
    df: DataFrame,
    key: str,
    label: str = "y",
    shares: Sequence[float] = (0.6, 0.8),
    names: Sequence[str] = SPLIT_NAMES,
    seed: int | str = 42,
) -> DataFrame:
    """The split of ``stratified_split`` for rows whose ``key`` is unique, by comparing each row with its class's cuts: rows are neither shuffled nor sorted.

    ``df`` is passed over three times, so it should be cheap to read. A class whose first cuts hold no row has none of their parts.
    """
    h = hash_order(seed, key)
    cuts = class_cuts(df, key, label, shares, h)
    rows = match_keys(df.withColumn("_at", F.struct(h.alias("h"), F.col(key).alias("key"))), cuts, [label])
    case = F.when(F.col("_at") <= F.col("cut_0"), names[0])
    for i, name in enumerate(names[1 : len(shares)], 1):
        case = case.when(F.col("_at") <= F.col(f"cut_{i}"), name)
    return rows.select(*df.columns, case.otherwise(names[len(shares)]).alias("split"))


def stratified_folds(df: DataFrame, key: str, k: int, label: str = "y", name: str = "fold",
                     hot_rows: int = HOT_ROWS, **rank_args) -> DataFrame:
    ranked = stratum_rank(df, key, label, rank="_rn", hot_rows=hot_rows, **rank_args)
    return ranked.withColumn(name, ((F.col("_rn") - 1) % k).cast("int")).drop("_rn")


def sample_quotas(df: DataFrame, n: int, label: str = "y") -> DataFrame:
    """Rows to take per class: round(share * n), the remainder to the largest class, capped at its size."""
    sizes = group_sizes(df, [label])
    whole = Window.partitionBy()
    biggest = whole.orderBy(F.col("_size").desc(), F.col(label))
    quota = F.round(F.col("_size") * float(n) / F.sum("_size").over(whole)).cast("bigint")
    parts = sizes.select(
        label,
        "_size",
        quota.alias("_quota"),
        F.row_number().over(biggest).alias("_place"),
        F.sum("_size").over(whole).alias("_all"),
    )
    fixed = F.col("_quota") + F.when(F.col("_place") == 1, F.lit(n) - F.sum("_quota").over(whole)).otherwise(0)
    taken = F.when(F.col("_all") <= n, F.col("_size")).otherwise(F.least(fixed, F.col("_size")))
    return parts.select(label, taken.cast("bigint").alias("quota"))


def stratified_sample(df: DataFrame, key: str, n: int, label: str = "y", hot_rows: int = HOT_ROWS, **rank_args) -> DataFrame:
    ranked = stratum_rank(df, key, label, rank="_rn", hot_rows=hot_rows, **rank_args)
    return (
        match_keys(ranked, sample_quotas(df, n, label), [label], "inner")
        .filter(F.col("_rn") <= F.col("quota"))
        .select(*df.columns)
    )


def entity_split(df: DataFrame, entity: str, share: float, seed: int | str = 42, name: str = "split") -> DataFrame:
    """All rows of an entity land on one side; no shuffle."""
    side = F.when(hash_unit(seed, entity) < share, "development").otherwise("validation")
    return df.withColumn(name, side)


def temporal_split(df: DataFrame, time: str, cut: str, name: str = "split") -> DataFrame:
    return df.withColumn(name, F.when(F.col(time) < F.lit(cut).cast("date"), "development").otherwise("validation"))


def rolling_origins(df: DataFrame, time: str, origins: Sequence[str], horizon_days: int) -> DataFrame:
    """Each row once per origin: training strictly before it, validation within the horizon after it."""
    days = F.array(*[F.lit(o).cast("date") for o in origins])
    rows = df.withColumn("origin", F.explode(days))
    side = F.when(F.col(time) < F.col("origin"), "train").when(
        F.col(time) < F.date_add("origin", horizon_days), "validate"
    )
    return rows.withColumn("part", side).filter(F.col("part").isNotNull())


def entity_time_split(df: DataFrame, entity: str, time: str, cut: str, share: float, seed: int | str = 42) -> DataFrame:
    """Known entities before the cut against new entities after it; the two mixed corners are dropped."""
    both = temporal_split(entity_split(df, entity, share, seed, "_entity_side"), time, cut, "_time_side")
    return (
        both.filter(F.col("_entity_side") == F.col("_time_side"))
        .withColumn("split", F.col("_entity_side"))
        .drop("_entity_side", "_time_side")
    )


def split_summary(df: DataFrame, label: str = "y", split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label).cast("bigint")).alias("positives"),
        r6(F.avg(label)).alias("positive_rate"),
    )


def entity_overlap(df: DataFrame, entity: str, split: str = "split") -> DataFrame:
    """Entities seen in more than one split, and the rows they hold."""
    per_entity = df.groupBy(entity, split).agg(F.count(F.lit(1)).alias("_rows"))
    spread = per_entity.groupBy(entity).agg(F.count(F.lit(1)).alias("_sides"), F.sum("_rows").alias("_rows"))
    shared = F.col("_sides") > 1
    return spread.agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(shared).alias("shared_entities"),
        F.coalesce(F.sum(F.when(shared, F.col("_rows"))), F.lit(0)).alias("rows_of_shared_entities"),
    )


def repeated_folds(df: DataFrame, key: str, k: int, repeats: int, label: str = "y", hot_rows: int = HOT_ROWS) -> DataFrame:
    """k folds under several shuffles: the repeat number salts the hash and joins the stratum."""
    rows = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn(
        "_h", hash_order(7, "repeat", key)
    )
    ranked = ordered_state(
        rows, ["repeat", label], ["_h", key], hash_bucket(F.col("_h")), rank="_rn", hot_rows=hot_rows
    )
    return ranked.withColumn("fold", ((F.col("_rn") - 1) % k).cast("int")).drop("_rn", "_h")


def nested_folds(df: DataFrame, key: str, outer: int, inner: int, label: str = "y") -> DataFrame:
    """(outer, inner) fold pairs: inner folds are drawn inside each outer training side."""
    outer_rows = stratified_folds(df, key, outer, label, name="own_fold", seed=42)
    rows = outer_rows.withColumn("outer_fold", F.explode(F.sequence(F.lit(0), F.lit(outer - 1)))).filter(
        F.col("outer_fold") != F.col("own_fold")
    )
    rows = rows.withColumn("_h", hash_order(11, "outer_fold", key))
    ranked = ordered_state(rows, ["outer_fold", label], ["_h", key], hash_bucket(F.col("_h")), rank="_rn")
    return ranked.withColumn("inner_fold", ((F.col("_rn") - 1) % inner).cast("int")).drop("_rn", "_h", "own_fold")
