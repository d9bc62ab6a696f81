"""Class weights, under- and oversampling, synthetic minority rows and their audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_fraction, hash_long
from ..session import staged
from .neighbors import knn_join
from .ordered import HOT_ROWS, group_sizes, match_keys
from .splits import stratum_rank


def balanced_weights(df: DataFrame, label: str = "y", name: str = "weight") -> DataFrame:
    """n / (classes * n_c) on every row."""
    whole = Window.partitionBy()  # over the few classes, after one aggregate of the rows
    share = F.sum("_n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("_n").cast("double"))
    state = group_sizes(df, [label], "_n").select(label, share.alias(name))
    return match_keys(df, F.broadcast(state), [label])  # one row per class


def class_size(df: DataFrame, value: int, label: str = "y") -> F.Column:
    return df.agg(F.count_if(F.col(label) == value)).scalar()


def undersample(df: DataFrame, key: str, label: str = "y", minority: int = 1, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All minority rows and as many majority rows, in hash order."""
    ranked = stratum_rank(df, key, label, seed=17, rank="_rn", hot_rows=hot_rows)
    keep = (F.col(label) == minority) | (F.col("_rn") <= class_size(df, minority, label))
    return ranked.filter(keep).drop("_rn")


def synthetic_slots(df: DataFrame, key: str, label: str = "y", minority: int = 1, seed: int = 23, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(slot, base_rank): one slot per surplus majority row, each pointing at a hash-chosen minority rank."""
    small = class_size(df, minority, label)
    majority = df.filter(F.col(label) != minority).select(key)
    ranked = stratum_rank(majority, key, None, seed=17, rank="_rn", hot_rows=hot_rows)
    surplus = ranked.withColumn("_small", small).filter(F.col("_rn") > F.col("_small"))
    base = hash_long(seed, key) % F.col("_small") + 1
    return surplus.select(F.col(key).alias("slot"), base.alias("base_rank"))


def minority_ranks(df: DataFrame, key: str, label: str = "y", minority: int = 1, hot_rows: int = HOT_ROWS) -> DataFrame:
    rows = df.filter(F.col(label) == minority)
    return stratum_rank(rows, key, None, seed=19, rank="base_rank", hot_rows=hot_rows)


def oversample_copies(df: DataFrame, key: str, label: str = "y", minority: int = 1, hot_rows: int = HOT_ROWS) -> DataFrame:
    """How often each row is used: majority rows once, minority rows 1 + drawn copies.

    The count can be used as a weight; ``repeat_rows`` makes real copies when they are asked for.
    """
    drawn = synthetic_slots(df, key, label, minority, hot_rows=hot_rows).groupBy("base_rank").agg(F.count(F.lit(1)).alias("_drawn"))
    small = minority_ranks(df, key, label, minority, hot_rows).join(drawn, "base_rank", "left")
    copies = small.select(*df.columns, (1 + F.coalesce("_drawn", F.lit(0))).alias("copies"))
    return df.filter(F.col(label) != minority).withColumn("copies", F.lit(1).cast("bigint")).unionByName(copies)


def repeat_rows(df: DataFrame, copies: str = "copies") -> DataFrame:
    return df.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies)))).drop(copies)


def smote(
    df: DataFrame,
    key: str,
    vector: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    k: int = 5,
    label: str = "y",
    minority: int = 1,
    hot_rows: int = HOT_ROWS,
    **knn,
) -> DataFrame:
    """Synthetic minority rows up to parity: (slot, base, neighbour, numeric..., categorical...).

    Numbers lie between the base row and one of its k nearest minority rows; a category is the most
    frequent one among the neighbours, ties to the smallest level.
    """
    small = minority_ranks(df, key, label, minority, hot_rows).select(key, "base_rank", vector, *numeric, *categorical)
    small = staged(small, "minority")
    around = knn_join(small, small, k, key, vector, exclude_self=True, **knn).select(key, "neighbours")
    slots = synthetic_slots(df, key, label, minority, hot_rows=hot_rows)
    base = staged(small.join(around, key).drop(vector), "neighbours")
    pick = F.col("neighbours")[(hash_long(29, "slot") % F.size("neighbours")).cast("int")]["id"]
    chosen = slots.join(base, "base_rank").withColumn("neighbour", pick).withColumn("_u", hash_fraction(31, "slot"))
    other = small.select(F.col(key).alias("neighbour"), *[F.col(c).alias(f"_o_{c}") for c in numeric])
    mixed = chosen.join(other, "neighbour")
    numbers = [(F.col(c) + F.col("_u") * (F.col(f"_o_{c}") - F.col(c))).cast("double").alias(c) for c in numeric]
    rows = mixed.select("slot", F.col(key).alias("base"), "neighbour", *numbers)
    for c in categorical:
        rows = match_keys(rows, neighbour_modes(base, small, key, c).withColumnRenamed(key, "base"), ["base"])
    return rows


def neighbour_modes(base: DataFrame, levels: DataFrame, key: str, column: str) -> DataFrame:
    """Most frequent level among each row's neighbours: at most k values per row."""
    votes = base.select(key, F.explode("neighbours").alias("_n")).select(key, F.col("_n.id").alias("_id"))
    named = votes.join(levels.select(F.col(key).alias("_id"), column), "_id")
    counts = named.groupBy(key, column).agg(F.count(F.lit(1)).alias("_c"))
    best = F.min(F.struct((-F.col("_c")).alias("neg"), F.col(column).alias("level")))
    return counts.groupBy(key).agg(best["level"].alias(column))


def mixed_vector(df: DataFrame, train: DataFrame, numeric: Sequence[str], levels: Mapping[str, Sequence[str]], name: str = "vector") -> DataFrame:
    """Numbers as they are and one column per level, so that two different levels add the square of the
    median numeric SD of the training rows to the squared distance."""
    sds = train.agg(F.array(*[F.stddev_samp(c) for c in numeric]).alias("s"))
    sorted_sds = F.array_sort("s")
    middle = len(numeric) // 2
    median = sorted_sds[middle] if len(numeric) % 2 else (sorted_sds[middle - 1] + sorted_sds[middle]) / 2
    work = df.withColumn("_penalty", sds.select(median).scalar() / F.sqrt(F.lit(2.0)))
    flags = [F.when(F.col(c) == v, F.col("_penalty")).otherwise(0.0) for c, vs in levels.items() for v in vs]
    return work.withColumn(name, F.array(*[F.col(c).cast("double") for c in numeric], *flags)).drop("_penalty")
