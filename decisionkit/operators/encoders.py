"""Fold-safe encoders. Fitting is one aggregate that gives a state table per held-out fold; applying is a join.

A row with fold f is training data for every held-out fold except f, so no row sees its own label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket
from ..session import staged
from .ordered import HOT_ROWS, match_keys, ordered_state
from .quantiles import exact_quantiles

INFREQUENT = "__infrequent__"


def training_copies(df: DataFrame, folds: int, fold: str = "fold", held: str = "held") -> DataFrame:
    """Each row once per held-out fold it may train for; partial aggregates collapse the copies map-side."""
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda k: k != F.col(fold))
    return df.withColumn(held, F.explode(others))


def apply_state(df: DataFrame, state: DataFrame, keys: Sequence[str] = (), fold: str = "fold", held: str = "held") -> DataFrame:
    """Join the state fitted without a row's own fold. State without keys is one row per fold."""
    renamed = state.withColumnRenamed(held, fold)
    return match_keys(df, renamed if keys else F.broadcast(renamed), [fold, *keys])


def fit_medians(df: DataFrame, column: str, folds: int) -> DataFrame:
    """Rows collapse to distinct values of each fold first; only these are copied to the held-out folds."""
    cells = staged(df.groupBy("fold", column).agg(F.count(F.lit(1)).alias("n")), "cells")
    copies = training_copies(cells, folds)
    return exact_quantiles(copies, ["held"], column, [0.5], weight="n").select("held", F.col("quantiles")[0].alias("median"))


def impute_median(df: DataFrame, column: str, folds: int) -> DataFrame:
    df = staged(df, "folds")  # read by the fit and by the imputation; folds are drawn once
    filled = apply_state(df, fit_medians(df, column, folds))
    return filled.withColumn(column, F.coalesce(F.col(column).cast("double"), F.col("median"))).drop("median")


def fit_modes(df: DataFrame, column: str, folds: int) -> DataFrame:
    """Most frequent training level per held-out fold; ties go to the smallest level."""
    counts = fold_level_counts(df.filter(F.col(column).isNotNull()), column, folds).filter("n > 0")
    best = F.min(F.struct((-F.col("n")).alias("_neg"), F.col(column)))
    return counts.groupBy("held").agg(best[column].alias("mode"))


def impute_mode(df: DataFrame, column: str, folds: int) -> DataFrame:
    filled = apply_state(df, fit_modes(df, column, folds))
    return filled.withColumn(column, F.coalesce(column, "mode")).drop("mode")


def fit_scale(df: DataFrame, column: str, folds: int) -> DataFrame:
    copies = training_copies(df.select("fold", column), folds)
    sd = F.stddev_pop(column)
    return copies.groupBy("held").agg(F.avg(column).alias("mean"), F.when(sd == 0, 1.0).otherwise(sd).alias("sd"))


def standardise(df: DataFrame, column: str, folds: int) -> DataFrame:
    scaled = apply_state(df, fit_scale(df, column, folds))
    return scaled.withColumn(column, (F.col(column) - F.col("mean")) / F.col("sd")).drop("mean", "sd")


def fold_level_counts(df: DataFrame, level: str, folds: int, label: str | None = None) -> DataFrame:
    """(held, level, n[, positives]) as total minus own fold: one shuffle on the level."""
    def held(k: int, value: Column) -> Column:
        return F.sum(F.when(F.col("fold") != k, value).otherwise(0))

    fields = []
    for k in range(folds):
        parts = [F.lit(k).alias("held"), held(k, F.lit(1)).alias("n")]
        if label:
            parts.append(held(k, F.col(label)).alias("positives"))
        fields.append(F.struct(*parts))
    state = df.groupBy(level).agg(F.array(*fields).alias("_states"))
    return state.select(level, F.inline("_states"))


def fit_one_hot(df: DataFrame, column: str, folds: int, min_frequency: int | None = None) -> DataFrame:
    """(held, level, encoded): rare levels share one bucket."""
    counts = fold_level_counts(df.filter(F.col(column).isNotNull()), column, folds).filter("n > 0")
    if min_frequency is None:
        return counts.withColumn("encoded", F.col(column))
    rare = F.col("n") < min_frequency
    return counts.withColumn("encoded", F.when(rare, F.lit(INFREQUENT)).otherwise(F.col(column)))


def one_hot(df: DataFrame, column: str, folds: int, min_frequency: int | None = None) -> DataFrame:
    """The level that is 1 for each row; NULL means all zeros (unseen level and no rare bucket)."""
    state = fit_one_hot(df, column, folds, min_frequency)
    rows = apply_state(df, state.drop("n"), [column])
    if min_frequency is None:
        return rows
    buckets = state.groupBy("held").agg(F.max(F.col("encoded") == INFREQUENT).alias("_bucket"))
    rows = apply_state(rows, buckets)
    unseen = F.when(F.col("_bucket"), F.lit(INFREQUENT))
    return rows.withColumn("encoded", F.coalesce("encoded", unseen)).drop("_bucket")


def ordered_target_statistic(
    df: DataFrame,
    category: str,
    label: str,
    order: Sequence[str],
    weight: float = 2.0,
    prior: float = 0.5,
    bucket: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(earlier positives + a * prior) / (earlier rows + a), only rows earlier in the permutation."""
    state = ordered_state(
        df,
        [category],
        order,
        hash_bucket(F.col(order[0])) if bucket is None else bucket,
        rank="_rank",
        sums={"_positives": F.col(label)},
        hot_rows=hot_rows,
    )
    seen = F.col("_rank") - 1
    return state.select(
        *df.columns,
        seen.alias("earlier_rows"),
        ((F.col("_positives") + weight * prior) / (seen + weight)).alias("ordered_stat"),
    )


def fit_target_statistic(train: DataFrame, category: str, label: str, weight: float = 2.0, prior: float = 0.5) -> DataFrame:
    """The statistic for new rows: the whole training history of a level."""
    return train.groupBy(category).agg(
        ((F.sum(label) + weight * prior) / (F.count(label) + weight)).alias("target_stat")
    )


def apply_target_statistic(df: DataFrame, state: DataFrame, category: str, prior: float = 0.5) -> DataFrame:
    joined = match_keys(df, state, [category])
    return joined.withColumn("target_stat", F.coalesce("target_stat", F.lit(prior)))


def out_of_fold_target(df: DataFrame, category: str, label: str, folds: int) -> DataFrame:
    """Mean label of the other folds; NULL where a level has no row outside its own fold."""
    counts = fold_level_counts(df, category, folds, label)
    mean = F.col("positives") / F.nullif(F.col("n").cast("double"), F.lit(0.0))
    state = counts.select("held", category, mean.alias("oof_mean"))
    return apply_state(df, state, [category])


def with_text_bucket(levels: DataFrame, column: str, name: str, cuts: int = 255) -> DataFrame:
    """Add a monotone bucket of text order: how many of a few hash-drawn levels are not above the text.

    The draw only decides where the order is cut, so shared prefixes do no harm and the result never depends on it.
    """
    drawn = levels.filter(F.col(column).isNotNull()).orderBy(F.xxhash64(column), column).limit(cuts)
    points = drawn.agg(F.array_sort(F.collect_list(column))).scalar()
    work = levels.withColumn("_points", points)
    return work.withColumn(name, F.size(F.filter("_points", lambda c: c <= F.col(column)))).drop("_points")


def fit_ordinal(train: DataFrame, column: str) -> DataFrame:
    """Index of each level in the sorted vocabulary; ordered in ranges between drawn levels."""
    levels = train.filter(F.col(column).isNotNull()).select(column).distinct()
    ranked = ordered_state(with_text_bucket(levels, column, "_text"), [], [column], F.col("_text"), rank="_rank")
    return ranked.select(column, (F.col("_rank") - 1).alias("code"))


def apply_ordinal(df: DataFrame, state: DataFrame, column: str) -> DataFrame:
    return match_keys(df, state, [column]).withColumn("code", F.coalesce("code", F.lit(-1).cast("bigint")))


def encoded_names(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], min_frequency: int = 10) -> DataFrame:
    """(source, level, feature, position): names carry the branch that made them."""
    from ..sources.catalog import level_counts

    counts = level_counts(df, categorical).filter(F.col("value").isNotNull())
    level = F.when(F.col("n") < min_frequency, F.lit(INFREQUENT)).otherwise(F.col("value"))
    encoded = counts.select(F.col("feature").alias("source"), level.alias("level")).distinct()
    encoded = encoded.select("source", "level", F.concat_ws("_", F.concat(F.lit("categorical__"), "source"), "level").alias("feature"))
    plain = F.array(
        *[
            F.struct(
                F.lit(c).alias("source"), F.lit(None).cast("string").alias("level"), F.lit(f"numeric__{c}").alias("feature")
            )
            for c in numeric
        ]
    )
    numbers = df.agg(F.count(F.lit(1)).alias("_n")).select(F.inline(plain))
    names = encoded.unionByName(numbers)
    sources = F.create_map(*[x for i, c in enumerate(sorted({*numeric, *categorical})) for x in (F.lit(c), F.lit(i))])
    group = F.when(F.col("level").isNull(), 0).otherwise(len(numeric) + len(categorical)) + sources[F.col("source")]
    work = names.withColumns({"_group": group, "_level": F.coalesce("level", F.lit(""))})
    work = with_text_bucket(work, "_level", "_text")
    bucket = F.col("_group").cast("bigint") * F.lit(2**20) + F.col("_text")
    ranked = ordered_state(work, [], ["_group", "_level"], bucket, rank="_rank")
    return ranked.select("source", "level", "feature", (F.col("_rank") - 1).alias("position"))


def missing_indicator(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(f"{column}_missing", F.col(column).isNull().cast("int"))


def tokens(text: str) -> Column:
    """Lower-case runs of letters."""
    return F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}]+"), lambda t: t != "")


def tf_idf(df: DataFrame, key: str, text: str, vocabulary_size: int) -> DataFrame:
    """(key, term, tf, tfidf) for the most widely used terms; whole texts, counted with partial aggregates."""
    words = tokens(text)
    vocabulary = (
        df.select(F.explode(F.array_distinct(words)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .orderBy(F.col("df").desc(), "term")
        .limit(vocabulary_size)
    )
    n = df.agg(F.count(F.lit(1))).scalar()
    idf = F.ln((n + 1.0) / (F.col("df") + 1.0)) + 1.0
    # At most vocabulary_size rows; other words are dropped before anything is shuffled.
    known = df.select(key, F.explode(words).alias("term")).join(F.broadcast(vocabulary), "term")
    counted = known.groupBy(key, "term", "df").agg(F.count(F.lit(1)).alias("tf"))
    return counted.select(key, "term", "tf", (F.col("tf") * idf).alias("tfidf"))


def vector_norm(vector: str) -> Column:
    squares = F.aggregate(F.col(vector), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def vector_dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def centroid(df: DataFrame, vector: str, dimensions: int) -> Column:
    """Mean vector as a scalar subquery: one aggregate per dimension, no exploding."""
    means = df.agg(F.array(*[F.avg(F.col(vector)[i].cast("double")) for i in range(dimensions)]).alias("c"))
    return means.scalar()
