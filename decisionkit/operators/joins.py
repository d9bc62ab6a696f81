"""Joins of predictions with outcomes, history and vocabularies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import HOT_ROWS, ordered_state


def delayed_labels(predictions: DataFrame, outcomes: DataFrame, key: str = "prediction_id") -> DataFrame:
    """Predictions with their outcome where it has arrived. AQE picks broadcast or sort-merge by size."""
    return predictions.join(outcomes, key, "left")


def as_of_join(
    decisions: DataFrame,
    history: DataFrame,
    by: str,
    time: str,
    key: str,
    history_columns: Sequence[str],
    bucket: Column,
    name: str = "latest",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Latest history row strictly before each decision, NULL where there is none.

    Both sides are stacked and carried forward in time order: one ordered pass instead of a range join.
    At equal times the decision comes first, so that a simultaneous history row is not seen.
    """
    seen = F.struct(F.col(time).alias("time"), *[F.col(c) for c in history_columns])
    empty = F.lit(None).cast(history.select(seen.alias("s")).schema["s"].dataType)
    own = [c for c in decisions.columns if c not in (by, time, key)]
    stacked = decisions.select(by, time, F.col(key).alias("_id"), F.lit(0).alias("_side"), F.struct(*own, F.col(key)).alias("_row"), empty.alias("_seen"))
    blank = F.lit(None).cast(stacked.schema["_row"].dataType)
    stacked = stacked.unionByName(
        history.select(by, time, F.col(key).alias("_id"), F.lit(1).alias("_side"), blank.alias("_row"), seen.alias("_seen"))
    )
    carried = ordered_state(
        stacked, [by], [time, "_side", "_id"], bucket, lasts={name: F.col("_seen")}, hot_rows=hot_rows
    )
    return carried.filter("_side = 0").select(by, time, "_row.*", name)


def in_vocabulary(df: DataFrame, vocabulary: DataFrame, column: str) -> DataFrame:
    return df.join(vocabulary.select(column), column, "left_semi")


def outside_vocabulary(df: DataFrame, vocabulary: DataFrame, column: str) -> DataFrame:
    return df.join(vocabulary.select(column), column, "left_anti")


def align_scores(long: DataFrame, key: Sequence[str], models: Sequence[str], model: str = "model", score: str = "p") -> DataFrame:
    """One column per model, aligned on the key."""
    return long.groupBy(*key).pivot(model, list(models)).agg(F.max(score))
