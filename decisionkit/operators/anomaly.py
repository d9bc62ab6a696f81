"""Anomaly ranking: local density in novelty mode, isolation forest, alert evaluation."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_fraction, hash_long
from ..functions.scalars import r6, ratio
from ..session import staged
from .neighbors import knn_join, neighbour_rows

SAMPLE = 256


def scale_columns(train: DataFrame, columns: Sequence[str]) -> Column:
    """Scalar struct of mean and population SD per column, fitted on the training rows."""
    parts = []
    for c in columns:
        sd = F.stddev_pop(c)
        parts += [F.avg(c).alias(f"{c}_mean"), F.when(sd == 0, 1.0).otherwise(sd).alias(f"{c}_sd")]
    return train.agg(F.struct(*parts).alias("s")).scalar()


def scaled_vector(df: DataFrame, train: DataFrame, columns: Sequence[str], name: str = "vector") -> DataFrame:
    work = df.withColumn("_scale", scale_columns(train, columns))
    z = [F.round((F.col(c) - F.col(f"_scale.{c}_mean")) / F.col(f"_scale.{c}_sd"), 9) for c in columns]
    return work.withColumn(name, F.array(*z)).drop("_scale")


def local_outlier_factor(reference: DataFrame, new: DataFrame, k: int, key: str = "id", vector: str = "vector", **knn) -> DataFrame:
    """LOF of new rows against the density of the reference rows only (novelty mode)."""
    around = staged(neighbour_rows(knn_join(reference, reference, k, key, vector, exclude_self=True, **knn), key), "lof")
    k_distance = around.groupBy(key).agg(F.max("distance").alias("k_distance"))

    def density(edges: DataFrame) -> DataFrame:
        limits = k_distance.select(F.col(key).alias("neighbour"), "k_distance")
        reach = F.greatest("distance", "k_distance")
        return edges.join(limits, "neighbour").groupBy(key).agg((1.0 / (F.avg(reach) + 1e-10)).alias("lrd"))

    known = density(around).select(F.col(key).alias("neighbour"), F.col("lrd").alias("neighbour_lrd"))
    edges = staged(neighbour_rows(knn_join(new, reference, k, key, vector, **knn), key), "lof")
    own = density(edges)
    ratios = edges.join(known, "neighbour").groupBy(key).agg(F.avg("neighbour_lrd").alias("around_lrd"))
    return ratios.join(own, key).select(key, r6(F.col("around_lrd") / F.col("lrd")).alias("score"))


def _average_path(n: np.ndarray | float) -> np.ndarray:
    n = np.asarray(n, dtype=np.float64)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    safe = np.where(big, n, 3.0)
    return np.where(big, 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe, out)


def _grow(sample: np.ndarray, seed: int) -> list[tuple]:
    """Node rows of one isolation tree over at most SAMPLE rows: (node, feature, cut, left, right, path)."""
    rng = np.random.default_rng(seed)
    limit = math.ceil(math.log2(max(len(sample), 2)))
    nodes, stack = [], [(0, sample, 0)]
    used = 1
    while stack:
        node, rows, depth = stack.pop()
        low, high = rows.min(0), rows.max(0)
        movable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(movable):
            nodes.append((node, -1, 0.0, -1, -1, depth + float(_average_path(len(rows)))))
            continue
        feature = int(rng.choice(movable))
        cut = float(rng.uniform(low[feature], high[feature]))
        side = rows[:, feature] <= cut
        nodes.append((node, feature, cut, used, used + 1, 0.0))
        stack += [(used, rows[side], depth + 1), (used + 1, rows[~side], depth + 1)]
        used += 2
    return nodes


def fit_isolation_forest(train: DataFrame, trees: int, key: str = "id", vector: str = "vector", seed: int = 42) -> DataFrame:
    """Node table (tree, node, feature, cut, left, right, path); each tree sees at most SAMPLE hash-chosen rows of the whole table.

    A row meets each tree with probability ``wanted / n``. Where that makes fewer meetings than rows, one hash thins the rows to those that
    meet any tree, and a second one tells which; so only the chosen rows are copied or shuffled.
    """
    wanted = 1.5 * SAMPLE
    rows = train.select(key, vector)
    n = max(rows.count(), 1)
    if trees * wanted < n:
        kept = rows.filter(hash_fraction(seed, key) < trees * wanted / n)
        drawn = kept.withColumn("tree", (hash_long(seed + 2, key) % trees).cast("int")).withColumn("_u", hash_fraction(seed + 1, key))
    else:
        drawn = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        drawn = drawn.withColumn("_u", hash_fraction(seed + 1, "tree", key)).filter(F.col("_u") * n < wanted)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        chosen = pdf.sort_values(["_u", key]).head(SAMPLE)
        tree = int(chosen["tree"].iloc[0])
        nodes = _grow(np.stack(chosen[vector].to_numpy()), seed * 100_003 + tree)
        out = pd.DataFrame(nodes, columns=["node", "feature", "cut", "left", "right", "path"])
        out.insert(0, "tree", tree)
        out["sample"] = len(chosen)
        return out

    return drawn.groupBy("tree").applyInPandas(
        build, "tree int, node int, feature int, cut double, left int, right int, path double, sample int"
    )


def score_isolation_forest(df: DataFrame, nodes: DataFrame, key: str = "id", vector: str = "vector") -> DataFrame:
    """Larger = easier to isolate; 0 is the usual boundary. The node table is bounded by trees * 511 rows."""
    table = nodes.orderBy("tree", "node").toPandas()
    trees = [g.sort_values("node") for _, g in table.groupby("tree")]
    arrays = [{c: g[c].to_numpy() for c in ("feature", "cut", "left", "right", "path")} for g in trees]
    scale = float(_average_path(table.groupby("tree")["sample"].first().mean()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf[vector].to_numpy())
            total = np.zeros(len(x))
            for t in arrays:
                at = np.zeros(len(x), dtype=np.int64)
                open_rows = np.arange(len(x))
                while len(open_rows):
                    feature = t["feature"][at[open_rows]]
                    open_rows = open_rows[feature >= 0]
                    node = at[open_rows]
                    feature = t["feature"][node]
                    left = x[open_rows, feature] <= t["cut"][node]
                    at[open_rows] = np.where(left, t["left"][node], t["right"][node])
                total += t["path"][at]
            score = np.power(2.0, -(total / len(arrays)) / scale) - 0.5
            yield pd.DataFrame({key: pdf[key], "score": score})

    return df.select(key, vector).mapInPandas(run, f"{key} bigint, score double")


def alert_volume(df: DataFrame, window: Column, alert: Column, actionable: Column) -> DataFrame:
    """Alerts per window, their share of the volume, and how many led to action."""
    return df.groupBy(window.alias("window")).agg(
        F.count(F.lit(1)).alias("volume"),
        F.count_if(alert).alias("alerts"),
        r6(ratio(F.count_if(alert), F.count(F.lit(1)))).alias("alert_rate"),
        r6(ratio(F.count_if(alert & actionable), F.count_if(alert))).alias("actionable_share"),
    )
