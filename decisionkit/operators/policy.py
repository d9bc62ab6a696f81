"""From scores to decisions: thresholds, capacity, gain and cost sensitivity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import r6, ratio
from ..session import staged
from .metrics import FN_COST, FP_COST, confusion, decision_metrics, score_counts
from .ordered import ordered_state


def mark_selected(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Flag the cheapest threshold of each group; equal costs go to the lowest threshold."""
    order = Window.partitionBy(*by).orderBy("cost", "threshold")
    return table.withColumn("_place", F.row_number().over(order)).select(
        *table.columns, (F.col("_place") == 1).alias("selected")
    )


def best_threshold(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    best = F.min(F.struct("cost", "threshold"))
    return table.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.threshold", "_b.cost")


def cost_sensitivity(table: DataFrame, fn_costs: Sequence[float], fp_cost: float = FP_COST) -> DataFrame:
    """Re-select the threshold of a sweep under other false-negative costs."""
    costs = F.array(*[F.lit(float(c)) for c in fn_costs])
    priced = table.withColumn("fn_cost", F.explode(costs)).withColumn(
        "cost", F.col("fp") * F.lit(fp_cost) + F.col("fn") * F.col("fn_cost")
    )
    return best_threshold(priced, ["fn_cost"])


def score_cells(df: DataFrame, by: Sequence[str], label: str = "y", score: str = "p") -> DataFrame:
    """Distinct scores with their counts and the rows ranked above them."""
    counts = score_counts(df, by, label, score).withColumn("n", F.col("pos") + F.col("neg"))
    above = F.col("pos_all") + F.col("neg_all") - F.col("pos_before") - F.col("neg_before") - F.col("n")
    return counts.select(*by, "p", "pos", "neg", "n", above.alias("n_above"))


def top_k_flags(df: DataFrame, k: Column, key: str, label: str = "y", score: str = "p") -> DataFrame:
    """Exactly the k best-scored rows, ties by key, without ordering all rows in one task.

    Scores are collapsed to (score, count); every score that fits whole is taken, and only the rows of
    the one score at the cut are ordered, so the ordered part is the tie group, read with a top-k limit.
    """
    df = staged(df, "scores")
    cells = score_cells(df, [], label, score).withColumn("_k", k.cast("bigint"))
    cut = cells.filter((F.col("n_above") < F.col("_k")) & (F.col("n_above") + F.col("n") >= F.col("_k")))
    cut_score = cut.select(F.max("p")).scalar()
    room = cut.select(F.max(F.col("_k") - F.col("n_above"))).scalar()
    # No cut exists when k is 0 (nothing taken) or above the row count (everything taken).
    everything = k >= df.agg(F.count(F.lit(1))).scalar()
    work = df.withColumn("_cut", cut_score).withColumn("_room", room)
    at_cut = F.coalesce(F.col(score) == F.col("_cut"), F.lit(False))
    clear = work.filter(~at_cut).select(
        *df.columns, F.coalesce(F.col(score) > F.col("_cut"), everything).alias("taken")
    )
    tied = work.filter(at_cut)
    placed = ordered_state(with_tie_bucket(tied, key, "_tie"), by=[], order=[key], bucket=F.col("_tie"), rank="_place")
    return clear.unionByName(placed.select(*df.columns, (F.col("_place") <= F.col("_room")).alias("taken")))


def with_tie_bucket(df: DataFrame, key: str, name: str, buckets: int = 256) -> DataFrame:
    """Add ranges of a numeric key that hold about as many rows each: a monotone bucket for ordering it in many tasks."""
    points = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    cuts = df.agg(F.percentile_approx(key, F.expr(f"array({points})"), 16 * buckets)).scalar()
    work = df.withColumn("_cuts", cuts)
    return work.withColumn(name, F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(key))), F.lit(0))).drop("_cuts")


def top_k_metrics(flagged: DataFrame, label: str = "y") -> DataFrame:
    """precision@k, recall@k, lift@k of exactly the taken rows; recall is NULL without positives."""
    taken, pos = F.col("taken"), F.col(label) == 1
    counts = flagged.agg(
        F.count_if(taken).alias("k"),
        F.count_if(taken & pos).alias("hits"),
        F.count_if(pos).alias("positives"),
        F.count(F.lit(1)).alias("_n"),
    )
    precision = ratio(F.col("hits"), F.col("k"))
    return counts.select(
        "k",
        "hits",
        r6(precision).alias("precision_at_k"),
        r6(ratio(F.col("hits"), F.col("positives"))).alias("recall_at_k"),
        r6(precision / ratio(F.nullif(F.col("positives"), F.lit(0)), F.col("_n"))).alias("lift_at_k"),
    )


def capacity_policy(flagged: DataFrame, label: str = "y", fp_cost: float = FP_COST, fn_cost: float = FN_COST) -> DataFrame:
    """Confusion counts and metrics when exactly the taken rows are called."""
    scored = flagged.withColumn("_call", F.col("taken").cast("int"))
    return decision_metrics(confusion(scored, [], 1, label, "_call"), fp_cost=fp_cost, fn_cost=fn_cost)


def gain_table(df: DataFrame, by: Sequence[str], parts: int = 10, benefit: float = 5.0, call_cost: float = 1.0,
               label: str = "y", score: str = "p") -> DataFrame:
    """Cumulative gain, lift, profit and workload per score part.

    Rows with the same score stay together, in the part where their score begins.
    """
    cells = score_cells(df, by, label, score)
    whole = Window.partitionBy(*by)
    placed = cells.select(
        *by,
        "n",
        "pos",
        (F.floor(F.col("n_above") * parts / F.sum("n").over(whole)) + 1).cast("int").alias("part"),
    )
    table = placed.groupBy(*by, "part").agg(F.sum("n").alias("n"), F.sum("pos").alias("positives"))
    upto = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = table.select(
        *by, "part", "n", "positives",
        F.sum("n").over(upto).alias("workload"),
        F.sum("positives").over(upto).alias("captured"),
        F.sum("n").over(whole).alias("_n"),
        F.sum("positives").over(whole).alias("_pos"),
    )
    gain = ratio(F.col("captured"), F.col("_pos"))
    spent = F.col("workload") * call_cost
    profit = F.col("captured") * benefit - spent
    return sums.select(
        *by, "part", "n", "positives", "workload", "captured",
        r6(gain).alias("gain"),
        r6(gain / ratio(F.col("workload"), F.col("_n"))).alias("lift"),
        profit.cast("double").alias("profit"),
        r6(ratio(profit, spent)).alias("roi"),
    )
