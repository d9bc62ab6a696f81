"""Probability, ranking and decision metrics as grouped aggregates.

Every function takes the grouping columns first, so the same plan serves one model, a model per fold,
or a slice of the population.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import r6, ratio, ratio_or_zero, row_brier, row_log_loss
from .ordered import match_keys
from .quantiles import ordered_distinct

FP_COST, FN_COST = 1.0, 5.0
METRIC_COLUMNS = [
    "accuracy", "precision", "recall", "specificity", "f1", "balanced_accuracy", "cost",
]


def confusion(df: DataFrame, by: Sequence[str], threshold: Column | float, label: str = "y", score: str = "p") -> DataFrame:
    """tn, fp, fn, tp per group; a row is called positive when score >= threshold."""
    hit = F.col(score) >= (threshold if isinstance(threshold, Column) else F.lit(threshold))
    pos = F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(~hit & ~pos).alias("tn"),
        F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
        F.count_if(hit & pos).alias("tp"),
    )


def decision_columns(fp_cost: float | Column = FP_COST, fn_cost: float | Column = FN_COST) -> dict[str, Column]:
    """Metrics of a frame that has tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    recall, specificity = ratio(tp, tp + fn), ratio(tn, tn + fp)
    return {
        "accuracy": r6(ratio(tp + tn, tp + tn + fp + fn)),
        "precision": r6(ratio_or_zero(tp, tp + fp)),
        "recall": r6(ratio_or_zero(tp, tp + fn)),
        "specificity": r6(specificity),
        "f1": r6(ratio_or_zero(2 * tp, 2 * tp + fp + fn)),
        "balanced_accuracy": r6((F.coalesce(recall, specificity) + F.coalesce(specificity, recall)) / 2),
        "cost": (fp * fp_cost + fn * fn_cost).cast("double"),
    }


def decision_metrics(counts: DataFrame, keep: Sequence[str] = (), **costs: float | Column) -> DataFrame:
    return counts.select(*keep, "tn", "fp", "fn", "tp", *[c.alias(n) for n, c in decision_columns(**costs).items()])


def probability_columns(label: str = "y", score: str = "p") -> dict[str, Column]:
    y, p = F.col(label), F.col(score)
    return {"log_loss": r6(F.avg(row_log_loss(y, p))), "brier": r6(F.avg(row_brier(y, p)))}


def score_counts(df: DataFrame, by: Sequence[str], label: str = "y", score: str = "p") -> DataFrame:
    """(group, distinct score p) -> pos, neg, and both over lower scores (``_before``) and in the group (``_all``).

    Scores are taken as they are, and ordered in ranges, so any number of distinct scores will do.
    """
    named = df.select(*by, F.col(score).alias("p"), F.col(label).alias("_label"))
    totals = {"pos": (F.col("_label") == 1).cast("bigint"), "neg": (F.col("_label") != 1).cast("bigint")}
    return ordered_distinct(named, by, "p", totals)


def ranking_metrics(df: DataFrame, by: Sequence[str], label: str = "y", score: str = "p") -> DataFrame:
    """Tie-aware ROC-AUC and step-wise average precision per group."""
    curve = score_counts(df, by, label, score).select(
        *by,
        "pos",
        "neg",
        "neg_before",
        (F.col("pos_all") - F.col("pos_before")).alias("tp"),
        (F.col("neg_all") - F.col("neg_before")).alias("fp"),
        F.col("pos_all").alias("all_pos"),
        F.col("neg_all").alias("all_neg"),
    )
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    negatives_below = F.col("neg_before")
    return curve.groupBy(*by).agg(
        r6(
            ratio(
                F.sum(pos * (negatives_below + neg / 2)),
                F.max("all_pos").cast("double") * F.max("all_neg"),
            )
        ).alias("roc_auc"),
        r6(ratio(F.sum(pos * F.col("tp") / (F.col("tp") + F.col("fp"))), F.max("all_pos"))).alias(
            "average_precision"
        ),
    )


def model_report(df: DataFrame, by: Sequence[str], threshold: Column | float = 0.5, label: str = "y", score: str = "p") -> DataFrame:
    """The superset of metrics: probability quality, ranking and decisions, one row per group."""
    if not by:
        whole = model_report(df.withColumn("_all", F.lit(0)), ["_all"], threshold, label, score)
        return whole.drop("_all")
    hit = F.col(score) >= (threshold if isinstance(threshold, Column) else F.lit(threshold))
    pos = F.col(label) == 1
    base = df.groupBy(*by).agg(
        F.count_if(~hit & ~pos).alias("tn"),
        F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
        F.count_if(hit & pos).alias("tp"),
        *[c.alias(n) for n, c in probability_columns(label, score).items()],
    )
    base = base.select(
        *by, "log_loss", "brier", "tn", "fp", "fn", "tp", *[c.alias(n) for n, c in decision_columns().items()]
    )
    return match_keys(base, ranking_metrics(df, by, label, score), list(by))


def threshold_table(
    df: DataFrame,
    by: Sequence[str] = (),
    label: str = "y",
    score: str = "p",
    low: int = 5,
    high: int = 80,
    fp_cost: float = FP_COST,
    fn_cost: float = FN_COST,
) -> DataFrame:
    """All metrics at every cut-off low%..high% of six-digit scores, from one pass over the rows.

    Rows collapse to at most 101 score buckets per group; the cut-offs are applied to the buckets.
    """
    percent = F.floor(F.floor(F.col(score) * 1e6 + 0.5) / 10000).cast("int")
    cuts = F.transform(F.sequence(F.lit(low), F.lit(high)), lambda c: F.struct(c.alias("at"), (c / 100.0).alias("threshold")))
    return _sweep(df, by, label, score, percent, cuts, fp_cost, fn_cost)


def threshold_table_at(
    df: DataFrame,
    cutoffs: Sequence[float],
    by: Sequence[str] = (),
    label: str = "y",
    score: str = "p",
    fp_cost: float = FP_COST,
    fn_cost: float = FN_COST,
) -> DataFrame:
    """The same at any list of cut-offs, on scores as they are: a row's bucket is the number of cut-offs it reaches."""
    ordered = sorted({float(c) for c in cutoffs})
    reached = F.size(F.filter(F.array(*map(F.lit, ordered)), lambda c: c <= F.col(score)))
    cuts = F.array(*[F.struct(F.lit(k).alias("at"), F.lit(c).alias("threshold")) for k, c in enumerate(ordered, 1)])
    return _sweep(df, by, label, score, reached, cuts, fp_cost, fn_cost)


def _sweep(df: DataFrame, by: Sequence[str], label: str, score: str, bucket: Column, cuts: Column, fp_cost: float, fn_cost: float) -> DataFrame:
    """``cuts`` holds (at, threshold); a row counts as called at a cut whose ``at`` its bucket reaches."""
    p, y = F.col(score), F.col(label)
    buckets = df.groupBy(*by, bucket.alias("_bucket")).agg(
        F.sum((y == 1).cast("bigint")).alias("_pos"),
        F.sum((y != 1).cast("bigint")).alias("_neg"),
        F.sum(row_log_loss(y, p)).alias("_ll"),
        F.sum(row_brier(y, p)).alias("_br"),
    )
    at = buckets.select("*", F.explode(cuts).alias("_cut"))
    above = F.col("_bucket") >= F.col("_cut.at")

    def total(column: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    rows = F.sum(F.col("_pos") + F.col("_neg"))
    counts = at.groupBy(*by, F.col("_cut.threshold").alias("threshold")).agg(
        total("_neg", ~above).alias("tn"),
        total("_neg", above).alias("fp"),
        total("_pos", ~above).alias("fn"),
        total("_pos", above).alias("tp"),
        r6(F.sum("_ll") / rows).alias("log_loss"),
        r6(F.sum("_br") / rows).alias("brier"),
    )
    return counts.select(
        *by, "threshold", "tn", "fp", "fn", "tp", "log_loss", "brier",
        *[c.alias(n) for n, c in decision_columns(fp_cost, fn_cost).items()],
    )


def value_auc(tidy: DataFrame, by: Sequence[str], value: str = "value", label: str = "y") -> DataFrame:
    """ROC-AUC of raw values with any number of distinct values: no group is ordered in one task."""
    cells = ordered_distinct(
        tidy, by, value, {"pos": (F.col(label) == 1).cast("bigint"), "neg": (F.col(label) != 1).cast("bigint")}
    )
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    return cells.groupBy(*by).agg(
        r6(ratio(wins, F.max("pos_all").cast("double") * F.max("neg_all"))).alias("roc_auc")
    )


def precision_at_prevalence(counts: DataFrame, keep: Sequence[str], prevalences: Sequence[float]) -> DataFrame:
    """Precision the same recall and specificity would give under other base rates."""
    rates = F.array(*[F.lit(float(p)) for p in prevalences])
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    specificity = ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    rows = counts.withColumn("prevalence", F.explode(rates))
    hit, false = recall * F.col("prevalence"), (1 - specificity) * (1 - F.col("prevalence"))
    return rows.select(*keep, "prevalence", r6(ratio_or_zero(hit, hit + false)).alias("precision"))


def base_rates(df: DataFrame, by: Sequence[str], label: str = "y") -> DataFrame:
    """Prevalence and the accuracy of always answering with the majority."""
    rate = F.avg(label)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), r6(rate).alias("prevalence"), r6(F.greatest(rate, 1 - rate)).alias("majority_accuracy")
    )


def paired_differences(per_fold: DataFrame, baseline: str, metrics: Sequence[str], model: str = "model", fold: str = "fold") -> DataFrame:
    """Per model and metric: the mean over folds of (model - baseline) on the same fold."""
    base = per_fold.filter(F.col(model) == baseline).select(fold, *[F.col(m).alias(f"_base_{m}") for m in metrics])
    both = per_fold.filter(F.col(model) != baseline).join(base, fold)
    tidy = both.select(model, fold, *[(F.col(m) - F.col(f"_base_{m}")).alias(m) for m in metrics]).unpivot(
        [model, fold], list(metrics), "metric", "value"
    )
    return tidy


def best_models(report: DataFrame, lower: Sequence[str], higher: Sequence[str], model: str = "model") -> DataFrame:
    """The winning model per metric; equal values go to the first name."""
    lines = []
    for m in [*lower, *higher]:
        key = F.col(m) if m in lower else -F.col(m)
        best = F.min(F.struct(key.alias("key"), F.col(model).alias("model"), F.col(m).alias("value")))
        lines.append(best.alias(f"_w_{m}"))
    one = report.agg(*lines)
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(f"_w_{m}.model").alias("best"), F.col(f"_w_{m}.value").alias("value"))
            for m in [*lower, *higher]
        ]
    )
    return one.select(F.inline(rows))
