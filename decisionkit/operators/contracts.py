"""Two-layer data contracts: schema checks before the job, value checks inside it.

Every value check is a boolean column that is TRUE for a violation, so that a batch is checked in one
pass and the same expressions give a report, a quarantine or a failure.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import r6
from .ordered import group_sizes

PREDICTION_FEATURES = {
    # feature -> known at the prediction moment
    "age": True, "job": True, "balance": True, "contact": True, "day": True, "month": True,
    "previous": True, "pdays": True, "poutcome": True, "campaign": False, "duration": False, "y": False,
}


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column
    critical: bool = True


def column_set(columns: Iterable[str], required: Iterable[str], exact: bool = False) -> tuple[list[str], list[str]]:
    """(missing, extra), each sorted; extra is empty unless the set must match exactly."""
    have, need = set(columns), set(required)
    return sorted(need - have), sorted(have - need) if exact else []


def require_columns(df: DataFrame, required: Iterable[str], exact: bool = False) -> DataFrame:
    missing, extra = column_set(df.columns, required, exact)
    if missing or extra:
        raise ValueError(f"columns differ from the contract: missing={missing} extra={extra}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("nothing to check: the batch is empty")
    return df


def not_numeric(column: str) -> Column:
    c = F.col(column)
    return c.isNotNull() & c.try_cast("double").isNull()


def out_of_range(column: str, low: float | None = None, high: float | None = None) -> Column:
    """NULL counts as a violation, as a missing value is not between the bounds."""
    c = F.col(column)
    inside = F.lit(True)
    if low is not None:
        inside = inside & (c >= low)
    if high is not None:
        inside = inside & (c <= high)
    return ~F.coalesce(inside, F.lit(False))


def not_sentinel_or_range(column: str, sentinel: float = -1, low: float = 0) -> Column:
    c = F.col(column)
    return ~F.coalesce((c == sentinel) | (c >= low), F.lit(False))


def not_in_vocabulary(column: str, levels: Sequence, nulls_allowed: bool = True) -> Column:
    c = F.col(column)
    return F.when(c.isNull(), F.lit(not nulls_allowed)).otherwise(~c.isin(list(levels)))


def unseen_levels(df: DataFrame, column: str, vocabulary: DataFrame) -> DataFrame:
    """Rows whose level is not in a vocabulary table of any size; a NULL level is not looked up."""
    return df.filter(F.col(column).isNotNull()).join(vocabulary.select(column), column, "left_anti")


def bad_label(column: str) -> Column:
    return ~F.coalesce(F.col(column).isin(0, 1), F.lit(False))


def not_finite(column: str) -> Column:
    c = F.col(column).cast("double")
    return F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False))


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(check, violations, passed) from one aggregate over the batch."""
    counts = df.agg(*[F.count_if(r.violated).alias(f"_v{i}") for i, r in enumerate(rules)])
    lines = F.array(
        *[F.struct(F.lit(r.name).alias("check"), F.col(f"_v{i}").alias("violations")) for i, r in enumerate(rules)]
    )
    return counts.select(F.inline(lines)).withColumn("passed", F.col("violations") == 0)


def with_reasons(df: DataFrame, rules: Sequence[Rule], name: str = "reasons") -> DataFrame:
    hits = [F.when(r.violated, F.lit(r.name)) for r in rules]
    return df.withColumn(name, F.array_compact(F.array(*hits)))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reasons)."""
    marked = with_reasons(df, rules)
    empty = F.size("reasons") == 0
    return marked.filter(empty).drop("reasons"), marked.filter(~empty)


def fail_fast(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same rows; the job fails on the first critical violation it meets."""
    critical = [r for r in rules if r.critical]
    first = F.coalesce(*[F.when(r.violated, F.lit(r.name)) for r in critical])
    guard = F.when(first.isNotNull(), F.raise_error(F.concat(F.lit("contract violated: "), first))).otherwise(F.lit(True))
    return df.withColumn("_ok", guard.cast("boolean")).filter("_ok").drop("_ok")


def row_count_band(current: DataFrame, previous: DataFrame, tolerance: float) -> DataFrame:
    """Row count against the previous load."""
    now = current.agg(F.count(F.lit(1)).alias("rows"))
    before = previous.agg(F.count(F.lit(1)))
    band = F.col("previous_rows") * tolerance
    return now.withColumn("previous_rows", before.scalar()).withColumn(
        "passed", F.abs(F.col("rows") - F.col("previous_rows")) <= band
    )


def row_count_bands(df: DataFrame, load: Column, tolerance: float) -> DataFrame:
    """Row count of every load against the one before; one row per load reaches the window."""
    counts = df.groupBy(load).agg(F.count(F.lit(1)).alias("rows"))
    name = counts.columns[0]
    before = F.lag("rows").over(Window.orderBy(name))
    return counts.withColumn("previous_rows", before).withColumn(
        "passed", F.abs(F.col("rows") - F.col("previous_rows")) <= F.col("previous_rows") * tolerance
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return group_sizes(df, key, "copies").filter("copies > 1")


def missing_rates(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_m_{c}") for c in limits])
    lines = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"_m_{c}").alias("missing"), F.lit(float(limit)).alias("ceiling"))
            for c, limit in limits.items()
        ]
    )
    rate = F.col("missing") / F.nullif(F.col("_n").cast("double"), F.lit(0.0))
    return (
        counts.select("_n", F.inline(lines))
        .withColumn("missing_rate", r6(rate))
        .withColumn("passed", F.coalesce(rate <= F.col("ceiling"), F.lit(True)))
        .drop("_n")
    )


def availability_violations(columns: Iterable[str], contract: Mapping[str, bool]) -> list[tuple[str, str]]:
    """(column, problem) for columns that are unknown or not known yet at the prediction moment."""
    out = []
    for c in sorted(columns):
        if c not in contract:
            out.append((c, "not in contract"))
        elif not contract[c]:
            out.append((c, "not available"))
    return out


def freshness(df: DataFrame, time: str, as_of: Column, promised_days: int) -> DataFrame:
    age = F.datediff(as_of, F.col("newest"))
    return df.agg(F.max(F.col(time).cast("date")).alias("newest")).select(
        "newest", age.alias("age_days"), (age <= promised_days).alias("fresh")
    )


def new_category_rate(reference: DataFrame, batch: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows of the batch with a level the reference never showed."""
    levels = batch.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    known = reference.select(column).distinct().withColumn("_known", F.lit(1))
    fresh = F.col("_known").isNull() & F.col(column).isNotNull()
    return (
        levels.join(known, column, "left")
        .agg(
            F.sum("_n").alias("rows"),
            F.coalesce(F.sum(F.when(fresh, F.col("_n"))), F.lit(0)).alias("new_rows"),
            F.count_if(fresh).alias("new_levels"),
        )
        .withColumn("rate", r6(F.col("new_rows") / F.col("rows")))
        .withColumn("alert", F.col("rate") > limit)
    )


def mean_shift(df: DataFrame, batch: str, column: str, limit: float) -> DataFrame:
    """Mean per batch against the batch before; one row per batch reaches the window."""
    means = df.groupBy(batch).agg(F.avg(column).alias("_mean"), F.count(F.lit(1)).alias("rows"))
    shift = F.col("_mean") - F.lag("_mean").over(Window.orderBy(batch))
    return means.select(
        batch, "rows", r6(F.col("_mean")).alias("mean"), r6(shift).alias("shift"), (F.abs(shift) > limit).alias("alert")
    )


def contact_rules(age_low: int = 18, age_high: int = 100) -> list[Rule]:
    """The value contract of the contact frame."""
    return [
        Rule("label known as 0 or 1", bad_label("y")),
        Rule(f"age within {age_low}..{age_high}", out_of_range("age", age_low, age_high)),
        Rule("calendar day exists", out_of_range("day", 1, 31)),
        Rule("calendar month exists", not_in_vocabulary("month", range(1, 13), nulls_allowed=False)),
        Rule("gap counted in days or marked -1", not_sentinel_or_range("pdays")),
        Rule("attempt number starts at 1", out_of_range("campaign", 1)),
    ]
