"""Guarded batch scoring, one-time test evaluation and run records."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .contracts import out_of_range, require_columns
from .features import feature_groups
from .metrics import model_report
from .scoring import Scorecard
from .stages import INPUTS, ContractGate

AGE_LIMITS = (18, 120)


def validate_batch(df: DataFrame, required: Sequence[str], numeric: Sequence[str], age_limits: tuple[int, int] = AGE_LIMITS) -> DataFrame:
    """Exact columns, a non-empty batch, numbers in every numeric column, ages in range; one aggregate answers all of it.

    Raises ValueError; returns the columns in contract order with numbers as DOUBLE.
    """
    require_columns(df, required, exact=True)
    as_number = {c: F.col(c).try_cast("double") for c in numeric}
    typed = df.select(*[as_number.get(c, F.col(c)).alias(c) for c in required])
    low, high = age_limits
    outside = F.count_if(out_of_range("age", low, high)) if "age" in required else F.lit(0)
    seen = typed.agg(F.count(F.lit(1)).alias("_rows"), outside.alias("_outside"), *[F.count_if(F.col(c).isNull()).alias(c) for c in as_number]).first().asDict()
    if not seen.pop("_rows"):
        raise ValueError("nothing to check: the batch is empty")
    strangers = seen.pop("_outside")
    bad = sorted(c for c, n in seen.items() if n)
    if bad:
        raise ValueError(f"no usable number in columns {bad}")
    if strangers:
        raise ValueError(f"age outside {low}..{high} in {strangers} rows")
    return typed


def predict_batch(df: DataFrame, card: Scorecard, threshold: float, key: str, required: Sequence[str], age_limits: tuple[int, int] = AGE_LIMITS) -> DataFrame:
    """(key, subscription_probability, prioritize_call, model_threshold) for a batch that passes the gate."""
    numeric, _ = feature_groups(df.select(*[c for c in required if c in df.columns]), exclude=[key])
    numeric = sorted({*numeric, *(c for c in card.weights if c in required)})
    valid = validate_batch(df, required, numeric, age_limits)
    scored = valid.withColumn("subscription_probability", card.probability())
    return scored.select(
        key,
        "subscription_probability",
        (F.col("subscription_probability") >= threshold).alias("prioritize_call"),
        F.lit(float(threshold)).alias("model_threshold"),
    )


def score_with_pipeline(batch: DataFrame, model_path: str, threshold: float, key: str, path: str, run: str, numeric: Sequence[str] = ()) -> dict[str, int]:
    """Score a batch with a saved pipeline in one pass, and show the scores only if the whole batch kept its contract.

    The saved pipeline's own gate becomes counts: an ``Observation`` gathers rows, broken rules and missing numbers while the scores are written to a folder of their own. Only
    then is the run committed, by creating its marker, which is one step. A batch that breaks a rule, an empty batch or a job that dies leaves a folder that no
    marker names, so readers never see it. A run that was committed is refused. Returns the counts.
    """
    spark = batch.sparkSession
    if any(r["run"] == run for r in _committed(spark, path)):
        raise PermissionError(f"run {run} was already scored")
    seen, rows = Observation(), batch
    for stage in PipelineModel.load(model_path).stages:
        if not isinstance(stage, ContractGate):
            rows = stage.transform(rows)
            continue
        # a bad number would stop the job before it is counted: such rows are counted and not scored, and their batch is not committed
        checks = {r.name: r.violated for r in stage.rules()} | {f"no number in {c}": F.col(c).try_cast("double").isNull() for c in numeric}
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("no key"), *[F.count_if(bad).alias(name) for name, bad in checks.items()]]
        usable = F.lit(True)
        for bad in checks.values():
            usable = usable & ~bad
        rows = require_columns(rows, INPUTS).observe(seen, *counts).filter(usable)
    p = vector_to_array("probability")[1]
    scored = rows.select(key, p.alias("subscription_probability"), (p >= threshold).alias("prioritize_call"), F.lit(float(threshold)).alias("model_threshold"))
    folder = f"part-{uuid.uuid4().hex}"
    scored.write.parquet(f"{path}/{folder}")
    found = seen.get
    broken = sorted(k for k, n in found.items() if k != "rows" and n)
    if broken or not found["rows"]:
        raise ValueError(f"batch not committed: {[f'{k}: {found[k]} rows' for k in broken] or 'it is empty'}")
    marker = spark.createDataFrame([(run, folder, int(found["rows"]))], "run string, folder string, rows bigint")
    try:  # of two jobs with one run, one creates the marker
        marker.coalesce(1).write.mode("errorifexists").parquet(f"{path}/committed/run={run}")
    except AnalysisException as e:
        raise PermissionError(f"run {run} was already scored") from e
    return found


def _committed(spark: SparkSession, path: str) -> list:
    marks = read_runs(spark, f"{path}/committed")
    return [] if marks is None else marks.select("run", "folder").collect()  # one row per run


def read_scores(spark: SparkSession, path: str) -> DataFrame | None:
    """The scores of all committed runs; nothing where none is."""
    folders = [f"{path}/{r['folder']}" for r in _committed(spark, path)]
    return spark.read.parquet(*folders) if folders else None


def read_runs(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # any other error must not open the seal
            raise
        return None


def evaluate_sealed(test: DataFrame, card: Scorecard, threshold: float, runs_path: str, cycle: str) -> DataFrame:
    """Score the test rows once per development cycle and log the access; a second call is refused."""
    spark = test.sparkSession
    runs = read_runs(spark, runs_path)
    if runs is not None and not runs.filter(F.col("cycle") == cycle).isEmpty():
        raise PermissionError(f"the test split was already scored in cycle {cycle}")
    try:  # creating the marker is one step: of two jobs in one cycle, one gets it
        spark.range(1).write.mode("errorifexists").parquet(f"{runs_path}.cycles/{cycle}")
    except AnalysisException as e:
        raise PermissionError(f"the test split was already scored in cycle {cycle}") from e
    scored = test.select("y", card.probability().alias("p"))
    report = model_report(scored, [], threshold).select(
        F.lit(cycle).alias("cycle"), F.lit(float(threshold)).alias("threshold"), "*"
    )
    report.write.mode("append").parquet(runs_path)
    return spark.read.parquet(runs_path).filter(F.col("cycle") == cycle)


def run_record(splits: DataFrame, fingerprint: DataFrame, metrics: DataFrame, facts: Mapping[str, str | int | float]) -> DataFrame:
    """One row: facts of the run, table fingerprint, rows per split, final metrics."""
    sizes = splits.groupBy().agg(
        *[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in ("development", "validation", "test")]
    )
    metric_columns = [c for c in metrics.columns if c not in facts]
    return sizes.select(
        *[F.lit(v).alias(k) for k, v in facts.items()],
        fingerprint.select("fingerprint").scalar().alias("fingerprint"),
        *sizes.columns,
        *[metrics.select(c).scalar().alias(c) for c in metric_columns],
    )
