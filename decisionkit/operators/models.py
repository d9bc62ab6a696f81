"""Model fitting with Spark ML: feature stages, learners, out-of-fold scores, stacking, early stopping.

Learners run on every executor; the driver holds fitted coefficients and trees only. Every function that
learns takes the training rows explicitly, so that fold safety is visible at the call.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_order
from ..functions.scalars import log_odds, r6
from ..session import scratch_path, staged
from .features import add_domain_features, prepare_precontact
from .fitted import LevelEncoder, NumberEncoder, design_names
from .imbalance import balanced_weights
from .quantiles import bin_right_closed
from .splits import split_at_cuts
from .stages import AsDoubles, ContractGate, DomainFeatures, PrecontactColumns

Fit = Callable[[DataFrame], PipelineModel]
LABEL = "y"


def parts_for(df: DataFrame) -> int:
    """Partitions for learners, from the rows alone: no cluster setting changes a model."""
    return max(8, -(-df.count() // 200_000))


def steady(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash-partitioned and sorted rows: tree learners sample by partition, so the order must be fixed."""
    return df.repartition(partitions or parts_for(df), key).sortWithinPartitions(key)


def feature_stages(numeric: Sequence[str], categorical: Sequence[str], scale: bool = True, min_frequency: int = 10) -> list:
    """Exact median, population scale, mode, levels with a rare bucket, one-hot, assemble. Unseen levels go to the rare bucket, or to no column."""
    numbers = [f"{c}_num" for c in numeric]
    index = [f"{c}_idx" for c in categorical]
    onehot = [f"{c}_hot" for c in categorical]
    stages: list = []
    if numeric:
        stages.append(NumberEncoder(inputCols=list(numeric), outputCols=numbers, scale=scale))
    if categorical:
        stages.append(LevelEncoder(inputCols=list(categorical), outputCols=index, minFrequency=min_frequency))
        # sizes are in the columns' metadata; the code one past the last stands for unseen levels and gets no column
        stages.append(OneHotEncoder(inputCols=index, outputCols=onehot, handleInvalid="keep", dropLast=True))
    stages.append(VectorAssembler(inputCols=numbers + onehot, outputCol="features"))
    return stages


def as_doubles(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in numeric})


def without_summary(model: LogisticRegressionModel, spark: SparkSession) -> LogisticRegressionModel:
    """The model read back from a saved copy. A fitted binary model carries its training summary, and with it the session, into every task; once
    the session has made an ``Observation`` it can no longer be sent."""
    path = scratch_path(spark, "learner")
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def fit_encoded(train: DataFrame, stages: list, learner, key: str | None = None) -> PipelineModel:
    """Fit the stages, write the encoded rows once for the learner's passes (in the fixed order of ``key`` if given), fit the learner."""
    encoders = Pipeline(stages=stages).fit(train)
    extra = [learner.getOrDefault(p) for p in ("weightCol", "validationIndicatorCol") if learner.hasParam(p) and learner.isDefined(p)]
    rows = encoders.transform(train).select(*([key] if key else []), F.col(LABEL).cast("double").alias(LABEL), *extra, "features")
    rows = steady(staged(rows, "design"), key) if key else staged(rows, "design")
    fitted = learner.fit(rows)
    if isinstance(fitted, LogisticRegressionModel):
        fitted = without_summary(fitted, train.sparkSession)
    return PipelineModel([*encoders.stages, fitted])


def logistic(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], weight: str | None = None, c: float = 1.0) -> PipelineModel:
    """L2 logistic regression; strength C on summed losses is 1 / (C * total weight) on mean losses."""
    total = train.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
    learner = LogisticRegression(
        labelCol=LABEL, maxIter=100, regParam=1.0 / (c * float(total)), elasticNetParam=0.0, standardization=False
    )
    if weight:
        learner.setWeightCol(weight)
    return fit_encoded(as_doubles(train, numeric), feature_stages(numeric, categorical), learner)


def guarded_logistic(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    """One saved artifact from raw contacts to probability: columns, contract, features, encoders, learner."""
    learner = LogisticRegression(
        labelCol=LABEL, maxIter=100, regParam=1.0 / float(train.count()), elasticNetParam=0.0, standardization=False
    )
    guards = [PrecontactColumns(), ContractGate(), DomainFeatures(), AsDoubles(columns=list(numeric))]
    return fit_encoded(train, [*guards, *feature_stages(numeric, categorical)], learner)


def weighted_logistic(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    return logistic(balanced_weights(train, LABEL), numeric, categorical, weight="weight")


def booster(trees: int = 20, rate: float = 0.1, depth: int = 3, min_leaf: int = 1, subsample: float = 1.0, features: str = "all", seed: int = 42) -> GBTClassifier:
    return GBTClassifier(
        labelCol=LABEL, maxIter=trees, stepSize=rate, maxDepth=depth, minInstancesPerNode=min_leaf,
        subsamplingRate=subsample, featureSubsetStrategy=features, seed=seed,
    )


def encoded(encoders: PipelineModel, df: DataFrame, numeric: Sequence[str], key: str) -> DataFrame:
    """Key, label and features of the rows, encoded and written once for all passes over them, in files of about equal size."""
    rows = encoders.transform(as_doubles(df, numeric)).select(key, F.col(LABEL).cast("double").alias(LABEL), "features")
    return staged(rows.repartition(parts_for(df), key), "design")


def encoded_rows(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], key: str) -> tuple[PipelineModel, DataFrame]:
    """The encoders of tree learners and the rows they encode, written once in the fixed order of ``key``: what several learners on the same rows share."""
    encoders = Pipeline(stages=feature_stages(numeric, categorical, scale=False)).fit(as_doubles(train, numeric))
    return encoders, steady(encoded(encoders, train, numeric, key), key)


def boosted_trees(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], key: str = "contact_id",
                  trees: int = 20, rate: float = 0.1, depth: int = 3, min_leaf: int = 1, subsample: float = 1.0,
                  features: str = "all", indicator: str | None = None, seed: int = 42) -> PipelineModel:
    learner = booster(trees, rate, depth, min_leaf, subsample, features, seed)
    if indicator:
        learner.setValidationIndicatorCol(indicator)
    return fit_encoded(as_doubles(train, numeric), feature_stages(numeric, categorical, scale=False), learner, key)


def random_forest(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], key: str = "contact_id",
                  trees: int = 30, depth: int = 8, seed: int = 42) -> PipelineModel:
    rows = as_doubles(balanced_weights(train, LABEL), numeric)
    learner = RandomForestClassifier(
        labelCol=LABEL, numTrees=trees, maxDepth=depth, minInstancesPerNode=4, featureSubsetStrategy="sqrt",
        weightCol="weight", seed=seed,
    )
    return fit_encoded(rows, feature_stages(numeric, categorical, scale=False), learner, key)


def probability(model: PipelineModel, df: DataFrame, numeric: Sequence[str], keep: Sequence[str], name: str = "p") -> DataFrame:
    scored = model.transform(as_doubles(df, numeric))
    return scored.select(*keep, F.round(vector_to_array("probability")[1], 6).alias(name))


def out_of_fold(df: DataFrame, fit: Fit, predict: Callable[[PipelineModel, DataFrame], DataFrame], folds: int, fold: str = "fold") -> DataFrame:
    """Each row scored by a model that did not see its fold."""
    parts = []
    for k in range(folds):
        model = fit(df.filter(F.col(fold) != k))
        parts.append(predict(model, df.filter(F.col(fold) == k)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def majority_and_prior(df: DataFrame, by: Sequence[str], label: str = LABEL) -> DataFrame:
    """What the constant models answer: the training rate and the training majority."""
    rate = F.avg(label)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), r6(rate).alias("prior"), (rate > 0.5).cast("int").alias("majority")
    )


def staged_losses(booster: GBTClassificationModel, rows: Mapping[str, DataFrame]) -> DataFrame:
    """(part, trees, loss) after each tree, from the learner's own evaluation of encoded rows, which passes over them twice."""
    losses = [(name, i + 1, float(v)) for name, part in rows.items() for i, v in enumerate(booster.evaluateEachIteration(part))]
    return next(iter(rows.values())).sparkSession.createDataFrame(losses, "part string, trees int, loss double")


def boosting_with_rows(parts: Mapping[str, DataFrame], numeric: Sequence[str], categorical: Sequence[str], key: str = "contact_id",
                       **args) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """Boosted trees on the first part, and the encoded rows of every part: each part is encoded once, for fitting, losses and scores alike."""
    (first, train), *others = parts.items()
    encoders = Pipeline(stages=feature_stages(numeric, categorical, scale=False)).fit(as_doubles(train, numeric))
    rows = {name: encoded(encoders, part, numeric, key) for name, part in [(first, train), *others]}
    return PipelineModel([*encoders.stages, booster(**args).fit(steady(rows[first], key))]), rows


def early_stopped(fit_rows: DataFrame, stop_rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], **args) -> tuple[PipelineModel, DataFrame, int]:
    """Choose the number of trees on the stop rows, then refit on all development rows."""
    model, rows = boosting_with_rows({"fit": fit_rows, "stop": stop_rows}, numeric, categorical, **args)
    curve = staged_losses(model.stages[-1], rows)
    best = curve.filter("part = 'stop'").agg(F.min_by("trees", F.struct("loss", "trees"))).first()[0]
    args["trees"] = int(best)
    refit = boosted_trees(fit_rows.unionByName(stop_rows), numeric, categorical, **args)
    return refit, curve, int(best)


def coefficient_table(model: PipelineModel, n: int = 10) -> DataFrame:
    """(side, name, coefficient): the most negative and most positive terms of a fitted logistic model, named by its encoders' tables."""
    named = coefficients_by_name(model)
    low = named.orderBy("coefficient", "name").limit(n).withColumn("side", F.lit("bottom"))
    high = named.orderBy(F.col("coefficient").desc(), "name").limit(n).withColumn("side", F.lit("top"))
    return low.unionByName(high).select("side", "name", "coefficient")


def coefficients_by_name(model: PipelineModel) -> DataFrame:
    """(source, level, name, coefficient) of every column of the design."""
    values = [(i, float(w)) for i, w in enumerate(model.stages[-1].coefficients.toArray())]
    names = design_names(model)
    return names.join(names.sparkSession.createDataFrame(values, "position bigint, coefficient double"), "position").drop("position")


def logistic_gradient(model: PipelineModel, df: DataFrame, c: float = 1.0, label: str = LABEL) -> DataFrame:
    """(name, gradient) of the summed log loss plus |w|^2 / (2 c), per row: zero at the optimum. One row per coefficient and task leaves the tasks."""
    names = design_names(model)
    weights = [(i, float(w)) for i, w in enumerate(model.stages[-1].coefficients.toArray())]
    miss = vector_to_array("probability")[1] - F.col(label)
    cells = model.transform(df).select(miss.alias("miss"), F.posexplode(vector_to_array("features")).alias("position", "x")).filter("x <> 0")
    sums = cells.groupBy(F.col("position").cast("bigint").alias("position")).agg(F.sum(F.col("miss") * F.col("x")).alias("slope"))
    table = df.sparkSession.createDataFrame(weights, "position bigint, w double").join(sums, "position", "left")
    rows = df.agg(F.count(F.lit(1))).scalar()
    return table.join(names, "position").select("name", ((F.coalesce("slope", F.lit(0.0)) + F.col("w") / c) / rows).alias("gradient"))


def soft_vote(wide: DataFrame, models: Sequence[str], weights: Sequence[float] | None = None, name: str = "p") -> DataFrame:
    shares = list(weights) if weights else [1.0] * len(models)
    total = sum(shares)
    mean = sum((F.col(m) * w for m, w in zip(models[1:], shares[1:])), F.col(models[0]) * shares[0]) / total
    return wide.withColumn(name, mean)


def stack(oof: DataFrame, new: DataFrame, members: Sequence[str], keep: Sequence[str], label: str = LABEL) -> DataFrame:
    """Meta-logistic fitted on out-of-fold scores only, applied to members refitted on all rows."""
    meta = LogisticRegression(labelCol=label, featuresCol="members", maxIter=100)
    assembler = VectorAssembler(inputCols=list(members), outputCol="members")
    fitted = without_summary(meta.fit(assembler.transform(oof)), oof.sparkSession)
    return fitted.transform(assembler.transform(new)).select(*keep, F.round(vector_to_array("probability")[1], 6).alias("p"))


def platt(train: DataFrame, new: DataFrame, keep: Sequence[str], score: str = "p", label: str = LABEL) -> DataFrame:
    """Logistic map of the raw score, fitted on held-out scores."""
    def prepared(df: DataFrame) -> DataFrame:
        bounded = F.greatest(F.least(F.col(score), F.lit(1 - 1e-6)), F.lit(1e-6))
        return df.withColumn("_raw", log_odds(bounded))

    assembler = VectorAssembler(inputCols=["_raw"], outputCol="raw")
    learner = LogisticRegression(labelCol=label, featuresCol="raw", probabilityCol="calibrated", maxIter=100)
    fitted = without_summary(learner.fit(assembler.transform(prepared(train))), train.sparkSession)
    return fitted.transform(assembler.transform(prepared(new))).select(*keep, F.round(vector_to_array("calibrated")[1], 6).alias("calibrated"))


def isotonic(train: DataFrame, new: DataFrame, keep: Sequence[str], score: str = "p", label: str = LABEL) -> DataFrame:
    """Monotone step map. Equal scores are pooled first, so at most a million weighted points are fitted."""
    pooled = train.groupBy(F.round(score, 6).alias("score")).agg(
        F.avg(label).alias("label"), F.count(F.lit(1)).cast("double").alias("weight")
    )
    assembler = VectorAssembler(inputCols=["score"], outputCol="score_vector")
    learner = IsotonicRegression(featuresCol="score_vector", labelCol="label", weightCol="weight")
    model = Pipeline(stages=[assembler, learner]).fit(pooled)
    rows = new.withColumn("score", F.round(score, 6))
    return model.transform(rows).select(*keep, F.round("prediction", 6).alias("calibrated"))


def reload_difference(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """Largest absolute difference between a fitted pipeline and its saved and reloaded copy."""
    path = scratch_path(df.sparkSession, "model")
    model.write().save(path)
    again = PipelineModel.load(path)

    def raw(m: PipelineModel, name: str) -> DataFrame:
        return m.transform(df).select(key, vector_to_array("probability")[1].alias(name))

    both = raw(model, "before").join(raw(again, "after"), key)
    gap = F.max(F.abs(F.col("before") - F.col("after")))
    return both.agg(F.count(F.lit(1)).alias("rows"), gap.alias("max_difference"), (gap <= 1e-12).alias("equal"))


def timed(name: str, rows: int, action: Callable[[], object]) -> tuple[str, float, float]:
    begun = time.perf_counter()
    action()
    seconds = time.perf_counter() - begun
    return name, seconds, 1000.0 * 1000.0 * seconds / max(rows, 1)


def boosting_round(df: DataFrame, features: Sequence[str], edges: Mapping[str, Sequence[float]], residual: Column) -> DataFrame:
    """Candidate depth-1 splits of one boosting round from binned residual sums.

    One aggregate over (feature, bin) holds everything a round needs; the prefix sums run over a few
    bins per feature. The best split has the largest gain GL^2/nL + GR^2/nR - G^2/n.
    """
    work = df.withColumn("_residual", residual)
    lines = [
        F.struct(
            F.lit(f).alias("feature"),
            bin_right_closed(F.col(f).cast("double"), F.array(*[F.lit(float(e)) for e in edges[f]])).alias("bin"),
        )
        for f in features
    ]
    cells = (
        work.select("_residual", F.explode(F.array(*lines)).alias("_b"))
        .groupBy("_b.feature", "_b.bin")
        .agg(F.sum("_residual").alias("g"), F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("feature")
    sums = cells.select(
        "feature", "bin",
        F.sum("g").over(upto).alias("gl"), F.sum("n").over(upto).alias("nl"),
        F.sum("g").over(whole).alias("g"), F.sum("n").over(whole).alias("n"),
    )
    gr, nr = F.col("g") - F.col("gl"), F.col("n") - F.col("nl")
    gain = F.col("gl") * F.col("gl") / F.col("nl") + gr * gr / nr - F.col("g") * F.col("g") / F.col("n")
    table = sums.filter(nr > 0).select(
        "feature", "bin", "nl", nr.alias("nr"), r6(gain).alias("gain"),
        r6(F.col("gl") / F.col("nl")).alias("left_value"), r6(gr / nr).alias("right_value"),
    )
    place = F.row_number().over(Window.orderBy(F.col("gain").desc(), "feature", "bin"))
    return table.withColumn("best", place == 1)


def modelling_frame(contacts: DataFrame) -> DataFrame:
    """Pre-contact rows with the engineered features, staged once because learners pass over them often."""
    frame = add_domain_features(prepare_precontact(contacts))
    return staged(frame, "modelling")


def inner_holdout(df: DataFrame, key: str, share: float = 0.2, seed: int = 43, label: str = LABEL) -> tuple[DataFrame, DataFrame]:
    """(fit, stop) rows for early stopping: each class is cut at its own floor(n * (1 - share)), in hash order, so both have its rate."""
    cut = split_at_cuts(df.drop("split"), key, label, shares=(1.0 - share,), names=("fit", "stop"), seed=seed)
    rows = staged(cut, "inner-holdout")
    return tuple(rows.filter(F.col("split") == part).drop("split") for part in ("fit", "stop"))
