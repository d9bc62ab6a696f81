"""Encoders as pipeline stages whose fitted state is a table: written beside the stage, read back lazily, and joined to the rows.

No level and no quantile passes through the driver; it holds two numbers per categorical column, the size of its design and the code for
unseen levels. The rules are those of the fold-wise encoders: exact median, population SD (1 where it is 0), most frequent level
with ties to the smallest, levels below ``minFrequency`` in one bucket. Nulls and NaN take the median, null levels the mode, for which
they count; a column without any value becomes 0, or a code without a coefficient. Fitted on an empty table, numbers pass as they are
(nulls as 0) and every level is unseen.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .encoders import INFREQUENT, with_text_bucket
from .ordered import ordered_state
from .quantiles import exact_quantiles, tall


class Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to encode", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "encoded columns, in the same order", TypeConverters.toListString)

    def pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols), strict=True))


class StateWriter(MLWriter):
    def __init__(self, stage: StateModel):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.state.write.parquet(f"{path}/state")


class StateReader(MLReader):
    def __init__(self, kind: type[StateModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> StateModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.state = self.sparkSession.read.schema(self.kind.STATE).parquet(f"{path}/state")
        return stage


class StateModel(Model, Columns, MLReadable, MLWritable):
    """A fitted stage: parameters, and ``state`` as a table of the columns in ``STATE``."""

    STATE = ""
    state: DataFrame

    def write(self) -> StateWriter:
        return StateWriter(self)

    @classmethod
    def read(cls) -> StateReader:
        return StateReader(cls)


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


class NumberEncoderModel(StateModel):
    STATE = "feature string, median double, mean double, sd double"
    scale = Param(Params._dummy(), "scale", "subtract the mean and divide by the SD", TypeConverters.toBoolean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getOrDefault(self.inputCols)
        if not names:
            return dataset
        fields = [F.max(F.when(F.col("feature") == c, F.struct("median", "mean", "sd"))).alias(f"s{i}") for i, c in enumerate(names)]
        facts = self.state.agg(F.struct(*fields)).scalar()  # one row of three numbers per column
        out = {}
        for i, (c, name) in enumerate(self.pairs()):
            own = facts[f"s{i}"]
            value = F.coalesce(_number(c), own["median"], F.lit(0.0))
            out[name] = (value - F.coalesce(own["mean"], F.lit(0.0))) / F.coalesce(own["sd"], F.lit(1.0)) if self.getOrDefault(self.scale) else value
        return dataset.withColumns(out)


class NumberEncoder(Estimator, Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Median imputation, then standardisation over the imputed rows."""

    scale = Param(Params._dummy(), "scale", "subtract the mean and divide by the SD", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols: list[str] = (), outputCols: list[str] = (), scale: bool = True):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols), scale=scale)

    def _fit(self, dataset: DataFrame) -> NumberEncoderModel:
        names = self.getOrDefault(self.inputCols)
        rows = tall(dataset.select(*[_number(c).alias(c) for c in names]), [], names)
        cells = staged(rows.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "cells")
        middle = exact_quantiles(cells.filter("value IS NOT NULL"), ["feature"], "value", [0.5], weight="n")
        middle = staged(middle.select("feature", F.col("quantiles")[0].alias("median")), "medians")
        full = cells.join(middle, "feature", "left").withColumn("value", F.coalesce("value", "median", F.lit(0.0)))
        centre = full.groupBy("feature").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"), F.max("median").alias("median"))
        away = F.col("value") - F.col("mean")
        spread = F.sqrt(F.sum(away * away * F.col("n")) / F.sum("n"))
        state = full.drop("median").join(centre, "feature").groupBy("feature", "median", "mean").agg(F.when(spread > 0, spread).otherwise(1.0).alias("sd"))
        model = NumberEncoderModel()
        model._set(inputCols=names, outputCols=self.getOrDefault(self.outputCols), scale=self.getOrDefault(self.scale))
        model.state = staged(state, "numbers")
        return model


class LevelEncoderModel(StateModel):
    """Codes 0 .. size - 1 in the order of the levels' names; a null reads the row of the state whose value is null."""

    STATE = "feature string, value string, encoded string, code bigint"
    sizes = Param(Params._dummy(), "sizes", "number of codes per column", TypeConverters.toListInt)
    unseen = Param(Params._dummy(), "unseen", "code of unseen levels: the rare bucket, or one past the last code, which has no coefficient", TypeConverters.toListInt)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        sizes, unseen = self.getOrDefault(self.sizes), self.getOrDefault(self.unseen)
        for (c, name), size, spare in zip(self.pairs(), sizes, unseen, strict=True):
            own = self.state.filter(F.col("feature") == c).select(F.col("value").alias(f"__{name}_value"), F.col("code").alias(f"__{name}_code"))
            out = out.join(own, F.col(c).cast("string").eqNullSafe(F.col(f"__{name}_value")), "left")
            out = out.withColumn(name, F.coalesce(f"__{name}_code", F.lit(spare)).cast("double")).drop(*own.columns)
            out = out.withMetadata(name, {"ml_attr": {"type": "nominal", "name": name, "num_vals": max(size, 1)}})
        return out


class LevelEncoder(Estimator, Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Mode imputation, then one code per level, with one bucket for levels of fewer than ``minFrequency`` rows."""

    minFrequency = Param(Params._dummy(), "minFrequency", "rows a level needs for a code of its own", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols: list[str] = (), outputCols: list[str] = (), minFrequency: int = 10):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols), minFrequency=minFrequency)

    def _fit(self, dataset: DataFrame) -> LevelEncoderModel:
        names = self.getOrDefault(self.inputCols)
        text = dataset.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "feature", "value")
        counts = staged(text.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "levels")
        blank = F.coalesce(F.max(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("blank")
        first = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("neg"), "value")))["value"].alias("mode")
        modes = staged(counts.groupBy("feature").agg(first, blank), "modes")
        known = counts.filter("value IS NOT NULL").join(modes, "feature")
        n = F.col("n") + F.when(F.col("value") == F.col("mode"), F.col("blank")).otherwise(0)
        rare = n < self.getOrDefault(self.minFrequency)
        known = staged(known.select("feature", "value", F.when(rare, F.lit(INFREQUENT)).otherwise(F.col("value")).alias("encoded")), "encoded")
        kept = with_text_bucket(known.select("feature", "encoded").distinct(), "encoded", "_text")
        coded = staged(ordered_state(kept, ["feature"], ["encoded"], F.col("_text"), rank="_rank").select("feature", "encoded", (F.col("_rank") - 1).alias("code")), "codes")
        levels = known.join(coded, ["feature", "encoded"]).select("feature", "value", "encoded", "code")
        null = modes.filter("mode IS NOT NULL").join(levels, [modes["feature"] == levels["feature"], modes["mode"] == levels["value"]])
        null = null.select(modes["feature"], F.lit(None).cast("string").alias("value"), "encoded", "code")
        # two numbers per column
        facts = coded.groupBy("feature").agg(F.max("code").alias("last"), F.max(F.when(F.col("encoded") == INFREQUENT, F.col("code"))).alias("rare")).collect()
        size = {r["feature"]: r["last"] + 1 for r in facts}
        spare = {r["feature"]: r["last"] + 1 if r["rare"] is None else r["rare"] for r in facts}
        model = LevelEncoderModel()
        model._set(inputCols=names, outputCols=self.getOrDefault(self.outputCols), sizes=[size.get(c, 0) for c in names], unseen=[spare.get(c, 1) for c in names])
        model.state = staged(levels.unionByName(null), "level-codes")
        return model


def design_names(model) -> DataFrame:
    """(position, source, level, name): the columns of the design of a fitted pipeline, numbers first, from the stages' own tables."""
    numbers = next((s for s in model.stages if isinstance(s, NumberEncoderModel)), None)
    levels = next((s for s in model.stages if isinstance(s, LevelEncoderModel)), None)
    tables, offset = [], 0
    if numbers is not None:
        for i, c in enumerate(numbers.getOrDefault(numbers.inputCols)):
            own = numbers.state.filter(F.col("feature") == c)
            tables.append(own.select(F.lit(i).cast("bigint").alias("position"), F.col("feature").alias("source"), F.lit(None).cast("string").alias("level"), F.lit(f"numeric__{c}").alias("name")))
        offset = len(tables)
    if levels is not None:
        for c, size in zip(levels.getOrDefault(levels.inputCols), levels.getOrDefault(levels.sizes)):
            own = levels.state.filter(F.col("feature") == c).select("feature", "encoded", "code").distinct()
            name = F.concat(F.lit(f"categorical__{c}_"), F.col("encoded"))
            tables.append(own.select((F.col("code") + offset).alias("position"), F.col("feature").alias("source"), F.col("encoded").alias("level"), name.alias("name")))
            offset += max(size, 1)
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out
