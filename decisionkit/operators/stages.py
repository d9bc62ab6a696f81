"""Pipeline stages that are saved with a fitted model, so that serving applies the same contract and features."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .contracts import Rule, fail_fast, not_in_vocabulary, not_sentinel_or_range, out_of_range, require_columns
from .features import add_domain_features, prepare_precontact

INPUTS = ("prior_contacts_in_campaign", "pdays", "age", "month", "day")


class ContractGate(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Rows pass unchanged; a missing column or a bad value fails the job, in training and in scoring."""

    ageLow = Param(Params._dummy(), "ageLow", "smallest age", TypeConverters.toInt)
    ageHigh = Param(Params._dummy(), "ageHigh", "largest age", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, ageLow: int = 18, ageHigh: int = 100):
        super().__init__()
        self._setDefault(ageLow=18, ageHigh=100)
        self._set(**self._input_kwargs)

    def rules(self) -> list[Rule]:
        low, high = self.getOrDefault(self.ageLow), self.getOrDefault(self.ageHigh)
        return [
            Rule(f"age within {low}..{high}", out_of_range("age", low, high)),
            Rule("calendar day exists", out_of_range("day", 1, 31)),
            Rule("calendar month exists", not_in_vocabulary("month", range(1, 13))),
            Rule("gap counted in days or marked -1", not_sentinel_or_range("pdays")),
            Rule("earlier attempts counted from 0", out_of_range("prior_contacts_in_campaign", 0)),
        ]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return fail_fast(require_columns(dataset, INPUTS), self.rules())


class PrecontactColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Drop what is only known after the contact."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return prepare_precontact(dataset)


class DomainFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_domain_features(dataset)


class AsDoubles(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric inputs as DOUBLE, which the imputer asks for."""

    columns = Param(Params._dummy(), "columns", "columns to cast", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        self._setDefault(columns=[])
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: F.col(c).cast("double") for c in self.getOrDefault(self.columns)})
