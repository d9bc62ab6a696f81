"""Frozen linear scorecards: coefficients applied as plain column arithmetic."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import sigmoid


@dataclass(frozen=True)
class Scorecard:
    intercept: float
    weights: dict[str, float] = field(default_factory=dict)
    levels: dict[str, dict[str, float]] = field(default_factory=dict)

    def terms(self) -> dict[str, Column]:
        """One additive term per source feature."""
        out = {}
        for name, table in self.levels.items():
            case = None
            for level, weight in table.items():
                hit = F.col(name) == level
                case = F.when(hit, F.lit(weight)) if case is None else case.when(hit, F.lit(weight))
            out[name] = case.otherwise(F.lit(0.0))
        for name, weight in self.weights.items():
            out[name] = F.lit(weight) * F.col(name)
        return out

    def raw_score(self) -> Column:
        z = F.lit(self.intercept)
        for term in self.terms().values():
            z = z + term
        return z

    def probability(self) -> Column:
        """Probabilities are rounded to six decimals before any comparison with a threshold."""
        return F.round(sigmoid(self.raw_score()), 6)

    def required_columns(self) -> list[str]:
        return [*self.levels, *self.weights]


CONTACT_LEVELS = {"1-URGENT": 1.4, "2-HIGH": 1.1}
FULL = Scorecard(-2.6, {"balance": 0.00004, "age": 0.004, "previous": -0.03}, {"contact": CONTACT_LEVELS})
CONTACT_ONLY = Scorecard(-2.4, {}, {"contact": CONTACT_LEVELS})
HISTORY_ONLY = Scorecard(-2.1, {"balance": 0.00004, "age": 0.004, "previous": -0.03})
SCORECARDS = {"full": FULL, "contact_only": CONTACT_ONLY, "history_only": HISTORY_ONLY}


def score(df: DataFrame, card: Scorecard = FULL, name: str = "p") -> DataFrame:
    return df.withColumn(name, card.probability())


def score_many(df: DataFrame, cards: dict[str, Scorecard] = SCORECARDS, keep: list[str] | None = None) -> DataFrame:
    """Long score table: one row per (row, model)."""
    keep = keep or df.columns
    wide = df.select(*keep, *[c.probability().alias(f"_p_{m}") for m, c in cards.items()])
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"_p_{m}").alias("p")) for m in cards])
    return wide.select(*keep, F.explode(pairs).alias("_s")).select(*keep, "_s.model", "_s.p")
