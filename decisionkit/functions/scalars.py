"""Column expressions shared by features, scores and metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_LOSS_EPS = 2.220446e-16
# Right-closed age bands.
AGE_BANDS = [(0, 29, "<30"), (29, 39, "30s"), (39, 49, "40s"), (49, 59, "50s"), (59, None, "60+")]
MISSING_TOKEN = "__MISSING__"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column, den: Column) -> Column:
    """num/den as DOUBLE, NULL when the denominator is 0 or NULL."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def log_odds(p: Column) -> Column:
    return F.ln(p / F.nullif(1.0 - p, F.lit(0.0)))


def clipped(c: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    """Clip that keeps NULL (plain greatest/least would replace it by the bound)."""
    out = c
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(c.isNotNull(), out)


def right_closed_band(c: str | Column, bands=AGE_BANDS) -> Column:
    c = _col(c)
    out = None
    for low, high, name in bands:
        inside = (c > low) if high is None else (c > low) & (c <= high)
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out


def row_log_loss(label: Column, p: Column) -> Column:
    q = F.when(label == 1, p).otherwise(1.0 - p)
    return -F.ln(F.greatest(F.least(q, F.lit(1.0 - LOG_LOSS_EPS)), F.lit(LOG_LOSS_EPS)))


def row_brier(label: Column, p: Column) -> Column:
    return (p - label) * (p - label)


def r6(c: Column) -> Column:
    """Outputs are rounded to six decimals; adding 0.0 turns -0.0 into 0.0."""
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def mean_score(p: Column) -> Column:
    """Mean of six-digit scores, summed in millionths: exact, whatever order the rows are added in."""
    total = F.sum(F.round(p * 1e6).cast("bigint")).cast("double")
    return F.round(total / F.count(p) / 1e6, 9)
