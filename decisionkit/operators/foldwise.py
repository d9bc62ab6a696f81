"""Logistic regressions for many training sets and strengths at once: one scan of the rows per Newton step.

Rows carry a small integer ``part``; a training set is a set of parts. The parts are the folds, or the crossings of outer and inner folds. The state of
the encoders (median, mode, mean, population SD, levels with a bucket for rare ones) is exact and belongs to one training set, so that no row shapes the design of
a model that is judged on it. Every step sums, inside the tasks, the gradient and Hessian of each (set, strength) over the rows of its set; what
leaves a task is of the size of the design, not of the rows.

The driver holds the designs and Hessians: their width is checked against ``MAX_WIDTH`` before any level is gathered. Rows with a null label are
an error; null numbers take the median, null levels the mode; an unseen level counts as rare where its set has a rare bucket, else as none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .encoders import INFREQUENT
from .quantiles import exact_quantiles, tall

MAX_WIDTH, BLOCK = 512, 4096


def _sets_of(part: str, sets: Sequence[frozenset[int]]) -> Column:
    """The ids of the training sets that a row belongs to."""
    parts = max(max(s) for s in sets) + 1
    member = [F.array(*[F.lit(k) for k, s in enumerate(sets) if p in s]).cast("array<int>") for p in range(parts)]
    return F.element_at(F.array(*member), F.col(part).cast("int") + 1)


def _copies(df: DataFrame, part: str, sets: Sequence[frozenset[int]]) -> DataFrame:
    """Each row once per training set; the aggregates over it combine the copies inside the tasks."""
    return df.withColumn("held", F.explode(_sets_of(part, sets))).drop(part)


@dataclass
class Design:
    numeric: list[str]
    categorical: list[str]
    levels: list[tuple[str, str]]  # column of the design -> (feature, level); numeric columns come first
    medians: np.ndarray  # set x numeric
    means: np.ndarray
    sds: np.ndarray
    columns: list[dict[tuple[str, str], int]]  # per set: (feature, level) -> column
    rare: list[dict[str, int]]  # per set: feature -> column of its rare bucket
    modes: list[dict[str, str]]

    @property
    def width(self) -> int:
        return len(self.numeric) + len(self.levels)

    def encoded(self, rows: pd.DataFrame) -> tuple[np.ndarray, dict[str, tuple[np.ndarray, np.ndarray]]]:
        """(numbers, {feature: code of each row, levels}): what the designs of all sets share; a null level has code -1."""
        return rows[self.numeric].to_numpy(np.float64), {f: pd.factorize(rows[f]) for f in self.categorical}

    def matrix(self, rows: pd.DataFrame, held: int) -> np.ndarray:
        """The rows as one training set's design sees them, with a column of ones at the end."""
        return self.matrix_of(self.encoded(rows), held)

    def matrix_of(self, encoded: tuple[np.ndarray, dict[str, tuple[np.ndarray, np.ndarray]]], held: int, inside: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The same for the rows ``inside`` of encoded rows."""
        numbers = encoded[0][inside]
        out = np.zeros((len(numbers), self.width + 1))
        out[:, -1] = 1.0
        numbers = np.where(np.isnan(numbers), self.medians[held], numbers)
        out[:, : len(self.numeric)] = (numbers - self.means[held]) / self.sds[held]
        for feature, (codes, levels) in encoded[1].items():
            none = self.rare[held].get(feature, -1)
            place = np.array([self.columns[held].get((feature, v), none) for v in [*levels, self.modes[held].get(feature)]])
            at = place[codes[inside]]
            out[np.flatnonzero(at >= 0), at[at >= 0]] = 1.0
        return out


def fit_design(rows: DataFrame, part: str, sets: Sequence[frozenset[int]], numeric: Sequence[str], categorical: Sequence[str], min_frequency: int = 10) -> Design:
    numeric, categorical, n = list(numeric), list(categorical), len(sets)
    medians, means, sds = np.zeros((n, len(numeric))), np.zeros((n, len(numeric))), np.ones((n, len(numeric)))
    if numeric:
        numbers = rows.select(part, *[F.col(c).cast("double").alias(c) for c in numeric])
        copies = staged(_copies(tall(numbers, [part], numeric), part, sets).groupBy("held", "feature", "value").agg(F.count(F.lit(1)).alias("n")), "numbers")
        whole = copies.filter("value IS NOT NULL")
        middle = {(r["held"], r["feature"]): r["quantiles"][0] for r in exact_quantiles(whole, ["held", "feature"], "value", [0.5], weight="n").collect()}
        shape = whole.groupBy("held", "feature").agg(F.sum("n").alias("n"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
        spread = whole.join(shape.select("held", "feature", "mean"), ["held", "feature"]).groupBy("held", "feature").agg(F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), 2)).alias("squares"))
        missing = copies.filter("value IS NULL").groupBy("held", "feature").agg(F.sum("n").alias("missing"))
        facts = shape.join(spread, ["held", "feature"]).join(missing, ["held", "feature"], "left").fillna(0, ["missing"]).collect()  # one row per set and feature
        for r in facts:
            h, k, m = r["held"], numeric.index(r["feature"]), middle[r["held"], r["feature"]]
            total = r["n"] + r["missing"]
            mean = (r["mean"] * r["n"] + m * r["missing"]) / total
            square = (r["squares"] + r["n"] * (r["mean"] - mean) ** 2 + r["missing"] * (m - mean) ** 2) / total
            medians[h, k], means[h, k], sds[h, k] = m, mean, np.sqrt(square) if square > 0 else 1.0
    columns, rare, modes, levels = [{} for _ in sets], [{} for _ in sets], [{} for _ in sets], []
    if categorical:
        text = rows.select(part, *[F.col(c).cast("string").alias(c) for c in categorical]).unpivot([part], categorical, "feature", "level")
        counts = staged(_copies(text.filter("level IS NOT NULL"), part, sets).groupBy("held", "feature", "level").agg(F.count(F.lit(1)).alias("n")), "levels")
        best = counts.groupBy("held", "feature").agg(F.min(F.struct((-F.col("n")).alias("neg"), "level"))["level"].alias("mode")).collect()  # one row per set and feature
        for r in best:
            modes[r["held"]][r["feature"]] = r["mode"]
        # a null level takes the mode, and so counts for it
        blank = _copies(text.filter("level IS NULL"), part, sets).groupBy("held", "feature").agg(F.count(F.lit(1)).alias("blank"))
        mode = counts.groupBy("held", "feature").agg(F.min(F.struct((-F.col("n")).alias("neg"), "level"))["level"].alias("mode"))
        filled = counts.join(mode, ["held", "feature"]).join(blank, ["held", "feature"], "left")
        filled = filled.withColumn("n", F.col("n") + F.when(F.col("level") == F.col("mode"), F.coalesce("blank", F.lit(0))).otherwise(0))
        filled = staged(filled.withColumn("encoded", F.when(F.col("n") < min_frequency, F.lit(INFREQUENT)).otherwise(F.col("level"))).select("held", "feature", "level", "encoded"), "encoded")
        kept = filled.select("feature", "encoded").distinct()
        width = kept.count() + len(numeric)
        if width > MAX_WIDTH:
            raise ValueError(f"the design would have {width} columns, more than {MAX_WIDTH}; raise min_frequency")
        levels = sorted((r["feature"], r["encoded"]) for r in kept.collect())
        place = {pair: len(numeric) + k for k, pair in enumerate(levels)}
        for r in filled.filter(F.col("encoded") != INFREQUENT).collect():  # within the width, for each set
            columns[r["held"]][r["feature"], r["level"]] = place[r["feature"], r["encoded"]]
        for r in filled.filter(F.col("encoded") == INFREQUENT).select("held", "feature").distinct().collect():
            rare[r["held"]][r["feature"]] = place[r["feature"], INFREQUENT]
    return Design(numeric, categorical, levels, medians, means, sds, columns, rare, modes)


def narrowed(design: Design, numeric: Sequence[str], categorical: Sequence[str]) -> Design:
    """The design of fewer columns: what is fitted for a column does not depend on the others."""
    at = [design.numeric.index(c) for c in numeric]
    levels = [pair for pair in design.levels if pair[0] in set(categorical)]
    place = {pair: len(at) + k for k, pair in enumerate(levels)}
    columns = [{pair: place[design.levels[k - len(design.numeric)]] for pair, k in own.items() if pair[0] in set(categorical)} for own in design.columns]
    rare = [{f: place[f, INFREQUENT] for f in own if f in set(categorical)} for own in design.rare]
    modes = [{f: v for f, v in own.items() if f in set(categorical)} for own in design.modes]
    return Design(list(numeric), list(categorical), levels, design.medians[:, at], design.means[:, at], design.sds[:, at], columns, rare, modes)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _sums(design: Design, sets: Sequence[frozenset[int]], part: str, label: str, betas: np.ndarray, weight: str | None = None):
    """Per task and model: rows, log loss, gradient and Hessian over the rows of the model's set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, strengths, size = betas.shape
        total = np.zeros((held, strengths, 2 + size + size * size))
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                rows = batch.iloc[at : at + BLOCK]
                own, y_all = rows[part].to_numpy(), rows[label].to_numpy(np.float64)
                w_all = rows[weight].to_numpy(np.float64) if weight else np.ones(len(rows))
                encoded = design.encoded(rows)
                for h, s in enumerate(sets):
                    inside = np.flatnonzero(np.isin(own, list(s)))
                    if not len(inside):
                        continue
                    x, y, w = design.matrix_of(encoded, h, inside), y_all[inside], w_all[inside]
                    z = x @ betas[h].T
                    p = _sigmoid(z)
                    loss = np.logaddexp(0, z) - y[:, None] * z
                    for c in range(strengths):
                        hessian = (x * (w * p[:, c] * (1 - p[:, c]))[:, None]).T @ x
                        total[h, c] += np.concatenate([[w.sum(), w @ loss[:, c]], x.T @ (w * (p[:, c] - y)), hessian.ravel()])
        for h in range(held):
            for c in range(strengths):
                yield pd.DataFrame({"model": [h * strengths + c], "sums": [total[h, c].tolist()]})

    return run


def fit_all(rows: DataFrame, design: Design, part: str, sets: Sequence[frozenset[int]], strengths: Sequence[float], label: str = "y", most_steps: int = 30, tolerance: float = 1e-10, start: np.ndarray | None = None, weight: str | None = None) -> tuple[np.ndarray, int]:
    """(coefficients set x strength x (width + 1), the intercept last; scans). Strength C weighs the summed losses against half the squared coefficients
    without intercept; steps are halved while a loss grows. ``rows`` should be a written table: every step reads it once."""
    size = design.width + 1
    betas = np.zeros((len(sets), len(strengths), size)) if start is None else start
    penalty = np.array([1 / c for c in strengths])
    ridge = np.ones(size)
    ridge[-1] = 0.0
    columns = [F.col(c).cast("double").alias(c) for c in design.numeric] + [F.col(c).cast("string").alias(c) for c in design.categorical]
    narrow = rows.select(part, F.col(label).cast("double").alias(label), *([weight] if weight else []), *columns)
    step, before = np.zeros_like(betas), None
    for scans in range(1, most_steps + 1):
        sums = narrow.mapInPandas(_sums(design, sets, part, label, betas, weight), "model int, sums array<double>").select("model", F.posexplode("sums").alias("at", "x"))
        table = sums.groupBy("model", "at").agg(F.sum("x").alias("x")).toPandas()  # models x (width + 2)^2 numbers
        total = np.zeros((len(sets), len(strengths), 2 + size + size * size))
        total.reshape(-1, total.shape[2])[table["model"], table["at"]] = table["x"]
        loss = total[:, :, 1] + 0.5 * penalty * (betas**2 * ridge).sum(axis=2)
        worse = np.zeros(loss.shape, bool) if before is None else loss > before * (1 + 1e-12) + 1e-9
        if worse.any():
            step = np.where(worse[:, :, None], step / 2, 0.0)
            betas = betas - step
            continue
        before, gain = loss, np.zeros_like(loss)
        for h in range(len(sets)):
            for c in range(len(strengths)):
                gradient = total[h, c, 2 : 2 + size] + penalty[c] * ridge * betas[h, c]
                hessian = total[h, c, 2 + size :].reshape(size, size) + penalty[c] * np.diag(ridge) + 1e-12 * np.eye(size)
                step[h, c] = -np.linalg.solve(hessian, gradient)
                gain[h, c] = -gradient @ step[h, c] / 2
        betas = betas + step
        # a step whose gain is below the rounding of the loss is the last: sums over many rows do not tell smaller ones from noise
        if ((np.abs(step).max(axis=2) < tolerance) | (gain <= np.finfo(float).eps * loss)).all():
            break
    return betas, scans


def fit_from_summary(rows: DataFrame, design: Design, part: str, sets: Sequence[frozenset[int]], strengths: Sequence[float], label: str = "y", most_steps: int = 30, weight: str | None = None) -> tuple[np.ndarray, int]:
    """``fit_all`` from a start near the optimum: (coefficients, scans of the rows).

    The start is fitted to counts, one row per part, label and combination of levels, with every number at its median. Where a level decides the label, a
    coefficient moves by about one a step up to the logarithm of the rows; these steps are made on the counts. The steps that follow read all
    rows, up to the same tolerance.
    """
    cells = rows.groupBy(part, label, *design.categorical).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_weight"))
    cells = staged(cells.withColumns({c: F.lit(None).cast("double") for c in design.numeric}), "cells")
    start = None
    if 4 * cells.count() <= rows.count():
        start, _ = fit_all(cells, design, part, sets, strengths, label, most_steps, tolerance=1e-3, weight="_weight")
        numbers, at_median = start[:, :, : len(design.numeric)], (design.medians - design.means) / design.sds
        start[:, :, -1] += (numbers * at_median[:, None, :]).sum(axis=2)
        start[:, :, : len(design.numeric)] = 0.0
    return fit_all(rows, design, part, sets, strengths, label, most_steps, start=start, weight=weight)


def scored_by(rows: DataFrame, design: Design, betas: np.ndarray, part: str, models: Sequence[Sequence[tuple[int, int]]], keep: Sequence[str]) -> DataFrame:
    """(keep..., held, strength, p): each row scored by the models (set, strength) listed for its part, in one pass."""
    columns = [F.col(c).cast("double").alias(f"_n_{c}") for c in design.numeric] + [F.col(c).cast("string").alias(f"_c_{c}") for c in design.categorical]
    names = {f"_n_{c}": c for c in design.numeric} | {f"_c_{c}": c for c in design.categorical}
    wide = rows.select(*keep, F.col(part).cast("int").alias("_part"), *columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own, rows_ in batch.groupby("_part"):
                features = design.encoded(rows_[list(names)].rename(columns=names))
                for h in sorted({h for h, _ in models[own]}):
                    x = design.matrix_of(features, h)
                    for c in sorted({c for g, c in models[own] if g == h}):
                        yield rows_[list(keep)].assign(held=np.int32(h), strength=np.int32(c), p=np.round(_sigmoid(x @ betas[h, c]), 6))

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in wide.select(*keep).schema]
    return wide.mapInPandas(run, ", ".join(kept) + ", held int, strength int, p double")


def folds_as_sets(folds: int) -> list[frozenset[int]]:
    """Training sets of plain cross-validation: set k leaves fold k out."""
    return [frozenset(range(folds)) - {k} for k in range(folds)]


def out_of_fold(rows: DataFrame, fold: str, folds: int, numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str], design: Design | None = None) -> DataFrame:
    """(keep..., p): each row scored by the regression that did not see its fold, at strength 1; the regressions of all folds share their scans."""
    sets = folds_as_sets(folds)
    design = design or fit_design(rows, fold, sets, numeric, categorical)
    betas, _ = fit_from_summary(rows, design, fold, sets, [1.0])
    return scored_by(rows, design, betas, fold, [[(k, 0)] for k in range(folds)], keep).select(*keep, "p")


def nested_sets(outer: int, inner: int) -> list[frozenset[int]]:
    """Parts are outer * inner crossings. Set o * (inner + 1) + i leaves outer fold o and inner fold i out, set o * (inner + 1) + inner only outer fold o."""
    cells = [(o, i) for o in range(outer) for i in range(inner)]
    return [frozenset(p for p, (a, b) in enumerate(cells) if a != o and b != i) for o in range(outer) for i in range(inner + 1)]
