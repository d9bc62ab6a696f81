"""All folds and strengths in one scan a step, against single fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from decisionkit.operators import foldwise as W
from decisionkit.operators import models as L
from decisionkit.operators.fitted import NumberEncoder
from decisionkit.plans import modelling

ROWS = 900


@pytest.fixture(scope="module")
def frame(spark):
    draw = np.random.default_rng(4)
    rows = []
    for i in range(ROWS):
        a, b = draw.normal(), draw.exponential() * 50
        level = draw.choice(["x", "y", "z", "rare1", "rare2", None], p=[0.4, 0.3, 0.18, 0.01, 0.01, 0.1])
        z = 0.8 * a - 0.02 * b + (0.7 if level == "y" else 0)
        rows.append((i, int(draw.random() < 1 / (1 + np.exp(-z))), i % 3, float(a) if i % 11 else None, float(b), None if level is None else str(level)))
    return spark.createDataFrame(rows, "id long, y int, fold int, a double, b double, level string").cache()


def test_design_is_fitted_on_its_own_set(frame):
    sets = W.folds_as_sets(3)
    design, rows = W.fit_design(frame, "fold", sets, ["a", "b"], ["level"]), frame.toPandas()
    for k in range(3):
        own = rows[rows["fold"] != k]
        filled = own["a"].fillna(own["a"].median())
        assert design.medians[k][0] == pytest.approx(own["a"].median()) and design.means[k][0] == pytest.approx(filled.mean()) and design.sds[k][0] == pytest.approx(filled.std(ddof=0))
        counts = own["level"].fillna(own["level"].mode()[0]).value_counts()
        assert {v for f, v in design.columns[k]} == set(counts[counts >= 10].index)
        x = design.matrix(rows, k)
        assert np.abs(x[rows["fold"] != k][:, :2].mean(axis=0)).max() < 1e-9 and x.shape == (ROWS, design.width + 1)
        rare = rows["level"].isin(["rare1", "rare2"]).to_numpy()
        assert (x[rare][:, design.rare[k]["level"]] == 1).all() and (x[:, 2:-1].sum(axis=1) == 1).all()
    with pytest.raises(ValueError, match="columns"):
        W.fit_design(frame.withColumn("level", F.col("id").cast("string")), "fold", sets, [], ["level"], min_frequency=1)


def test_coefficients_equal_single_fits(spark, frame):
    sets, strengths = W.folds_as_sets(3), [0.05, 1.0]
    design = W.fit_design(frame, "fold", sets, ["a", "b"], ["level"])
    betas, scans = W.fit_all(frame, design, "fold", sets, strengths)
    assert scans < 15
    rows = frame.toPandas()
    for k in range(3):
        own = rows[rows["fold"] != k]
        x = design.matrix(own, k)[:, :-1]
        table = spark.createDataFrame([(int(y), v.tolist()) for y, v in zip(own["y"], x)], "y int, v array<double>").select("y", array_to_vector("v").alias("features"))
        for c, strength in enumerate(strengths):
            fit = LogisticRegression(labelCol="y", maxIter=500, tol=1e-12, regParam=1 / (strength * len(own)), standardization=False).fit(table)
            assert np.abs(np.append(fit.coefficients.toArray(), fit.intercept) - betas[k, c]).max() < 1e-6


def test_weighted_coefficients_equal_single_fits(spark, frame):
    weighted = frame.withColumn("w", (1 + F.col("id") % 4).cast("double"))
    sets = W.folds_as_sets(3)
    design = W.fit_design(frame, "fold", sets, ["a", "b"], ["level"])
    betas, _ = W.fit_from_summary(weighted, design, "fold", sets, [1.0], weight="w")
    rows = weighted.toPandas()
    own = rows[rows["fold"] != 1]
    table = spark.createDataFrame([(int(y), float(w), v.tolist()) for y, w, v in zip(own["y"], own["w"], design.matrix(own, 1)[:, :-1])], "y int, w double, v array<double>").select("y", "w", array_to_vector("v").alias("features"))
    fit = LogisticRegression(labelCol="y", weightCol="w", maxIter=500, tol=1e-12, regParam=1 / own["w"].sum(), standardization=False).fit(table)
    assert np.abs(np.append(fit.coefficients.toArray(), fit.intercept) - betas[1, 0]).max() < 1e-6


def test_a_start_from_counts_saves_scans_and_changes_nothing(spark):
    """A level that decides the label moves its coefficient by one a step; at any number of rows these steps are made on the counts."""
    draw = np.random.default_rng(6)
    rows = [(i, int(i % 4 == 0 and draw.random() < 0.4), i % 3, float(draw.normal()) if i % 7 else None, "abcd"[i % 4] if i % 13 else None) for i in range(40_000)]
    frame = spark.createDataFrame(rows, "id long, y int, fold int, a double, level string").cache()
    sets, strengths = W.folds_as_sets(3), [0.1, 10.0, 1e4]
    design = W.fit_design(frame, "fold", sets, ["a"], ["level"])
    plain, many = W.fit_all(frame, design, "fold", sets, strengths)
    betas, scans = W.fit_from_summary(frame, design, "fold", sets, strengths)
    assert np.abs(betas - plain).max() < 1e-6 and scans <= 8 < many


def test_each_row_is_scored_by_the_models_of_its_part(frame):
    sets = W.folds_as_sets(3)
    design = W.fit_design(frame, "fold", sets, ["a"], ["level"])
    betas, _ = W.fit_all(frame, design, "fold", sets, [1.0, 5.0])
    got = W.scored_by(frame, design, betas, "fold", [[(k, 0), (k, 1)] for k in range(3)], ["id", "y", "fold"]).toPandas()
    assert len(got) == 2 * ROWS and (got["held"] == got["fold"]).all() and set(got["strength"]) == {0, 1}
    row = got[(got["id"] == 5) & (got["strength"] == 1)].iloc[0]
    x = design.matrix(frame.filter("id = 5").toPandas(), int(row["held"]))
    assert row["p"] == pytest.approx(float(1 / (1 + np.exp(-x @ betas[int(row["held"]), 1]))[0]), abs=1e-6)


def test_nested_sets_leave_out_what_they_judge():
    sets = W.nested_sets(4, 3)
    assert len(sets) == 16
    for o in range(4):
        for i in range(3):
            assert all(p // 3 != o and p % 3 != i for p in sets[o * 4 + i]) and len(sets[o * 4 + i]) == 6
        assert sets[o * 4 + 3] == {p for p in range(12) if p // 3 != o}


def test_a_narrowed_design_is_the_design_of_fewer_columns(spark):
    rows = [(i, i % 2, i % 3, float(i % 11), float(i % 5) if i % 7 else None, "abc"[i % 3] if i % 13 else None, "rare" if i % 50 == 0 else "xy"[i % 2]) for i in range(400)]
    frame = spark.createDataFrame(rows, "id long, y int, fold int, a double, b double, level string, other string")
    whole = W.fit_design(frame, "fold", W.folds_as_sets(3), ["a", "b"], ["level", "other"])
    own = W.fit_design(frame, "fold", W.folds_as_sets(3), ["b"], ["other"])
    part = W.narrowed(whole, ["b"], ["other"])
    assert (part.levels, part.columns, part.rare, part.modes) == (own.levels, own.columns, own.rare, own.modes)
    assert np.allclose([part.medians, part.means, part.sds], [own.medians, own.means, own.sds])


def test_folds_fitted_together_score_as_folds_fitted_one_by_one(spark):
    draw = np.random.default_rng(8)
    rows = [(i, int(draw.random() < 0.2 + 0.2 * (i % 3)), i % 2, float(draw.normal()), "abc"[i % 3]) for i in range(900)]
    frame = spark.createDataFrame(rows, "contact_id long, y int, fold int, a double, level string").cache()
    together = W.out_of_fold(frame, "fold", 2, ["a"], ["level"], ["contact_id", "fold"]).toPandas().set_index("contact_id").sort_index()
    single = L.out_of_fold(frame, lambda d: L.logistic(d, ["a"], ["level"]), lambda m, d: L.probability(m, d, ["a"], ["contact_id"]), 2).toPandas().set_index("contact_id").sort_index()
    assert len(together) == 900 and np.abs(together["p"] - single["p"]).max() < 1e-4


def test_a_search_fits_the_encoders_once_a_fold(spark, sf, monkeypatch):
    fits, fit = [], NumberEncoder._fit
    monkeypatch.setattr(NumberEncoder, "_fit", lambda self, df: (fits.append(1), fit(self, df))[1])
    params = {"trees": 1, "depth": 2, "rate": 0.3, "min_leaf": 5, "subsample": 1.0}
    monkeypatch.setattr(modelling.T, "search", lambda space, loss, folds, trials, spark: [loss(params, 0) for _ in range(4)])
    losses = modelling.searched(spark, sf)
    assert len(fits) == modelling.FOLDS and len(set(losses)) == 1
