import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from decisionkit.operators import drift as D
from decisionkit.operators import tuning as T


def tidy(spark, ref, cur):
    pdf = pd.DataFrame({"feature": "f", "value": np.concatenate([ref, cur]).astype(float), "part": ["ref"] * len(ref) + ["cur"] * len(cur)})
    return spark.createDataFrame(pdf)


def test_no_drift_against_itself(spark):
    x = np.random.default_rng(0).normal(size=500)
    row = D.numeric_drift(tidy(spark, x, x)).first()
    assert (row["psi"], row["js"], row["ks_stat"], row["ks_p"]) == (0.0, 0.0, 0.0, 1.0)


def test_shift_is_seen_and_out_of_range_values_count(spark):
    rng = np.random.default_rng(1)
    ref, cur = rng.normal(size=800), rng.normal(3, 1, size=700)
    row = D.numeric_drift(tidy(spark, ref, cur)).first()
    assert row["psi"] > 5
    pooled = np.sort(np.concatenate([ref, cur]))
    gaps = np.abs(np.searchsorted(np.sort(ref), pooled, "right") / 800 - np.searchsorted(np.sort(cur), pooled, "right") / 700)
    assert row["ks_stat"] == pytest.approx(gaps.max(), abs=1e-6)
    assert D.status_board(spark.createDataFrame([("a", 0.3), ("b", 0.1), ("c", 0.0)], "signal string, value double")).select("status").toPandas()["status"].tolist() == ["critical", "warning", "ok"]


def test_psi_by_hand(spark):
    """Ten reference values, one a bin: shares 0.1 each. Current: half in the first bin, half in the last."""
    ref, cur = np.arange(10.0), np.array([-5.0, 0.0, 9.0, 50.0])
    row = D.numeric_drift(tidy(spark, ref, cur)).first()
    assert row["psi"] == pytest.approx(2 * 0.4 * math.log(5) + 8 * (1e-6 - 0.1) * math.log(1e-5), abs=1e-5)


def test_constant_reference_has_no_drift(spark):
    row = D.numeric_drift(tidy(spark, np.ones(50), np.arange(50))).first()
    assert (row["psi"], row["ks_stat"], row["ks_p"]) == (0.0, 0.0, 1.0)


@pytest.mark.parametrize("chi2,df,want", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (11.0705, 5, 0.05), (0.0, 4, 1.0), (18.307038, 10, 0.05), (1600.0, 1600, 0.495299), (1601.0, 1601, 0.495300), (1400.0, 1400, 0.494974), (0.0, 3, 1.0), (4000.0, 2, 0.0)])
def test_chi_square_tail(spark, chi2, df, want):
    got = D.chi_square_tail(spark.createDataFrame([("f", chi2, df)], "feature string, chi2 double, df long")).first()["p_value"]
    assert got == pytest.approx(want, abs=2e-6)


def test_benjamini_hochberg(spark):
    p = [0.01, 0.04, 0.03, 0.5]
    tests = spark.createDataFrame(list(zip("abcd", p)), "feature string, p_value double")
    got = D.benjamini_hochberg(tests).toPandas().set_index("feature")["p_adjusted"].to_dict()
    assert got == {"a": 0.04, "b": pytest.approx(0.053333), "c": pytest.approx(0.053333), "d": 0.5}


def test_runs_restart_after_a_calm_step(spark):
    rows = [(i, b) for i, b in enumerate([True, True, False, True, True, True])]
    table = spark.createDataFrame(rows, "step int, breach boolean")
    got = D.breach_runs(table, "step", "breach").orderBy("step").toPandas()["run_length"].tolist()
    assert got == [1, 2, 0, 1, 2, 3]


def test_search_prunes_and_repeats(spark):
    seen = []

    def loss(params, fold):
        seen.append((params["x"], fold))
        return (math.log(params["x"])) ** 2 + fold

    space = {"x": T.Span(0.01, 10.0, log=True), "n": T.Span(1, 5, whole=True)}
    history = T.search(space, loss, 3, 12, seed=3)
    again = T.search(space, loss, 3, 12, seed=3)
    assert [t.params for t in history] == [t.params for t in again]
    assert all(t.state == "COMPLETE" for t in history[:3]) and any(t.state == "PRUNED" for t in history)
    assert all(0.01 <= t.params["x"] <= 10 and t.params["n"] in range(1, 6) for t in history)
    assert T.trial_table(spark, history).filter("state = 'PRUNED'").count() == sum(t.state == "PRUNED" for t in history)


def test_status_uses_inclusive_limits(spark):
    assert spark.range(1).select(D.status(F.lit(0.25))).first()[0] == "critical"
