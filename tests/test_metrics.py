import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from decisionkit.operators import metrics as M
from decisionkit.operators import policy as P
from decisionkit.operators import resampling as B
from decisionkit.operators.calibration import quantile_curve


def scores(n=500, seed=2, hot=0.34):
    rng = np.random.default_rng(seed)
    p = np.round(rng.random(n), 2)
    p[rng.random(n) < hot] = 0.2  # a third of the rows share one score
    return pd.DataFrame({"id": np.arange(n), "p": p, "y": (rng.random(n) < p).astype(int)})


def brute_auc(pdf, score="p"):
    pos, neg = pdf[pdf["y"] == 1][score].to_numpy(), pdf[pdf["y"] == 0][score].to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_ranking_metrics(spark):
    pdf = scores()
    df = spark.createDataFrame(pdf)
    got = M.ranking_metrics(df, []).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(pdf), abs=1e-6)
    cells = pdf.groupby("p")["y"].agg(["sum", "size"]).sort_index(ascending=False).cumsum()
    steps = cells["sum"].diff().fillna(cells["sum"].iloc[0]) / pdf["y"].sum()
    assert got["average_precision"] == pytest.approx((steps * cells["sum"] / cells["size"]).sum(), abs=1e-6)


def test_auc_is_invariant_under_monotone_maps(spark):
    df = spark.createDataFrame(scores())
    mapped = df.withColumn("p", F.round(F.col("p") * F.col("p"), 6))
    assert M.ranking_metrics(df, []).first() == M.ranking_metrics(mapped, []).first()


def test_value_auc_handles_any_range(spark):
    pdf = scores().assign(value=lambda d: d["p"] * 1e6 + d["id"] % 7, feature="f")
    got = M.value_auc(spark.createDataFrame(pdf), ["feature"]).first()["roc_auc"]
    assert got == pytest.approx(brute_auc(pdf, "value"), abs=1e-6)


def test_threshold_table_matches_direct_counts(spark):
    pdf = scores()
    table = M.threshold_table(spark.createDataFrame(pdf)).toPandas()
    assert len(table) == 76
    for row in table.itertuples():
        hit = pdf["p"] >= row.threshold
        assert (row.tp, row.fp) == ((hit & (pdf["y"] == 1)).sum(), (hit & (pdf["y"] == 0)).sum())
        assert row.cost == row.fp + 5 * row.fn


def test_metrics_without_positives_or_negatives(spark):
    df = spark.createDataFrame([(0.2, 0), (0.7, 0)], "p double, y int")
    row = M.decision_metrics(M.confusion(df, [], 0.5)).first()
    assert (row["precision"], row["recall"], row["f1"], row["balanced_accuracy"]) == (0.0, 0.0, 0.0, 0.5)
    only = spark.createDataFrame([(0.2, 1)], "p double, y int")
    assert M.decision_metrics(M.confusion(only, [], 0.5)).first()["specificity"] is None
    assert M.ranking_metrics(only, []).first()["roc_auc"] is None


def test_cheapest_threshold_prefers_the_lowest(spark):
    table = spark.createDataFrame([(0.3, 5.0), (0.2, 5.0), (0.1, 9.0)], "threshold double, cost double")
    assert P.best_threshold(table).first()["threshold"] == 0.2
    assert P.mark_selected(table).filter("selected").first()["threshold"] == 0.2


@pytest.mark.parametrize("k", [0, 1, 50, 170, 500, 900])
def test_top_k_takes_exactly_k_with_key_ties(spark, k):
    pdf = scores()
    got = P.top_k_flags(spark.createDataFrame(pdf), F.lit(k), "id").toPandas()
    want = set(pdf.sort_values(["p", "id"], ascending=[False, True]).head(k)["id"])
    assert len(got) == 500 and set(got[got["taken"]]["id"]) == want


def test_quantile_curve_counts_every_row(spark):
    curve = quantile_curve(spark.createDataFrame(scores()), [], bins=8).toPandas().sort_values("bin")
    assert curve["n"].sum() == 500 and curve["mean_predicted"].is_monotonic_increasing


def test_bootstrap_weights_average_one(spark):
    df = spark.createDataFrame(scores(2000))
    totals = B.bootstrap_totals(df, "id", 40, {"n": F.lit(1)}).toPandas()
    assert len(totals) == 40 and abs(totals["n"].mean() / 2000 - 1) < 0.02
    again = B.bootstrap_totals(df.repartition(9), "id", 40, {"n": F.lit(1)}).toPandas()
    assert totals.sort_values("replicate")["n"].tolist() == again.sort_values("replicate")["n"].tolist()


def test_bootstrap_draws_once_for_every_key_and_replicate(spark):
    """Each weight comes from 16 bits of its own, not from one number a key; rows of one key share it."""
    rows = [(k % 1500, k % 2) for k in range(1700)]
    got = B.bootstrap_totals(spark.createDataFrame(rows, "id long, y int").repartition(3), "id", 20, {"n": F.lit(1), "y": F.col("y")}).toPandas().sort_values("replicate")
    digests = {k: [hashlib.md5(f"boot|{b}|{k}".encode()).digest() for b in range(3)] for k in range(1500)}
    weight = lambda k, r: sum(int.from_bytes(digests[k][r // 8][r % 8 * 2 : r % 8 * 2 + 2]) >= c for c in B.POISSON_CUTS)
    assert got["n"].tolist() == [sum(weight(k, r) for k, _ in rows) for r in range(20)]
    assert got["y"].tolist() == [sum(weight(k, r) * y for k, y in rows) for r in range(20)]


def test_scores_that_differ_in_the_eighth_digit_are_ranked(spark):
    rows = [(i, 0.5 + i * 1e-8, int(i % 3 == 0 or i > 30)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, p double, y int")
    pairs = [(a, b) for _, a, x in rows for _, b, z in rows if x == 1 and z == 0]
    want = sum(a > b for a, b in pairs) / len(pairs)
    assert M.ranking_metrics(df, []).first()["roc_auc"] == pytest.approx(want, abs=1e-6)
    assert sorted(r["id"] for r in P.top_k_flags(df, F.lit(5), "id").filter("taken").collect()) == [35, 36, 37, 38, 39]


def test_ties_at_the_cut_with_an_outlying_key(spark):
    df = spark.createDataFrame([(i, 0.5, 0) for i in [*range(50), 10**15]], "id long, p double, y int")
    assert sorted(r["id"] for r in P.top_k_flags(df, F.lit(7), "id").filter("taken").collect()) == list(range(7))


def test_bootstrap_gives_the_replicates_asked_for(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(300)], "id long, y int")
    totals = B.bootstrap_totals(df, "id", 10, {"n": F.lit(1)}, by=["y"]).toPandas()
    assert sorted(totals["replicate"].unique()) == list(range(10)) and set(totals["y"]) == {0, 1} and len(totals) == 20
