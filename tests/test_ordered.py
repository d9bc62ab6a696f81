import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from decisionkit.functions.hashing import hash_bucket, hash_order
from decisionkit.operators.joins import as_of_join
from decisionkit.operators.ordered import ordered_state
from decisionkit.operators.quantiles import exact_quantiles, ordered_distinct
from decisionkit.operators.splits import stratified_split


def skewed(n=600, seed=1):
    """A third of the rows share one key; some keys are NULL."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c", None], n))
    return pd.DataFrame({"id": np.arange(n), "key": key, "day": rng.integers(0, 40, n), "v": rng.integers(0, 9, n)})


@pytest.mark.parametrize("hot_rows", [5, 10_000])
def test_ordered_state_matches_pandas(spark, hot_rows):
    pdf = skewed()
    df = spark.createDataFrame(pdf, "id bigint, key string, day bigint, v bigint").repartition(7)
    got = ordered_state(
        df, ["key"], ["day", "id"], F.col("day"), rank="rn", sums={"s": F.col("v")},
        lasts={"even": F.when(F.col("v") % 2 == 0, F.struct("id", "v"))}, total="n", hot_rows=hot_rows,
    ).toPandas().sort_values("id")
    want = pdf.sort_values(["day", "id"]).assign(k=lambda d: d["key"].fillna("~"))
    groups = want.groupby("k")
    want["rn"] = groups.cumcount() + 1
    want["s"] = groups["v"].cumsum() - want["v"]
    want["n"] = groups["id"].transform("size")
    last = want["id"].where(want["v"] % 2 == 0)
    want["even"] = last.groupby(want["k"]).transform(lambda s: s.ffill().shift())
    want = want.sort_values("id")
    assert got["rn"].tolist() == want["rn"].tolist()
    assert got["s"].tolist() == want["s"].tolist()
    assert got["n"].tolist() == want["n"].tolist()
    seen = [None if e is None else e["id"] for e in got["even"]]
    assert seen == [None if np.isnan(e) else int(e) for e in want["even"]]


def test_ordered_state_over_the_whole_table(spark):
    df = spark.range(1000).withColumn("h", hash_order(1, "id"))
    got = ordered_state(df, [], ["h", "id"], hash_bucket(F.col("h")), rank="rn", total="n").toPandas()
    want = got.sort_values(["h", "id"])["rn"].tolist()
    assert want == list(range(1, 1001)) and set(got["n"]) == {1000}


def test_partitioning_does_not_change_the_state(spark):
    df = spark.createDataFrame(skewed(), "id bigint, key string, day bigint, v bigint")
    runs = [
        ordered_state(df.repartition(n), ["key"], ["day", "id"], F.col("day"), rank="rn", hot_rows=h).select("id", "rn").toPandas().sort_values("id")["rn"].tolist()
        for n, h in ((1, 5), (9, 5), (3, 10_000))
    ]
    assert runs[0] == runs[1] == runs[2]


@pytest.mark.parametrize("ties", [False, True])
def test_exact_quantiles(spark, ties):
    rng = np.random.default_rng(3)
    values = rng.normal(size=2000)
    if ties:
        values[:700] = 1.25
    pdf = pd.DataFrame({"g": rng.choice(["x", "y"], 2000), "v": values})
    probs = [0, 0.013, 0.25, 0.5, 0.9, 1]
    got = exact_quantiles(spark.createDataFrame(pdf).repartition(5), ["g"], "v", probs).toPandas().set_index("g")["quantiles"]
    for g, part in pdf.groupby("g"):
        np.testing.assert_allclose(got[g], np.quantile(part["v"], probs), rtol=0, atol=1e-12)


def test_quantiles_ignore_nulls_and_empty_input(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert exact_quantiles(df, [], "v", [0.5]).first()[0] == [2.0]
    assert exact_quantiles(df.filter("v > 10"), ["v"], "v", [0.5]).count() == 0


def test_running_counts_of_distinct_values(spark):
    df = spark.createDataFrame(pd.DataFrame({"v": np.repeat(np.arange(400) * 1.0, 3)}))
    got = ordered_distinct(df, [], "v", {"n": F.lit(1)}).toPandas().sort_values("v")
    assert got["n_before"].tolist() == [3 * i for i in range(400)] and set(got["n_all"]) == {1200}


@pytest.mark.parametrize("hot_rows", [3, 10_000])
def test_as_of_join_sees_only_earlier_rows(spark, hot_rows):
    decisions = spark.createDataFrame([(1, "u", 10), (2, "u", 20), (3, "w", 5)], "id long, u string, t long")
    history = spark.createDataFrame(
        [(1, "u", 10, "same"), (2, "u", 9, "early"), (3, "u", 15, "mid"), (4, "w", 6, "after")] + [(9, "u", i, "old") for i in range(5)],
        "hid long, u string, t long, what string",
    ).withColumn("id", F.col("hid"))
    got = as_of_join(decisions, history, "u", "t", "id", ["what"], F.col("t"), hot_rows=hot_rows)
    assert {r["id"]: r["latest"] and r["latest"]["what"] for r in got.collect()} == {1: "early", 2: "mid", 3: None}


def test_no_shuffle_by_the_hot_keys_alone(spark):
    """Rows joined to their hot keys by a shuffle would all meet in the tasks of a few keys."""
    rows = spark.range(1000).select("id", (F.col("id") % 50 == 0).cast("int").alias("y"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables above it
    try:
        plan = stratified_split(rows, "id", hot_rows=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("_bucket" in line for line in shuffles)
    assert not any("coalesce(y" in line and "_bucket" not in line for line in shuffles)
