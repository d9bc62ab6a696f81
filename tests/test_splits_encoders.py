import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from decisionkit.operators import encoders as E
from decisionkit.operators import splits as S


def rows(spark, n=400):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"id": np.arange(n), "y": (rng.random(n) < 0.2).astype(int),
                        "cat": np.where(rng.random(n) < 0.34, "hot", rng.choice(list("abcdefgh"), n)), "x": rng.normal(size=n)})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("hot_rows", [20, 100_000])
def test_split_is_complete_stratified_and_stable(spark, hot_rows):
    pdf, df = rows(spark)
    got = S.stratified_split(df.repartition(5), "id", hot_rows=hot_rows).toPandas()
    assert sorted(got["id"]) == list(range(400))
    for _, part in got.groupby("y"):
        n = len(part)
        sizes = part["split"].value_counts()
        assert sizes["development"] == n * 6 // 10 and sizes["development"] + sizes["validation"] == n * 8 // 10
    other = S.stratified_split(df.repartition(2), "id", hot_rows=7).toPandas()
    assert got.set_index("id")["split"].to_dict() == other.set_index("id")["split"].to_dict()


def test_cuts_split_like_ranks_without_moving_rows(spark):
    _, df = rows(spark)
    df = df.withColumn("y", F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") == 5, 7).otherwise(F.col("y")))  # a null class, and one of a single row
    cut = S.split_at_cuts(df.repartition(5), "id", seed=43)
    ranked = S.stratified_split(df, "id", seed=43, hot_rows=50).select("id", "split").toPandas()
    got = cut.select("id", "split").toPandas()
    assert sorted(got["id"]) == list(range(400)) and got.set_index("id")["split"].to_dict() == ranked.set_index("id")["split"].to_dict()
    plan = S.split_at_cuts(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_folds_are_balanced(spark):
    _, df = rows(spark)
    counts = S.stratified_folds(df, "id", 5).groupBy("y", "fold").count().toPandas()
    for _, part in counts.groupby("y"):
        assert part["count"].max() - part["count"].min() <= 1


@pytest.mark.parametrize("n", [37, 200, 5000])
def test_sample_quota(spark, n):
    _, df = rows(spark)
    got = S.stratified_sample(df, "id", n, hot_rows=30).toPandas()
    assert len(got) == min(n, 400) and got["id"].is_unique


def test_entity_and_nested_splits_do_not_leak(spark):
    _, df = rows(spark)
    split = S.entity_split(df, "cat", 0.5)
    assert S.entity_overlap(split, "cat").first()["shared_entities"] == 0
    nested = S.nested_folds(df, "id", 3, 2).toPandas()
    assert nested.groupby("id")["outer_fold"].nunique().eq(2).all()


def test_fold_state_ignores_held_out_rows(spark):
    pdf, df = rows(spark)
    folded = S.stratified_folds(df, "id", 4)
    changed = folded.withColumn("y", F.when(F.col("fold") == 2, 1 - F.col("y")).otherwise(F.col("y"))).withColumn(
        "x", F.when(F.col("fold") == 2, F.col("x") + 100).otherwise(F.col("x"))
    ).withColumn("cat", F.when(F.col("fold") == 2, F.lit("zzz")).otherwise(F.col("cat")))

    def state(frame):
        target = E.fold_level_counts(frame, "cat", 4, "y").filter("held = 2 AND n > 0").orderBy("cat").collect()
        scale = E.fit_scale(frame, "x", 4).filter("held = 2").collect()
        median = E.fit_medians(frame, "x", 4).filter("held = 2").collect()
        mode = E.fit_modes(frame, "cat", 4).filter("held = 2").collect()
        return target, scale, median, mode

    assert state(folded) == state(changed)


@pytest.mark.parametrize("hot_rows", [10, 100_000])
def test_ordered_statistic_uses_earlier_rows_only(spark, hot_rows):
    pdf, df = rows(spark)
    df = df.withColumn("h", F.col("id") * 1000)
    got = E.ordered_target_statistic(df, "cat", "y", ["h", "id"], hot_rows=hot_rows).toPandas().sort_values("id")
    later = df.withColumn("y", F.when(F.col("id") >= 300, 1 - F.col("y")).otherwise(F.col("y")))
    other = E.ordered_target_statistic(later, "cat", "y", ["h", "id"], hot_rows=hot_rows).toPandas().sort_values("id")
    assert got["ordered_stat"].tolist()[:300] == other["ordered_stat"].tolist()[:300]
    seen = pdf.groupby("cat")["y"]
    want = (seen.cumsum() - pdf["y"] + 1.0) / (seen.cumcount() + 2.0)
    np.testing.assert_allclose(got["ordered_stat"], want)


def test_ordered_statistic_worked_example(spark):
    # by hand, (positives so far + 1) / (rows so far + 2) per colour
    rows = [("red", 0, 1 / 2), ("blue", 1, 1 / 2), ("red", 0, 1 / 3), ("red", 1, 1 / 4), ("blue", 1, 2 / 3), ("red", 1, 2 / 5), ("blue", 0, 3 / 4)]
    df = spark.createDataFrame([(k, c, y) for k, (c, y, _) in enumerate(rows)], "step int, colour string, y int")
    got = E.ordered_target_statistic(df, "colour", "y", ["step"], bucket=F.col("step")).toPandas().sort_values("step")
    np.testing.assert_allclose(got["ordered_stat"], [want for _, _, want in rows])


def test_unseen_levels(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "cat string, y int")
    new = spark.createDataFrame([("a",), ("new",), (None,)], "cat string")
    stat = E.apply_target_statistic(new, E.fit_target_statistic(train, "cat", "y"), "cat").collect()
    assert {r["cat"]: r["target_stat"] for r in stat} == {"a": 0.5, "new": 0.5, None: 0.5}
    code = E.apply_ordinal(new, E.fit_ordinal(train, "cat"), "cat").collect()
    assert {r["cat"]: r["code"] for r in code} == {"a": 0, "new": -1, None: -1}


def test_one_hot_unseen_goes_to_the_rare_bucket_only_if_it_exists(spark):
    data = [(i, "big", i % 2) for i in range(10)] + [(100, "once", 0)]
    df = spark.createDataFrame(data, "id long, cat string, fold int")
    got = {r["id"]: r["encoded"] for r in E.one_hot(df, "cat", 2, 2).collect()}
    assert got[100] is None  # its only row is held out, and no other level is rare
    more = spark.createDataFrame([*data, (101, "rare", 1)], "id long, cat string, fold int")
    got = {r["id"]: r["encoded"] for r in E.one_hot(more, "cat", 2, 2).collect()}
    assert got[100] == E.INFREQUENT and got[0] == "big"


def test_ordinal_codes_of_levels_with_a_common_prefix(spark):
    levels = [f"https://host.example/user_{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(x,) for x in reversed(levels)], "cat string")
    got = E.fit_ordinal(df, "cat").orderBy("code").collect()
    assert [r["cat"] for r in got] == levels and [r["code"] for r in got] == list(range(3000))
    buckets = E.with_text_bucket(df, "cat", "b").groupBy("b").count().agg(F.max("count")).first()[0]
    assert buckets < 200


def test_median_imputation_evaluates_its_rows_once(spark):
    pdf, df = rows(spark)
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda i: (seen.add(1), i % 4)[1], "bigint").asNondeterministic()
    frame = df.select("id", F.when(F.col("id") % 3 != 0, F.col("x")).alias("x"), count("id").alias("fold"))
    got = E.impute_median(frame, "x", 4).toPandas().set_index("id")
    assert seen.value == len(pdf)
    known = pdf[pdf["id"] % 3 != 0]
    for fold, part in got[got.index % 3 == 0].groupby("fold"):
        assert np.allclose(part["x"], known.loc[known["id"] % 4 != fold, "x"].median())
