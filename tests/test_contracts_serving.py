import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from decisionkit.operators import contracts as C
from decisionkit.operators import features as X
from decisionkit.operators import inference as V
from decisionkit.operators.scoring import FULL
from decisionkit.session import scratch_path

SCHEMA = "contact_id long, age int, balance double, previous long, contact string"
REQUIRED = ["contact_id", "age", "balance", "previous", "contact"]


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_features_propagate_null_and_keep_rows(spark):
    df = spark.createDataFrame(
        [(1, None, 10.0, -1, 0, 3), (2, 10, 20.0, 5, 1, 2), (3, 29, 5.0, 0, 0, 0)],
        "id long, age int, balance double, pdays int, previous int, prior_contacts_in_campaign int",
    )
    got = {r["id"]: r for r in X.add_domain_features(df).collect()}
    assert got[1]["balance_per_age"] is None and got[1]["age_band"] is None and got[1]["pdays_clean"] is None
    assert got[2]["balance_per_age"] == pytest.approx(20 / 18) and got[2]["contact_pressure"] == 1.0
    assert got[3]["age_band"] == "<30" and got[3]["was_previously_contacted"] == 1
    assert X.add_domain_features(df.limit(0)).columns == X.add_domain_features(df).columns
    with pytest.raises(ValueError, match="previous"):
        X.guarded_domain_features(df.drop("previous"))
    with pytest.raises(PySparkException, match="no age above 0"):
        X.guarded_domain_features(df.withColumn("age", F.lit(0))).collect()


def test_campaign_below_one_fails(spark):
    df = spark.createDataFrame([(1, 0, 3.0)], "id long, campaign int, duration double")
    with pytest.raises(PySparkException, match="attempt number"):
        X.prepare_precontact(df).collect()


def test_quarantine_splits_rows_with_reasons(spark):
    df = batch(spark, (1, 20, 1.0, 0, "x"), (2, 999, 1.0, 0, "x"), (3, None, -5.0, 0, None))
    rules = [C.Rule("age", C.out_of_range("age", 18, 100)), C.Rule("contact", C.not_in_vocabulary("contact", ["x"], nulls_allowed=False))]
    good, bad = C.quarantine(df, rules)
    assert [r["contact_id"] for r in good.collect()] == [1]
    assert {r["contact_id"]: r["reasons"] for r in bad.collect()} == {2: ["age"], 3: ["age", "contact"]}
    with pytest.raises(PySparkException, match="contract violated: age"):
        C.fail_fast(df, rules).collect()
    report = {r["check"]: r["violations"] for r in C.quality_report(df, rules).collect()}
    assert report == {"age": 2, "contact": 1}


def test_type_sentinel_and_finite_checks(spark):
    df = spark.createDataFrame([("12", -1, 1.0), ("x", -2, float("inf")), (None, 3, float("nan"))], "a string, p int, r double")
    hits = df.select(C.not_numeric("a"), C.not_sentinel_or_range("p"), C.not_finite("r")).collect()
    assert [tuple(h) for h in hits] == [(False, False, False), (True, True, True), (False, False, True)]


def test_guarded_scoring(spark):
    good = batch(spark, (1, 40, 100.0, 0, "1-URGENT"), (2, 50, -3.0, 4, "5-LOW"))
    out = V.predict_batch(good, FULL, 0.14, "contact_id", REQUIRED)
    assert set(out.columns) == {"contact_id", "subscription_probability", "prioritize_call", "model_threshold"}
    assert all(0 <= r["subscription_probability"] <= 1 for r in out.collect())
    with pytest.raises(ValueError, match=r"missing=\['age'\]"):
        V.predict_batch(good.drop("age"), FULL, 0.14, "contact_id", REQUIRED)
    with pytest.raises(ValueError, match=r"extra=\['more'\]"):
        V.predict_batch(good.withColumn("more", F.lit(1)), FULL, 0.14, "contact_id", REQUIRED)
    with pytest.raises(ValueError, match="batch is empty"):
        V.predict_batch(good.limit(0), FULL, 0.14, "contact_id", REQUIRED)
    with pytest.raises(ValueError, match="age outside"):
        V.predict_batch(good.withColumn("age", F.lit(999)), FULL, 0.14, "contact_id", REQUIRED)
    with pytest.raises(ValueError, match=r"usable number in columns \['age'\]"):
        V.predict_batch(good.withColumn("age", F.lit("old")), FULL, 0.14, "contact_id", REQUIRED)


def test_test_split_is_scored_once(spark):
    rows = batch(spark, (1, 40, 100.0, 0, "1-URGENT"), (2, 50, -3.0, 4, "5-LOW")).withColumn("y", F.col("contact_id").cast("int") % 2)
    path = scratch_path(spark, "runs")
    assert V.evaluate_sealed(rows, FULL, 0.14, path, "c1").count() == 1
    with pytest.raises(PermissionError):
        V.evaluate_sealed(rows, FULL, 0.14, path, "c1")
    assert V.evaluate_sealed(rows, FULL, 0.14, path, "c2").count() == 1


def test_pipeline_scores_appear_only_when_the_batch_is_good(spark, sf):
    from decisionkit.operators import models as L
    from decisionkit.operators.splits import stratified_split
    from decisionkit.sources.frames import contacts

    rows = stratified_split(contacts(spark, sf), "contact_id").cache()
    numeric, path = ["age", "balance", "previous"], scratch_path(spark, "scores")
    L.guarded_logistic(rows.filter("split = 'development'"), numeric, ["contact"]).write().save(f"{path}/model")
    batch = rows.filter("split = 'test'").drop("y", "split")
    score = lambda df, run: V.score_with_pipeline(df, f"{path}/model", 0.2, "contact_id", f"{path}/out", run, ["balance"])
    bad = {"age": batch.withColumn("age", F.when(F.col("contact_id") % 7 == 0, 300).otherwise(F.col("age"))), "no number in balance": batch.withColumn("balance", F.lit("much")), "no key": batch.withColumn("contact_id", F.lit(None).cast("long")), "empty": batch.limit(0)}
    for what, frame in bad.items():
        with pytest.raises(ValueError, match=what):
            score(frame, "one")
        assert V.read_scores(spark, f"{path}/out") is None
    assert score(batch, "one")["rows"] == batch.count()
    with pytest.raises(PermissionError):
        score(batch, "one")
    half = batch.filter("contact_id % 2 = 0")
    score(half, "two")
    got = V.read_scores(spark, f"{path}/out")
    assert got.columns == ["contact_id", "subscription_probability", "prioritize_call", "model_threshold"]
    assert got.count() == batch.count() + half.count()


def test_sketches_of_loads_merge_within_their_bounds(spark):
    from decisionkit.operators import sketches as K

    rows = spark.range(60_000).select((F.col("id") % 6).alias("load"), (F.col("id") % 2).alias("g"), F.when(F.col("id") % 10 != 0, F.pmod(F.xxhash64("id"), F.lit(10_007))).alias("value"), (F.col("id") % 5000).alias("user"))
    path = scratch_path(spark, "sketches")
    K.load_sketches(rows, "load", ["g"], "value", "user").write.parquet(path)
    merged = K.merged_sketches(spark.read.parquet(path), ["g"])
    assert {(r["g"], r["rows"]) for r in merged.collect()} == {(0, 30_000), (1, 30_000)}
    for r in K.sketched_quantiles(merged, ["g"], [0.0, 0.25, 0.5, 1.0]).collect():
        exact = rows.filter(F.col("g") == r["g"]).agg(F.percentile("value", F.lit(r["probability"]))).first()[0]
        assert r["low"] <= r["estimate"] <= r["high"] and r["low"] - 1 <= exact <= r["high"] + 1
    for r in K.sketched_distinct(merged, ["g"]).collect():
        assert r["low"] <= 2500 <= r["high"]
    assert K.sketched_quantiles(K.merged_sketches(spark.read.parquet(path).limit(0), ["g"]), ["g"], [0.5]).count() == 0
