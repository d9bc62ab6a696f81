import datetime as dt

import numpy as np

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from decisionkit.operators import contracts as C
from decisionkit.operators import models as L
from decisionkit.operators.explain import linear_attributions, permuted
from decisionkit.operators.scoring import FULL, score
from decisionkit.operators.splits import stratified_folds
from decisionkit.session import scratch_path
from decisionkit.sources.frames import contacts
from decisionkit.streaming import monitors as S

NUMERIC, CATEGORICAL = ["age", "balance", "previous"], ["contact"]


@pytest.fixture(scope="module")
def frame(spark, sf):
    return contacts(spark, sf).cache()


def test_frame_is_the_same_on_the_hot_path(spark, sf, frame):
    hot = contacts(spark, sf, hot_rows=2)
    assert hot.exceptAll(frame).count() == 0 and frame.exceptAll(hot).count() == 0


def test_out_of_fold_scores_cover_each_row_once(spark, frame):
    rows = stratified_folds(frame, "contact_id", 2)
    scored = L.out_of_fold(
        rows, lambda df: L.logistic(df, NUMERIC, CATEGORICAL), lambda m, d: L.probability(m, d, NUMERIC, ["contact_id", "y"]), 2
    )
    stats = scored.agg(F.count("p").alias("n"), F.countDistinct("contact_id").alias("d"), F.min("p").alias("lo"), F.max("p").alias("hi")).first()
    assert stats["n"] == stats["d"] == frame.count() and 0 <= stats["lo"] <= stats["hi"] <= 1


def test_saved_artifact_keeps_contract_and_scores(spark, frame):
    model = L.guarded_logistic(frame, NUMERIC, CATEGORICAL)
    row = L.reload_difference(model, frame, "contact_id").first()
    assert row["equal"] and row["rows"] == frame.count()
    with pytest.raises(PySparkException, match="contract violated"):
        model.transform(frame.withColumn("age", F.lit(17))).collect()
    unseen = model.transform(frame.limit(5).withColumn("contact", F.lit("__NEW__")))
    known = model.transform(frame.limit(1)).first()["features"]
    assert [len(r["features"]) for r in unseen.collect()] == [len(known)] * 5


def test_early_stopping_refits_with_the_best_number_of_trees(spark, frame):
    fit, stop = L.inner_holdout(frame, "contact_id")
    model, curve, best = L.early_stopped(fit, stop, NUMERIC, CATEGORICAL, trees=4, rate=0.3, depth=2)
    losses = curve.filter("part = 'stop'").orderBy("trees").toPandas()["loss"].tolist()
    assert best == losses.index(min(losses)) + 1 and len(model.stages[-1].trees) == best


def test_calibration_maps_are_monotone(spark, frame):
    scored = score(frame).select("contact_id", "y", "p")
    for method in (L.platt, L.isotonic):
        got = method(scored, scored, ["contact_id", "p"]).toPandas().sort_values("p")
        assert got["calibrated"].is_monotonic_increasing and got["calibrated"].between(0, 1).all()


def test_logistic_models_score_after_an_observation(spark, frame):
    seen = Observation()
    frame.observe(seen, F.count(F.lit(1)).alias("n")).count()
    scored = L.probability(L.logistic(frame, NUMERIC, CATEGORICAL), frame, NUMERIC, ["contact_id", "y"])
    mapped = L.platt(scored, scored, ["contact_id"])
    stacked = L.stack(scored, scored, ["p"], ["contact_id"])
    assert seen.get["n"] == mapped.filter("calibrated > 0").count() == stacked.filter("p > 0").count()


def test_attributions_add_up(spark, frame):
    total = linear_attributions(frame, FULL, "contact_id").groupBy("contact_id").agg(F.sum("phi").alias("phi"))
    raw = frame.select("contact_id", FULL.raw_score().alias("z"))
    mean = raw.agg(F.avg("z")).first()[0]
    gap = total.join(raw, "contact_id").agg(F.max(F.abs(F.col("phi") - (F.col("z") - mean)))).first()[0]
    assert gap < 1e-9


def test_permutation_keeps_the_values(spark, frame):
    rows = frame.select("contact_id", "balance", "contact")
    mixed = permuted(rows, "contact_id", "balance")
    assert mixed.select("balance").exceptAll(rows.select("balance")).count() == 0
    assert mixed.join(rows.withColumnRenamed("balance", "old"), "contact_id").filter("balance <> old").count() > rows.count() / 2


def write_batches(spark, batches, schema):
    path = scratch_path(spark, "stream")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/part={i}")
    return f"{path}/part=*"


def test_state_writes_need_no_look_up(spark):
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(name, None)
    with S.rocksdb_state(spark):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name, None) == before


@pytest.mark.parametrize("backwards", [False, True])
def test_runs_do_not_depend_on_the_order_of_arrival(spark, backwards):
    """Steps fed in order, or in reverse over three batches, close in event-time order; a signal that goes idle leaves the state."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n - 1)
    schema = "signal string, step timestamp, breach boolean"
    hits = {"a": [True, True, True, False, True, True], "b": [False, True, False, True, True, True]}
    batches = [[(s, day(k + 1), hits[s][k]) for s in hits for k in part] for part in ([0, 1], [2, 3], [4, 5])]
    if backwards:
        batches = [rows[::-1] for rows in batches[::-1]]
    path = write_batches(spark, [*batches, [("clock", day(40), False)], [("clock", day(400), False)]], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = scratch_path(spark, "runs")
    with S.rocksdb_state(spark):
        S.to_table(S.sustained_alerts(stream, "signal", "step", "breach", "10 days", dt.timedelta(days=60)), f"{out}/t", f"{out}/c")
    got = {}
    for r in spark.read.parquet(f"{out}/t").collect():
        got.setdefault(r["signal"], {})[(r["step"] - day(1)).days] = r["run_length"]
    assert {k: [v[i] for i in sorted(v)] for k, v in got.items() if k != "clock"} == {"a": [1, 2, 3, 0, 1, 2], "b": [0, 1, 0, 1, 2, 3]}
    held = S.state_rows(spark, f"{out}/c", stateVarName="run").collect()
    assert {r["key"][0] for r in held} <= {"clock"}
    waiting = S.state_rows(spark, f"{out}/c", stateVarName="pending").collect()
    assert {r["key"][0] for r in waiting} <= {"clock"}


def label_streams(spark, path, schemas, files):
    read = lambda name: spark.readStream.schema(schemas[name]).option("maxFilesPerTrigger", files).parquet(f"{path}/{name}/part=*")
    return S.delayed_labels(read("predictions"), read("labels"), "id", "1 day", "30 days")


def test_label_join_goes_on_after_a_stop(spark):
    """Stopped after some batches and started again on its checkpoint: the rows of one uninterrupted run, and state past the watermark is gone."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    schemas = {"predictions": "id long, predicted_at timestamp", "labels": "id long, labelled_at timestamp, label int"}
    predictions = [[(10 * k + i, day(20 * k + i)) for i in range(5)] for k in range(4)]
    labels = [[(10 * k + i, day(20 * k + i + 3), i % 2) for i in range(4)] for k in range(4)]  # the last of each batch stays without
    path, out = scratch_path(spark, "label-stream"), scratch_path(spark, "label-joined")

    def load(upto):
        for name, parts in (("predictions", predictions), ("labels", labels)):
            for k in upto:
                spark.createDataFrame(parts[k], schemas[name]).coalesce(1).write.parquet(f"{path}/{name}/part={k}")

    with S.rocksdb_state(spark):
        load([0, 1])
        S.to_table(label_streams(spark, path, schemas, 1), f"{out}/t", f"{out}/c")
        halfway = spark.read.parquet(f"{out}/t").count()
        load([2, 3])
        S.to_table(label_streams(spark, path, schemas, 1), f"{out}/t", f"{out}/c")  # the same checkpoint: state comes back from its changelog
        S.to_table(label_streams(spark, path, schemas, 1), f"{out}/whole", f"{out}/c-whole")
    rows = lambda t: sorted(map(tuple, spark.read.parquet(f"{out}/{t}").select("id", "predicted_at", "labelled_at", "label").collect()), key=str)
    assert 0 < halfway < len(rows("t")) and rows("t") == rows("whole")
    assert (4, day(4), None, None) in rows("t") and (0, day(0), day(3), 0) in rows("t")
    kept = S.state_rows(spark, f"{out}/c", joinSide="left")
    assert 0 < kept.count() < 20 and kept.select("value.id").where("id < 20").count() == 0  # predictions whose horizon has passed are gone


def test_drift_status_is_written_by_the_stream(spark):
    draw = np.random.default_rng(3)
    t0 = dt.datetime(2024, 1, 1)
    calm = [(t0 + dt.timedelta(hours=float(h)), float(v)) for h, v in zip(draw.uniform(0, 72, 900), draw.normal(size=900))]
    moved = [(t0 + dt.timedelta(hours=float(h)), float(v) + 2) for h, v in zip(draw.uniform(72, 120, 600), draw.normal(size=600))]
    schema = "ts timestamp, value double"
    path = write_batches(spark, [calm, moved, [(t0 + dt.timedelta(days=30), 0.0)]], schema)
    reference = spark.createDataFrame(calm, schema)
    edges = sorted(v for _, v in calm)[::90] + [max(v for _, v in calm)]
    edges = [edges[0], *edges]  # an edge that repeats
    out = scratch_path(spark, "drift")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    S.drift_monitor(stream, reference, "ts", "value", edges, "1 hour", "1 day", "1 day", f"{out}/t", f"{out}/c")
    got = {r["window_start"]: r for r in spark.read.parquet(f"{out}/t").collect()}
    cuts = np.array(sorted(set(edges)))
    place = lambda v: np.searchsorted(cuts[1:-1], v, side="right")
    p = np.maximum(np.bincount(place([v for _, v in calm]), minlength=len(cuts) - 1) / len(calm), 1e-6)
    for k in range(5):
        own = [v for t, v in calm + moved if k <= (t - t0).total_seconds() / 86400 < k + 1]
        q = np.maximum(np.bincount(place(own), minlength=len(cuts) - 1) / len(own), 1e-6)
        row = got[(t0 + dt.timedelta(days=k)).date()]
        assert row["volume"] == len(own) and abs(row["psi"] - ((q - p) * np.log(q / p)).sum()) < 1e-5
    assert got[dt.date(2024, 1, 5)]["status"] == "critical" and got[dt.date(2024, 1, 2)]["status"] == "ok"


def test_latest_label_wins_and_a_replayed_batch_adds_nothing(spark):
    schema = "id long, label int"
    path = write_batches(spark, [[(1, 0), (2, 1)], [(1, 1), (3, 0)]], schema)
    out = scratch_path(spark, "labels")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    S.label_log(stream, f"{out}/log", f"{out}/c1")
    S.label_log(stream, f"{out}/log", f"{out}/c2")  # the same batches again, as after a lost checkpoint
    log = spark.read.parquet(f"{out}/log")
    assert log.count() == 4
    got = {r["id"]: r["label"] for r in S.latest_labels(log, "id", ["label"]).collect()}
    assert got[2] == 1 and got[3] == 0 and set(got) == {1, 2, 3}


def test_gate_keeps_every_row_once(spark):
    schema = "id long, value double"
    path = write_batches(spark, [[(1, 5.0), (2, 99.0)], [(3, None), (4, 7.0)]], schema)
    out = scratch_path(spark, "gate")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    S.gate(stream, [C.Rule("range", C.out_of_range("value", 0, 30))], f"{out}/good", f"{out}/bad", f"{out}/c")
    good = {r["id"] for r in spark.read.parquet(f"{out}/good").collect()}
    bad = {r["id"] for r in spark.read.parquet(f"{out}/bad").collect()}
    assert (good, bad) == ({1, 4}, {2, 3})


def test_late_rows_are_dropped_from_closed_windows_only(spark):
    schema = "ts timestamp, value double"
    t = dt.datetime.fromisoformat
    first = [(t("2024-01-01 10:00"), 1.0), (t("2024-01-03 10:00"), 1.0)]
    path = write_batches(spark, [first, [(t("2024-01-03 11:00"), 1.0)], [(t("2024-01-01 11:00"), 1.0), (t("2024-01-03 23:00"), 1.0)]], schema)
    stream = S.event_stream(spark, path, spark.createDataFrame(first, schema).schema, files_per_batch=1)
    out = scratch_path(spark, "late")
    rows = S.volume_monitor(stream, "ts", [], F.col("value") > 0, F.col("value").isNull(), "1 hour")
    S.to_table(rows, f"{out}/t", f"{out}/c")
    got = {r["window_start"].day: r["volume"] for r in spark.read.parquet(f"{out}/t").collect()}
    assert got == {1: 1}
