"""Encoders with tables as state: rules, odd rows, save and load, and names of the design."""

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import functions as F

from decisionkit.operators.fitted import LevelEncoder, NumberEncoder, design_names
from decisionkit.session import scratch_path

SCHEMA = "id int, a double, b double, flat double, void double, job string, none string"


def frame(spark):
    jobs = ["x"] * 12 + ["y"] * 12 + ["rare"] * 3 + [None] * 2 + ["z"]
    rows = [(i, None if i % 7 == 0 else float(i % 5), float("nan") if i == 3 else i * 1.5, 2.0, None, job, None) for i, job in enumerate(jobs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def fitted(spark):
    numbers, levels = ["a", "b", "flat", "void"], ["job", "none"]
    stages = [
        NumberEncoder(inputCols=numbers, outputCols=[f"{c}_n" for c in numbers]),
        LevelEncoder(inputCols=levels, outputCols=[f"{c}_i" for c in levels], minFrequency=5),
        OneHotEncoder(inputCols=["job_i", "none_i"], outputCols=["job_h", "none_h"], handleInvalid="keep", dropLast=True),
    ]
    return Pipeline(stages=stages).fit(frame(spark))


def test_rules_of_the_encoders(spark):
    rows = frame(spark).toPandas().set_index("id").sort_index()
    got = fitted(spark).transform(frame(spark)).toPandas().set_index("id").sort_index()
    for c in ("a", "b"):
        filled = rows[c].fillna(rows[c].median())
        want = (filled - filled.mean()) / filled.std(ddof=0)
        assert all(math.isclose(x, y, abs_tol=1e-12) for x, y in zip(got[f"{c}_n"], want))
    assert set(got["flat_n"]) == {0.0} and set(got["void_n"]) == {0.0}
    codes = {None: 1, "x": 1, "y": 2, "rare": 0, "z": 0}  # __infrequent__, x, y; a null counts as x, the smaller of two equal levels
    jobs = [None if not isinstance(j, str) else j for j in rows["job"]]
    assert got["job_i"].tolist() == [codes[j] for j in jobs]
    assert got["job_h"].iloc[0].size == 3 and got["none_h"].iloc[0].size == 1 and got["none_h"].iloc[0].numNonzeros() == 0


def test_unseen_levels_and_clashing_columns(spark):
    new = spark.createDataFrame([(1, None, None, None, 5.0, "new", "new"), (2, 1.0, 1.0, 1.0, 1.0, None, None)], SCHEMA).withColumns({"feature": F.lit("job"), "value": F.lit("x"), "code": F.lit(9)})
    got = {r["id"]: r for r in fitted(spark).transform(new).collect()}
    assert got[1]["job_i"] == 0 and got[2]["job_i"] == 1 and got[1]["none_i"] == 1 and got[1]["none_h"].numNonzeros() == 0
    assert got[1]["code"] == 9 and got[1]["void_n"] == 5.0
    bare = LevelEncoder(inputCols=["job"], outputCols=["i"], minFrequency=1).fit(frame(spark))  # without a rare bucket an unseen level has no column
    hot = OneHotEncoder(inputCols=["i"], outputCols=["h"], handleInvalid="keep", dropLast=True)
    rows = bare.transform(new)
    assert [v["h"].numNonzeros() for v in hot.fit(rows).transform(rows).orderBy("id").collect()] == [0, 1]


def test_saved_stages_give_the_same_columns(spark):
    model, path = fitted(spark), scratch_path(spark, "stages")
    model.write().save(path)
    again = PipelineModel.load(path)
    columns = ["id", "a_n", "b_n", "job_i", "none_i"]
    before, after = (m.transform(frame(spark)).select(columns) for m in (model, again))
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0
    names = [r["name"] for r in design_names(again).orderBy("position").collect()]
    assert names == ["numeric__a", "numeric__b", "numeric__flat", "numeric__void", "categorical__job___infrequent__", "categorical__job_x", "categorical__job_y"]


def test_an_empty_table_fits(spark):
    empty = frame(spark).limit(0)
    model = Pipeline(stages=[NumberEncoder(inputCols=["a"], outputCols=["a_n"]), LevelEncoder(inputCols=["job"], outputCols=["job_i"])]).fit(empty)
    assert model.transform(empty).count() == 0
    row = model.transform(frame(spark).filter("id = 1")).first()
    assert row["a_n"] == 1.0 and row["job_i"] == 1.0
