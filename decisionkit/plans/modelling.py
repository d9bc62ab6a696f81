"""Fitted models: scores vary with the learner, so most of these have no SQL twin; tests hold their invariants."""

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..operators import foldwise as W
from ..operators import imbalance as I
from ..operators import inference as V
from ..operators import metrics as M
from ..operators import models as L
from ..operators import tuning as T
from ..operators.aggregates import dispersion, melt_metrics
from ..operators.calibration import expected_calibration_error, fixed_curve
from ..operators.encoders import apply_target_statistic, fit_target_statistic, ordered_target_statistic
from ..operators.features import FAMILIES
from ..operators.fitted import LevelEncoder, NumberEncoder
from ..operators.joins import align_scores
from ..operators.scoring import FULL, SCORECARDS, score, score_many
from ..operators.splits import split_at_cuts, stratified_folds, stratified_split
from ..session import scratch_path, staged
from ..sources.frames import contacts
from .base import CONTACTS, LEVEL_SQL, MODELS, P_CONTACT, P_FULL, P_HISTORY, SPLITS, hash_sql, query

NUMERIC = ["age", "balance", "prior_contacts_in_campaign", "previous", "contact_pressure", "balance_per_age", "pdays_clean"]
CATEGORICAL = ["job", "contact", "poutcome", "age_band"]
KEEP = ["contact_id", "y"]
CUT = 0.14
FOLDS = 3
REPORT = ["log_loss", "brier", "roc_auc", "average_precision", "balanced_accuracy", "f1"]


def split_frames(spark, sf_dir):
    """(development, validation) with engineered features; the test rows are not touched here."""
    frame = L.modelling_frame(split_at_cuts(staged(contacts(spark, sf_dir), "contacts"), "contact_id").filter("split <> 'test'"))
    return frame.filter("split = 'development'"), frame.filter("split = 'validation'")


def development_frame(spark, sf_dir):
    """The development rows alone, with engineered features."""
    return L.modelling_frame(split_at_cuts(staged(contacts(spark, sf_dir), "contacts"), "contact_id").filter("split = 'development'"))


def predict(model, df, keep=KEEP, name="p"):
    return L.probability(model, df, NUMERIC, keep, name)


def report(scored, name):
    table = M.model_report(scored.withColumn("model", F.lit(name)), ["model"], CUT)
    return table.select("model", *REPORT)


def fitted_report(spark, sf_dir, name, fit):
    development, validation = split_frames(spark, sf_dir)
    return report(staged(predict(fit(development), validation), "scores"), name)


def facts(scored, name):
    """What must hold for any fitted model on the rows it scored: each key once, probabilities, better than chance."""
    auc = M.ranking_metrics(scored, []).select("roc_auc").scalar()
    p = F.col("p")
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("contact_id").alias("keys"),
        F.count_if(p.isNull() | F.isnan(p) | (p < 0) | (p > 1)).alias("outside"),
    ).select(F.lit(name).alias("model"), "rows", "keys", "outside", (auc > 0.55).alias("beats_chance"))


def facts_sql(name, split="validation"):
    """The same facts, counted from the raw rows."""
    return SPLITS + f"""SELECT '{name}' AS model, count(*) AS "rows", count(DISTINCT contact_id) AS keys, CAST(0 AS BIGINT) AS outside, TRUE AS beats_chance FROM splits WHERE split = '{split}'"""


def fitted_facts(spark, sf_dir, name, fit):
    development, validation = split_frames(spark, sf_dir)
    return facts(staged(predict(fit(development), validation), "scores"), name)


def plain(df):
    return L.logistic(df, NUMERIC, CATEGORICAL)


def weighted(df):
    return L.weighted_logistic(df, NUMERIC, CATEGORICAL)


def boosted(df, **args):
    return L.boosted_trees(df, NUMERIC, CATEGORICAL, **args)


def forest(df):
    return L.random_forest(df, NUMERIC, CATEGORICAL, trees=20, depth=6)


@query(
    "mdl1_prior_dummy",
    SPLITS + 'SELECT split, count(*) AS "rows", round(avg(y), 6) AS prior, CAST(avg(y) > 0.5 AS INTEGER) AS majority FROM splits GROUP BY split',
)
def dummy(spark, sf_dir):
    return L.majority_and_prior(stratified_split(contacts(spark, sf_dir), "contact_id"), ["split"])


@query("mdl2_logistic_regression")
def logistic(spark, sf_dir):
    return fitted_report(spark, sf_dir, "logistic", plain)


@query("mdl2_logistic_facts", facts_sql("logistic"))
def logistic_facts(spark, sf_dir):
    return fitted_facts(spark, sf_dir, "logistic", plain)


@query("mdl3_class_weighted_logistic")
def class_weighted(spark, sf_dir):
    return fitted_report(spark, sf_dir, "class_weighted", weighted)


@query("mdl3_class_weighted_facts", facts_sql("class_weighted"))
def class_weighted_facts(spark, sf_dir):
    return fitted_facts(spark, sf_dir, "class_weighted", weighted)


@query("mdl4_gradient_boosting")
def gradient_boosting(spark, sf_dir):
    return fitted_report(spark, sf_dir, "boosting", lambda df: boosted(df, trees=15, rate=0.2, depth=3))


@query("mdl4_gradient_boosting_facts", facts_sql("boosting"))
def gradient_boosting_facts(spark, sf_dir):
    return fitted_facts(spark, sf_dir, "boosting", lambda df: boosted(df, trees=15, rate=0.2, depth=3))


@query("mdl5_subsampled_boosting")
def subsampled(spark, sf_dir):
    return fitted_report(
        spark, sf_dir, "subsampled_boosting",
        lambda df: boosted(df, trees=10, rate=0.2, depth=5, min_leaf=40, subsample=0.9, features="0.9"),
    )


@query("mdl5_subsampled_boosting_facts", facts_sql("subsampled_boosting"))
def subsampled_facts(spark, sf_dir):
    return fitted_facts(
        spark, sf_dir, "subsampled_boosting",
        lambda df: boosted(df, trees=10, rate=0.2, depth=5, min_leaf=40, subsample=0.9, features="0.9"),
    )


def ordered_scores(spark, sf_dir):
    """Category columns become ordered target statistics of the training rows; new rows use the full history."""
    development, validation = split_frames(spark, sf_dir)
    numeric, raw = [*NUMERIC, "job_stat", "contact_stat"], development
    for column in ("job", "contact"):
        state = fit_target_statistic(raw, column, "y")
        validation = apply_target_statistic(validation, state, column).withColumnRenamed("target_stat", f"{column}_stat")
        encoded = ordered_target_statistic(development, column, "y", ["h", "contact_id"])
        # written after each column: the next one passes over the rows several times
        development = staged(encoded.withColumnRenamed("ordered_stat", f"{column}_stat").drop("earlier_rows"), "ordered")
    model = L.boosted_trees(development, numeric, ["poutcome"], trees=10, rate=0.2, depth=4)
    return staged(L.probability(model, validation, numeric, KEEP), "scores")


@query("mdl6_ordered_category_boosting")
def ordered_boosting(spark, sf_dir):
    return report(ordered_scores(spark, sf_dir), "ordered_boosting")


@query("mdl6_ordered_category_facts", facts_sql("ordered_boosting"))
def ordered_boosting_facts(spark, sf_dir):
    return facts(ordered_scores(spark, sf_dir), "ordered_boosting")


@query("mdl7_random_forest")
def random_forest(spark, sf_dir):
    return fitted_report(spark, sf_dir, "forest", forest)


@query("mdl7_random_forest_facts", facts_sql("forest"))
def random_forest_facts(spark, sf_dir):
    return fitted_facts(spark, sf_dir, "forest", forest)


@query("mdl8_early_stopping")
def early_stopping(spark, sf_dir):
    development, validation = split_frames(spark, sf_dir)
    fit_rows, stop_rows = L.inner_holdout(development, "contact_id")
    model, _, best = L.early_stopped(fit_rows, stop_rows, NUMERIC, CATEGORICAL, trees=12, rate=0.3, depth=2)
    return report(staged(predict(model, validation), "scores"), "early_stopped").withColumn("trees", F.lit(best))


@query("mdl9_staged_loss_curve")
def staged_curve(spark, sf_dir):
    development = development_frame(spark, sf_dir)
    fit_rows, stop_rows = L.inner_holdout(development, "contact_id")
    model, rows = L.boosting_with_rows({"fit": fit_rows, "stop": stop_rows}, NUMERIC, CATEGORICAL, trees=12, rate=0.3, depth=2)
    return L.staged_losses(model.stages[-1], rows)


INNER_SQL = SPLITS + f""", d AS (SELECT contact_id, y, row_number() OVER (PARTITION BY y ORDER BY {hash_sql(43, 'contact_id')}, contact_id) AS rn,
  count(*) OVER (PARTITION BY y) AS n FROM splits WHERE split = 'development'),
parts AS (SELECT y, CASE WHEN rn > floor(n * 0.8) THEN 'stop' ELSE 'fit' END AS part FROM d)
SELECT part, count(*) AS "rows", CAST(sum(y) AS BIGINT) AS positives, 12 AS trees, """


@query("mdl9_staged_loss_facts", INNER_SQL + "TRUE AS below_base_rate, TRUE AS falls_while_fitting, TRUE AS ends_at_score_loss FROM parts GROUP BY part")
def staged_curve_facts(spark, sf_dir):
    """The curve of each part ends at twice the log loss of the probabilities the model gives (the learner's loss counts double), lies below
    the loss of the part's base rate there, and never rises on the rows the trees were fitted on."""
    development = development_frame(spark, sf_dir)
    parts = dict(zip(("fit", "stop"), L.inner_holdout(development, "contact_id")))
    model, encoded = L.boosting_with_rows(parts, NUMERIC, CATEGORICAL, trees=12, rate=0.3, depth=2)
    curve = L.staged_losses(model.stages[-1], encoded)
    rises = curve.withColumn("rise", F.col("loss") - F.lag("loss").over(Window.partitionBy("part").orderBy("trees")))
    ends = rises.groupBy("part").agg(F.max("trees").alias("trees"), F.max_by("loss", "trees").alias("end"), F.coalesce(F.max("rise"), F.lit(0.0)).alias("rise"))
    y, p = F.col("y"), vector_to_array("probability")[1]
    known = None
    for name, rows in encoded.items():
        scored = model.stages[-1].transform(rows).select(F.lit(name).alias("part"), "y", p.alias("p"))
        known = scored if known is None else known.union(scored)
    rate = F.avg("y")
    sums = known.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("y").cast("bigint").alias("positives"),
        F.avg(-F.log(F.when(y == 1, F.col("p")).otherwise(1 - F.col("p")))).alias("score_loss"), (-rate * F.log(rate) - (1 - rate) * F.log(1 - rate)).alias("base_loss"),
    )
    return sums.join(ends, "part").select(
        "part", "rows", "positives", "trees", (F.col("end") / 2 < F.col("base_loss")).alias("below_base_rate"),
        ((F.col("part") != "fit") | (F.col("rise") <= 1e-9)).alias("falls_while_fitting"), (F.abs(F.col("end") / 2 - F.col("score_loss")) < 1e-6).alias("ends_at_score_loss"),
    )


@query("mdl8_early_stopping_facts", INNER_SQL.replace(", 12 AS trees, ", "") + """, TRUE AS fewest_loss_trees, TRUE AS refit_on_all FROM parts GROUP BY part""")
def early_stopping_facts(spark, sf_dir):
    """The number of trees is the first at which the stop rows' loss is least, and the final model has that many."""
    development = development_frame(spark, sf_dir)
    parts = dict(zip(("fit", "stop"), L.inner_holdout(development, "contact_id")))
    model, curve, best = L.early_stopped(parts["fit"], parts["stop"], NUMERIC, CATEGORICAL, trees=12, rate=0.3, depth=2)
    losses = [r["loss"] for r in curve.filter("part = 'stop'").orderBy("trees").collect()]  # one per tree
    sums = None
    for name, rows in parts.items():
        one = rows.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("rows"), F.sum("y").cast("bigint").alias("positives"))
        sums = one if sums is None else sums.union(one)
    first_least = losses.index(min(losses)) + 1
    return sums.withColumns({"fewest_loss_trees": F.lit(best == first_least), "refit_on_all": F.lit(model.stages[-1].getNumTrees == best)})


EDGES = {"age": list(range(10, 111, 10)), "balance": list(range(-1000, 10001, 1000)), "previous": list(range(0, 31, 3))}


def bin_sql(feature: str) -> str:
    inner = ", ".join(f"{float(e)}::DOUBLE" for e in EDGES[feature][1:-1])
    return f"len(list_filter([{inner}], lambda e: e < CAST({feature} AS DOUBLE)))"


@query(
    "mdl10_boosting_round",
    CONTACTS + ", r AS (SELECT *, y - (SELECT avg(y) FROM contacts) AS res FROM contacts), c AS (" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {bin_sql(f)} AS bin, sum(res) AS g, count(*) AS n FROM r GROUP BY 2" for f in EDGES
    ) + """), s AS (SELECT feature, bin, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER f AS g, sum(n) OVER f AS n FROM c WINDOW w AS (PARTITION BY feature ORDER BY bin), f AS (PARTITION BY feature)),
t AS (SELECT feature, CAST(bin AS INTEGER) AS bin, CAST(nl AS BIGINT) AS nl, CAST(n - nl AS BIGINT) AS nr, round(gl * gl / nl + (g - gl) * (g - gl) / (n - nl) - g * g / n, 6) AS gain,
  round(gl / nl, 6) AS left_value, round((g - gl) / (n - nl), 6) AS right_value FROM s WHERE n > nl)
SELECT *, row_number() OVER (ORDER BY gain DESC, feature, bin) = 1 AS best FROM t""",
)
def one_round(spark, sf_dir):
    frame = contacts(spark, sf_dir).select("y", *EDGES)
    base = frame.agg(F.avg("y")).scalar()
    return L.boosting_round(frame, list(EDGES), EDGES, F.col("y") - base)


@query("mdl11_scorecard", CONTACTS + f"SELECT contact_id, {P_FULL} AS p, {P_FULL} >= 0.14 AS prioritize_call FROM contacts")
def scorecard(spark, sf_dir):
    return score(contacts(spark, sf_dir)).select("contact_id", "p", (F.col("p") >= CUT).alias("prioritize_call"))


@query(
    "mdl11_scorecard_terms",
    CONTACTS + f"""SELECT round(avg(CAST({LEVEL_SQL} AS DOUBLE)), 6) AS contact, round(avg(CAST(0.00004 AS DOUBLE) * balance), 6) AS balance,
  round(avg(CAST(0.004 AS DOUBLE) * age), 6) AS age, round(avg(CAST(-0.03 AS DOUBLE) * previous), 6) AS previous FROM contacts""",
)
def scorecard_terms(spark, sf_dir):
    return contacts(spark, sf_dir).agg(*[r6(F.avg(t)).alias(n) for n, t in FULL.terms().items()])


@query("mdl12_coefficient_report")
def coefficients(spark, sf_dir):
    development, _ = split_frames(spark, sf_dir)
    model = plain(development)
    return L.coefficient_table(model)


def names_sql(numeric, categorical, split="development"):
    """Names of a design's columns from the raw rows: levels of fewer than ten rows share a bucket."""
    levels = " UNION ALL ".join(f"SELECT '{c}' AS source, CASE WHEN count(*) < 10 THEN '__infrequent__' ELSE {c} END AS level FROM splits WHERE split = '{split}' GROUP BY {c}" for c in categorical)
    numbers = "".join(f" UNION ALL SELECT '{c}', NULL, 'numeric__{c}'" for c in numeric)
    return f"""levels AS ({levels}), names AS (SELECT DISTINCT source, level, 'categorical__' || source || '_' || level AS name FROM levels{numbers})"""


@query(
    "mdl12_coefficient_facts",
    SPLITS + f", {names_sql(['age', 'balance', 'previous'], ['job', 'contact'])} SELECT source, level, name, TRUE AS at_optimum FROM names",
)
def coefficient_facts(spark, sf_dir):
    """Each column of the design once by name; the penalised gradient of each coefficient, summed anew over the rows, is zero at the fitted model."""
    development = staged(stratified_split(contacts(spark, sf_dir), "contact_id").filter("split = 'development'"), "development")
    numeric = ["age", "balance", "previous"]
    model = L.logistic(development, numeric, ["job", "contact"])
    named = L.coefficients_by_name(model)
    gradient = L.logistic_gradient(model, L.as_doubles(development, numeric))
    return named.join(gradient, "name").select("source", "level", "name", (F.abs("gradient") < 1e-4).alias("at_optimum"))


def stage_level_sql(column, least):
    """(value, code) of one column: the mode takes the nulls, rare levels share a bucket, codes follow the names; the null row is the mode's."""
    return f"""SELECT v.{column} AS value, dense_rank() OVER (ORDER BY encoded) - 1 AS code, n0, v.{column} = mode AS is_mode FROM (
  SELECT c.{column}, mode, n AS n0, CASE WHEN n + CASE WHEN c.{column} = mode THEN blank ELSE 0 END < {least} THEN '__infrequent__' ELSE c.{column} END AS encoded
  FROM (SELECT {column}, count(*) AS n FROM dev WHERE {column} IS NOT NULL GROUP BY 1) AS c,
    (SELECT (SELECT {column} FROM dev WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {column} LIMIT 1) AS mode, count(*) FILTER ({column} IS NULL) AS blank FROM dev) AS m) AS v"""


@query(
    "enc1_saved_encoder_stages",
    SPLITS + f""", raw AS (SELECT * REPLACE (nullif(poutcome, 'O') AS poutcome, nullif(pdays, -1) AS pdays) FROM splits), dev AS (SELECT * FROM raw WHERE split = 'development'),
med AS (SELECT quantile_cont(CAST(pdays AS DOUBLE), 0.5) AS m FROM dev),
num AS (SELECT m, avg(coalesce(CAST(pdays AS DOUBLE), m)) AS pm, stddev_pop(coalesce(CAST(pdays AS DOUBLE), m)) AS ps, avg(balance) AS bm, stddev_pop(balance) AS bs FROM dev, med GROUP BY m),
jobs AS ({stage_level_sql('job', 10)}), outs AS ({stage_level_sql('poutcome', 10)})
SELECT contact_id, round((coalesce(CAST(pdays AS DOUBLE), m) - pm) / ps, 6) AS pdays, round((balance - bm) / bs, 6) AS balance, CAST(j.code AS BIGINT) AS job_code, CAST(o.code AS BIGINT) AS poutcome_code
FROM raw, num, jobs AS j, outs AS o WHERE split = 'validation' AND j.value = raw.job AND (o.value = raw.poutcome OR raw.poutcome IS NULL AND o.is_mode)""",
)
def saved_stages(spark, sf_dir):
    """Encoders fitted on the development rows, saved, loaded, and applied to the validation rows."""
    blanks = {"poutcome": F.nullif(F.col("poutcome"), F.lit("O")), "pdays": F.nullif(F.col("pdays"), F.lit(-1))}
    rows = staged(stratified_split(contacts(spark, sf_dir), "contact_id").withColumns(blanks), "raw")
    stages = [NumberEncoder(inputCols=["pdays", "balance"], outputCols=["pdays_num", "balance_num"]), LevelEncoder(inputCols=["job", "poutcome"], outputCols=["job_idx", "poutcome_idx"])]
    path = scratch_path(spark, "encoders")
    Pipeline(stages=stages).fit(rows.filter("split = 'development'")).write().save(path)
    out = PipelineModel.load(path).transform(rows.filter("split = 'validation'"))
    return out.select("contact_id", r6(F.col("pdays_num")).alias("pdays"), r6(F.col("balance_num")).alias("balance"), F.col("job_idx").cast("bigint").alias("job_code"), F.col("poutcome_idx").cast("bigint").alias("poutcome_code"))


@query(
    "mdl13_soft_voting",
    MODELS + f""", w AS (SELECT contact_id, y, {P_FULL} AS a, {P_CONTACT} AS b, {P_HISTORY} AS c FROM contacts)
SELECT contact_id, round((a + b + c) / 3.0, 9) AS equal_vote, round((a * 2.0 + b + c) / 4.0, 9) AS weighted_vote FROM w""",
)
def soft_voting(spark, sf_dir):
    names = list(SCORECARDS)
    wide = align_scores(score_many(contacts(spark, sf_dir), keep=["contact_id"]), ["contact_id"], names)
    voted = L.soft_vote(L.soft_vote(wide, names, name="equal"), names, [2.0, 1.0, 1.0], "weighted")
    return voted.select("contact_id", F.round("equal", 9).alias("equal_vote"), F.round("weighted", 9).alias("weighted_vote"))


def folded(development):
    return staged(stratified_folds(development, "contact_id", FOLDS), "folds")


@query("mdl14_stacking")
def stacking(spark, sf_dir):
    development, validation = split_frames(spark, sf_dir)
    rows = folded(development)
    members = ["logistic", "boosting"]
    # the regressions of all folds and that of all rows share their scans
    sets = [*W.folds_as_sets(FOLDS), frozenset(range(FOLDS))]
    design = W.fit_design(rows, "fold", sets, NUMERIC, CATEGORICAL)
    betas, _ = W.fit_from_summary(rows, design, "fold", sets, [1.0])
    oof = W.scored_by(rows, design, betas, "fold", [[(k, 0)] for k in range(FOLDS)], KEEP).select(*KEEP, F.col("p").alias("logistic"))
    new = W.scored_by(validation.withColumn("fold", F.lit(0)), design, betas, "fold", [[(FOLDS, 0)]], KEEP).select(*KEEP, F.col("p").alias("logistic"))

    def fit(df):
        return boosted(df, trees=8, rate=0.3, depth=3)

    oof = staged(oof.join(L.out_of_fold(rows, fit, lambda m, d: predict(m, d, ["contact_id"], "boosting"), FOLDS), "contact_id"), "oof")
    new = staged(new.join(predict(fit(development), validation, ["contact_id"], "boosting"), "contact_id"), "members")
    stacked = report(staged(L.stack(oof, new, members, KEEP), "scores"), "stacked")
    for name in members:
        stacked = stacked.unionByName(report(new.withColumn("p", F.col(name)), name))
    return stacked


@query("mdl15_timing")
def timing(spark, sf_dir):
    development, validation = split_frames(spark, sf_dir)
    rows, new = development.count(), validation.count()
    out = []
    for name, fit in {"logistic": plain, "boosting": lambda df: boosted(df, trees=5, depth=3)}.items():
        holder = {}
        _, fit_seconds, _ = L.timed(name, rows, lambda fit=fit, holder=holder: holder.update(model=fit(development)))
        scored = predict(holder["model"], validation)
        _, _, per_thousand = L.timed(name, new, lambda scored=scored: scored.write.format("noop").mode("overwrite").save())
        out.append((name, rows, new, float(fit_seconds), float(per_thousand)))
    return spark.createDataFrame(out, "model string, fit_rows bigint, scored_rows bigint, fit_seconds double, ms_per_1000_rows double")


@query("enc14_reload_parity")
def reload_parity(spark, sf_dir):
    """The whole artifact, contract and features included, is saved, loaded and compared on the validation rows."""
    rows = staged(stratified_split(contacts(spark, sf_dir), "contact_id"), "raw")
    model = L.guarded_logistic(rows.filter("split = 'development'"), NUMERIC, CATEGORICAL)
    return L.reload_difference(model, rows.filter("split = 'validation'"), "contact_id")


@query(
    "enc14_reload_parity_facts",
    SPLITS + """SELECT count(*) AS "rows", TRUE AS same FROM splits WHERE split = 'validation'""",
)
def reload_parity_facts(spark, sf_dir):
    """The saved and loaded artifact scores every validation row within 1e-12 of the fitted one."""
    rows = staged(stratified_split(contacts(spark, sf_dir), "contact_id"), "raw")
    model = L.guarded_logistic(rows.filter("split = 'development'"), NUMERIC, CATEGORICAL)
    gap = L.reload_difference(model, rows.filter("split = 'validation'"), "contact_id")
    return gap.select("rows", (F.col("max_difference") <= 1e-12).alias("same"))


@query(
    "inf1_pipeline_scoring",
    SPLITS + """SELECT count(*) AS "rows", count(DISTINCT contact_id) AS keys, CAST(0 AS BIGINT) AS outside, 0.14::DOUBLE AS threshold, CAST(0 AS BIGINT) AS wrong_decisions,
  count(*) AS committed_rows, TRUE AS bad_batch_refused, TRUE AS second_run_refused FROM splits WHERE split = 'validation'""",
)
def pipeline_scoring(spark, sf_dir):
    """The saved artifact scores the validation rows once; a batch with an impossible age and a second run leave nothing behind."""
    rows = split_at_cuts(staged(contacts(spark, sf_dir), "contacts"), "contact_id")
    rows = staged(rows.filter("split <> 'test'"), "raw")
    path = scratch_path(spark, "scores")
    L.guarded_logistic(rows.filter("split = 'development'"), NUMERIC, CATEGORICAL).write().save(f"{path}/model")
    batch = rows.filter("split = 'validation'").drop("y", "split")
    found = V.score_with_pipeline(batch, f"{path}/model", CUT, "contact_id", f"{path}/scores", "first", ["balance"])
    refused = {}
    for name, run, frame, error in (("bad", "second", batch.withColumn("age", F.when(F.col("contact_id") % 1000 == 1, -5).otherwise(F.col("age"))), ValueError), ("again", "first", batch, PermissionError)):
        try:
            V.score_with_pipeline(frame, f"{path}/model", CUT, "contact_id", f"{path}/scores", run, ["balance"])
            refused[name] = False
        except error:
            refused[name] = True
    p, cut = F.col("subscription_probability"), F.col("model_threshold")
    return V.read_scores(spark, f"{path}/scores").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("contact_id").alias("keys"), F.count_if((p < 0) | (p > 1) | p.isNull() | F.isnan(p)).alias("outside"), F.max(cut).alias("threshold"),
        F.count_if(F.col("prioritize_call") != (p >= cut)).alias("wrong_decisions"), F.lit(found["rows"]).cast("bigint").alias("committed_rows"),
        F.lit(refused["bad"]).alias("bad_batch_refused"), F.lit(refused["again"]).alias("second_run_refused"),
    )


@query("evl19_out_of_fold")
def out_of_fold(spark, sf_dir):
    development, _ = split_frames(spark, sf_dir)
    return W.out_of_fold(folded(development), "fold", FOLDS, NUMERIC, CATEGORICAL, [*KEEP, "fold"])


@query("evl19_out_of_fold_facts", facts_sql("out_of_fold", "development"))
def out_of_fold_facts(spark, sf_dir):
    """Each development row is scored once, by a model that did not see its fold."""
    return facts(staged(out_of_fold(spark, sf_dir), "oof"), "out_of_fold")


STRENGTHS = [0.01, 0.1, 1.0, 10.0]


def one_pass(rows, part, sets, numeric, categorical):
    """Rows with their features written once, the designs and the coefficients of all sets and strengths, and the scans they took."""
    rows = staged(rows.select("contact_id", "y", part, *numeric, *categorical), "rows")
    design = W.fit_design(rows, part, sets, numeric, categorical)
    betas, scans = W.fit_from_summary(rows, design, part, sets, STRENGTHS)
    return rows, design, betas, scans


@query(
    "evl19_one_pass_folds_facts",
    SPLITS + """SELECT count(*) AS "rows", count(DISTINCT contact_id) AS keys, CAST(4 AS BIGINT) AS strengths, CAST(0 AS BIGINT) AS outside, TRUE AS beats_chance, TRUE AS at_optimum, TRUE AS few_scans
FROM splits WHERE split = 'development'""",
)
def one_pass_facts(spark, sf_dir):
    """Out-of-fold scores of four strengths from one scan per Newton step; at the end each model's gradient, summed anew, is zero."""
    development, _ = split_frames(spark, sf_dir)
    rows, design, betas, scans = one_pass(folded(development), "fold", W.folds_as_sets(FOLDS), NUMERIC, CATEGORICAL)
    scores = staged(W.scored_by(rows, design, betas, "fold", [[(k, c) for c in range(len(STRENGTHS))] for k in range(FOLDS)], KEEP), "oof")
    again, _ = W.fit_all(rows, design, "fold", W.folds_as_sets(FOLDS), STRENGTHS, start=betas, most_steps=1)
    own = scores.filter(F.col("strength") == STRENGTHS.index(1.0))
    table = facts(own, "one_pass").select("rows", "keys", "outside", "beats_chance")
    return table.select(
        "rows", "keys", F.lit(scores.select("strength").distinct().count()).cast("bigint").alias("strengths"), "outside", "beats_chance",
        F.lit(bool(abs(again - betas).max() < 1e-6)).alias("at_optimum"), F.lit(scans <= 15).alias("few_scans"),
    )


def cv_table(rows, fit, name, numeric=NUMERIC, folds=FOLDS):
    """Per-fold report of one candidate."""
    def run(model, df):
        return L.probability(model, df, numeric, ["y", "fold"])

    oof = staged(L.out_of_fold(rows, fit, run, folds), "oof").withColumn("model", F.lit(name))
    return M.model_report(oof, ["model", "fold"], CUT)


@query("evl21_family_ablation")
def ablation(spark, sf_dir):
    development, _ = split_frames(spark, sf_dir)
    rows = folded(development)
    whole = W.fit_design(rows, "fold", W.folds_as_sets(FOLDS), NUMERIC, CATEGORICAL)
    scores = []
    for family in [None, *FAMILIES]:
        dropped = set(FAMILIES.get(family, []))
        numeric = [c for c in NUMERIC if c not in dropped]
        categorical = [c for c in CATEGORICAL if c not in dropped]
        oof = W.out_of_fold(rows, "fold", FOLDS, numeric, categorical, ["y", "fold"], W.narrowed(whole, numeric, categorical))
        scores.append(oof.withColumn("model", F.lit(f"without_{family}" if family else "all")))
    scores = staged(reduce(lambda a, b: a.unionByName(b), scores), "oof")
    tables = staged(M.model_report(scores, ["model", "fold"], CUT), "ablation")
    return dispersion(M.paired_differences(tables, "all", ["log_loss", "roc_auc"]), ["model", "metric"])


@query("evl22_leakage_audit_models")
def leakage_audit(spark, sf_dir):
    """The same learner with and without a column that is only known afterwards."""
    frame = stratified_folds(contacts(spark, sf_dir), "contact_id", FOLDS)
    rows = staged(frame.withColumn("late_outcome", F.col("y") * 0.8 + F.col("duration") / 1e6), "audit")
    tables = None
    for name, numeric in {"safe": ["age", "balance", "previous"], "leaky": ["age", "balance", "previous", "late_outcome"]}.items():
        table = cv_table(rows, lambda df, n=numeric: L.logistic(df, n, ["contact"]), name, numeric)
        tables = table if tables is None else tables.unionByName(table)
    return dispersion(melt_metrics(tables, ["model", "fold"], ["roc_auc", "log_loss"]), ["model", "metric"])


OUTER, INNER = 5, 3


def nested_scores(spark, sf_dir):
    """Each row scored once, by the model of its outer fold with the strength that the inner folds chose there. All inner and outer models are fitted together."""
    rows = stratified_folds(contacts(spark, sf_dir), "contact_id", OUTER, name="outer")
    rows = stratified_folds(staged(rows, "outer"), "contact_id", INNER, name="inner", seed=7).withColumn("part", (F.col("outer") * INNER + F.col("inner")).cast("int"))
    sets = W.nested_sets(OUTER, INNER)
    rows, design, betas, _ = one_pass(rows, "part", sets, ["age", "balance", "previous"], ["contact", "job"])
    every = range(len(STRENGTHS))
    # a row judges the inner models of the other outer folds that left its inner fold out
    inner = [[(o * (INNER + 1) + p % INNER, c) for o in range(OUTER) if o != p // INNER for c in every] for p in range(OUTER * INNER)]
    judged = W.scored_by(rows, design, betas, "part", inner, KEEP)
    losses = judged.groupBy(F.floor(F.col("held") / (INNER + 1)).cast("int").alias("fold"), "strength").agg(M.probability_columns()["log_loss"].alias("loss")).collect()
    chosen = {o: min((r["loss"], r["strength"]) for r in losses if r["fold"] == o)[1] for o in range(OUTER)}
    outer = [[(p // INNER * (INNER + 1) + INNER, chosen[p // INNER])] for p in range(OUTER * INNER)]
    scored = W.scored_by(rows, design, betas, "part", outer, KEEP)
    strength = F.element_at(F.array(*[F.lit(c) for c in STRENGTHS]), F.col("strength") + 1)
    return staged(scored.select(*KEEP, F.floor(F.col("held") / (INNER + 1)).cast("int").alias("fold"), strength.alias("chosen_c"), "p"), "nested")


@query("evl25_nested_estimate")
def nested(spark, sf_dir):
    """Outer score of the whole selection: strength chosen on inner folds, judged on the outer fold."""
    return M.model_report(nested_scores(spark, sf_dir), ["fold", "chosen_c"], CUT).select("fold", "chosen_c", *REPORT)


@query(
    "evl25_nested_facts",
    CONTACTS + """SELECT count(*) AS "rows", count(DISTINCT contact_id) AS keys, CAST(0 AS BIGINT) AS outside, TRUE AS beats_chance, CAST(5 AS BIGINT) AS folds, CAST(5 AS BIGINT) AS choices FROM contacts""",
)
def nested_facts(spark, sf_dir):
    """Each row is scored once, by one choice per outer fold."""
    scores = nested_scores(spark, sf_dir)
    seen = scores.agg(F.count_distinct("fold").alias("folds"), F.count_distinct("fold", "chosen_c").alias("choices"))
    table = facts(scores, "nested").select("rows", "keys", "outside", "beats_chance")
    return table.select("*", *[seen.select(c).scalar().alias(c) for c in ("folds", "choices")])


def calibration_scores(spark, sf_dir, method):
    """Fit the map on out-of-fold development scores, apply it to validation: (raw scores, calibrated scores)."""
    development, validation = split_frames(spark, sf_dir)
    oof = staged(L.out_of_fold(folded(development), weighted, lambda m, d: predict(m, d), FOLDS), "oof")
    new = staged(predict(weighted(development), validation), "scores")
    return new, staged(method(oof, new, KEEP).withColumnRenamed("calibrated", "p"), "calibrated")


def calibrated(spark, sf_dir, method):
    new, after = calibration_scores(spark, sf_dir, method)
    both = new.withColumn("stage", F.lit("before")).unionByName(after.withColumn("stage", F.lit("after")))
    gaps = expected_calibration_error(fixed_curve(both, ["stage"]), ["stage"])
    losses = both.groupBy("stage").agg(*[c.alias(n) for n, c in M.probability_columns().items()])
    return gaps.join(losses, "stage")


@query("cal4_platt_scaling")
def platt(spark, sf_dir):
    return calibrated(spark, sf_dir, L.platt)


@query("cal4_platt_facts", facts_sql("platt"))
def platt_facts(spark, sf_dir):
    return facts(calibration_scores(spark, sf_dir, L.platt)[1], "platt")


@query("cal5_isotonic_facts", facts_sql("isotonic"))
def isotonic_facts(spark, sf_dir):
    return facts(calibration_scores(spark, sf_dir, L.isotonic)[1], "isotonic")


@query("cal5_isotonic")
def isotonic(spark, sf_dir):
    return calibrated(spark, sf_dir, L.isotonic)


@query("imb6_intervention_comparison")
def interventions(spark, sf_dir):
    """Resampling happens inside the training side of each fold only."""
    development, _ = split_frames(spark, sf_dir)
    rows = folded(development)

    even = F.lit(1.0).alias("weight")
    arms = {
        "plain": lambda df: df.select("*", even),
        "class_weight": lambda df: I.balanced_weights(df, "y"),
        "random_under": lambda df: I.undersample(df, "contact_id").select("*", even),
        "random_over": lambda df: I.oversample_copies(df, "contact_id").withColumnRenamed("copies", "weight"),
    }
    sets, tables = [frozenset({k}) for k in range(FOLDS)], None
    for name, treated in arms.items():
        # the treated training side of every fold, under the fold's number; all folds are fitted together
        sides = [treated(rows.filter(F.col("fold") != k)).select("y", *NUMERIC, *CATEGORICAL, F.col("weight").cast("double").alias("weight"), F.lit(k).alias("side")) for k in range(FOLDS)]
        train = staged(reduce(lambda a, b: a.unionByName(b), sides), "treated")
        design = W.fit_design(train, "side", sets, NUMERIC, CATEGORICAL)
        betas, _ = W.fit_from_summary(train, design, "side", sets, [1.0], weight="weight")
        scored = W.scored_by(rows, design, betas, "fold", [[(k, 0)] for k in range(FOLDS)], ["y", "fold"])
        table = M.model_report(staged(scored.select("y", "fold", "p"), "oof").withColumn("model", F.lit(name)), ["model", "fold"], CUT)
        tables = table if tables is None else tables.unionByName(table)
    metrics = ["log_loss", "average_precision", "balanced_accuracy", "f1", "cost"]
    return dispersion(melt_metrics(tables, ["model", "fold"], metrics), ["model", "metric"])


SPACE = {
    "trees": T.Span(4, 16, whole=True), "depth": T.Span(2, 5, whole=True), "rate": T.Span(0.05, 0.5, log=True),
    "min_leaf": T.Span(5, 60, whole=True), "subsample": T.Span(0.6, 1.0),
}
SEARCH_NUMERIC = ["age", "balance", "previous"]


def searched(spark, sf_dir):
    """Eight boosted trials over three folds; what the folds share is prepared once."""
    development, _ = split_frames(spark, sf_dir)
    rows = folded(development.select("contact_id", "y", "contact", *SEARCH_NUMERIC))
    prepared = []
    for fold in range(FOLDS):
        encoders, train = L.encoded_rows(rows.filter(F.col("fold") != fold), SEARCH_NUMERIC, ["contact"], "contact_id")
        held = encoders.transform(L.as_doubles(rows.filter(F.col("fold") == fold), SEARCH_NUMERIC))
        prepared.append((train, staged(held.select(*KEEP, "features"), "held")))

    def loss(params, fold):
        train, held = prepared[fold]
        learner = L.booster(trees=params["trees"], depth=params["depth"], rate=params["rate"], min_leaf=params["min_leaf"], subsample=params["subsample"])
        scored = L.probability(learner.fit(train), held, [], KEEP)
        return scored.agg(M.probability_columns()["log_loss"]).first()[0]

    return T.search(SPACE, loss, FOLDS, trials=8, spark=spark)


@query("tun1_search")
def search(spark, sf_dir):
    return T.trial_table(spark, searched(spark, sf_dir))


@query(
    "tun1_search_facts",
    SPLITS + """SELECT CAST(8 AS BIGINT) AS trials, CAST(0 AS BIGINT) AS outside_space, CAST(0 AS BIGINT) AS wrong_states, TRUE AS better_than_base_rate
FROM splits WHERE split = 'development' HAVING count(*) > 0""",
)
def search_facts(spark, sf_dir):
    """Every trial lies in its space, the replay of the log by the rule gives each trial's state, and the best one beats the base rate's loss."""
    history = searched(spark, sf_dir)
    table = T.trial_table(spark, history)
    outside = F.lit(False)
    for name, span in SPACE.items():
        outside = outside | ~F.col(name).between(span.low, span.high)
    wrong = sum(T.should_prune(t.values, [o.values for o in history if o.number // 4 < t.number // 4 and o.state == "COMPLETE"]) != (t.state == "PRUNED") for t in history if len(t.values) < FOLDS or t.state == "PRUNED")
    rate = contacts(spark, sf_dir).agg(F.avg("y")).scalar()
    base = -(rate * F.log(rate) + (1 - rate) * F.log(1 - rate))
    best = table.agg(F.count(F.lit(1)).alias("trials"), F.count_if(outside).alias("outside_space"), F.min("value").alias("best"))
    return best.select("trials", "outside_space", F.lit(wrong).cast("bigint").alias("wrong_states"), (F.col("best") < base).alias("better_than_base_rate"))
