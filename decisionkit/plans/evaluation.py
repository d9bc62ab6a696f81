"""Probability, ranking and decision metrics of the frozen scorecards."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import mean_score, r6
from ..operators import calibration as K
from ..operators import metrics as M
from ..operators import policy as P
from ..operators import resampling as B
from ..operators.aggregates import dispersion, melt_metrics
from ..operators.quantiles import tall
from ..operators.scoring import score, score_many
from ..operators.splits import stratified_folds
from ..session import staged
from ..sources.frames import contacts, lineitem_frame
from .base import (
    CONTACTS, LL_SQL, MODELS, SCORED, counts_sql, decision_sql, hex_sql, mean_p, query, ranking_sql, sweep_sql,
)

CUT = 0.14
FOLD_SQL = """, folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY model, y ORDER BY h, contact_id) - 1) % 5 AS INTEGER) AS fold FROM models)"""


def models(spark, sf_dir):
    return score_many(contacts(spark, sf_dir), keep=["contact_id", "client_id", "y"])


def scored(spark, sf_dir):
    return score(contacts(spark, sf_dir)).select("contact_id", "client_id", "contact_date", "job", "y", "p")


def fold_confusion(spark, sf_dir):
    rows = stratified_folds(contacts(spark, sf_dir), "contact_id", 5)
    return M.confusion(score_many(rows, keep=["y", "fold"]), ["model", "fold"], CUT)


@query("evl1_confusion_counts", MODELS + f"SELECT model, {counts_sql('0.14')} FROM models GROUP BY model")
def confusion(spark, sf_dir):
    return M.confusion(models(spark, sf_dir), ["model"], CUT)


@query(
    "evl2_confusion_matrix",
    SCORED + """SELECT y AS actual, CAST(p >= 0.14 AS INTEGER) AS predicted, count(*) AS n,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY y) AS DOUBLE), 6) AS row_share FROM scored GROUP BY 1, 2""",
)
def matrix(spark, sf_dir):
    cells = scored(spark, sf_dir).groupBy(F.col("y").alias("actual"), (F.col("p") >= CUT).cast("int").alias("predicted"))
    counts = cells.agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("row_share", r6(F.col("n") / F.sum("n").over(Window.partitionBy("actual"))))


@query(
    "evl3_decision_metrics",
    MODELS + f"SELECT model, tn, fp, fn, tp, {decision_sql()} FROM (SELECT model, {counts_sql('0.14')} FROM models GROUP BY model) AS c",
)
def decisions(spark, sf_dir):
    return M.decision_metrics(M.confusion(models(spark, sf_dir), ["model"], CUT), ["model"])


@query(
    "evl4_business_cost",
    MODELS + f"SELECT model, CAST(fp * 2.0 + fn * 7.0 AS DOUBLE) AS cost FROM (SELECT model, {counts_sql('0.2')} FROM models GROUP BY model) AS c",
)
def cost(spark, sf_dir):
    counts = M.confusion(models(spark, sf_dir), ["model"], 0.2)
    return M.decision_metrics(counts, ["model"], fp_cost=2.0, fn_cost=7.0).select("model", "cost")


@query("evl5_log_loss", MODELS + f"SELECT model, round(avg({LL_SQL}), 6) AS log_loss FROM models GROUP BY model")
def log_loss(spark, sf_dir):
    return models(spark, sf_dir).groupBy("model").agg(M.probability_columns()["log_loss"].alias("log_loss"))


@query("evl6_brier", MODELS + "SELECT model, round(avg((p - y) * (p - y)), 6) AS brier FROM models GROUP BY model")
def brier(spark, sf_dir):
    return models(spark, sf_dir).groupBy("model").agg(M.probability_columns()["brier"].alias("brier"))


@query("evl7_roc_auc", MODELS + ", " + ranking_sql("models", "model") + " SELECT model, roc_auc FROM auc")
def roc_auc(spark, sf_dir):
    return M.ranking_metrics(models(spark, sf_dir), ["model"]).select("model", "roc_auc")


@query("evl8_average_precision", MODELS + ", " + ranking_sql("models", "model") + " SELECT model, average_precision FROM ap")
def average_precision(spark, sf_dir):
    return M.ranking_metrics(models(spark, sf_dir), ["model"]).select("model", "average_precision")


@query("evl9_threshold_table", SCORED + sweep_sql("scored"))
def sweep(spark, sf_dir):
    return M.threshold_table(scored(spark, sf_dir))


CUTOFFS = [0.033, 0.1, 0.123456, 0.14, 0.2, 0.35, 0.5]
CUTOFF_SQL = f"""SELECT threshold, tn, fp, fn, tp, log_loss, brier, {decision_sql()} FROM (SELECT threshold, {counts_sql('threshold')},
  round(avg({LL_SQL}), 6) AS log_loss, round(avg((p - y) * (p - y)), 6) AS brier FROM scored, (SELECT unnest({CUTOFFS}::DOUBLE[]) AS threshold) GROUP BY threshold) AS c"""


@query("evl9_any_cutoffs", SCORED + CUTOFF_SQL)
def sweep_any(spark, sf_dir):
    return M.threshold_table_at(scored(spark, sf_dir), CUTOFFS)


LARGE_P = "round(1.0 / (1.0 + exp(-(CAST(-3.0 AS DOUBLE) + CAST(0.02 AS DOUBLE) * l_quantity + CAST(8.0 AS DOUBLE) * l_tax))), 6)"
LARGE = f"WITH large AS (SELECT CASE WHEN l_returnflag = 'R' AND l_discount >= 0.07 THEN 1 ELSE 0 END AS y, {LARGE_P} AS p FROM lineitem)\n"


def large_scores(spark, sf_dir):
    z = F.lit(-3.0) + 0.02 * F.col("l_quantity") + 8.0 * F.col("l_tax")
    return lineitem_frame(spark, sf_dir).select("y", F.round(1.0 / (1.0 + F.exp(-z)), 6).alias("p"))


@query("evl9_large_frame", LARGE + sweep_sql("large"))
def large_sweep(spark, sf_dir):
    return M.threshold_table(large_scores(spark, sf_dir))


@query("evl7_large_frame", LARGE + ", " + ranking_sql("large") + " SELECT roc_auc, average_precision FROM auc, ap")
def large_ranking(spark, sf_dir):
    return M.ranking_metrics(large_scores(spark, sf_dir), [])


@query(
    "evl10_cost_optimal_threshold",
    MODELS + f""", sweep AS ({sweep_sql('models', 'model')})
SELECT model, threshold, cost FROM sweep QUALIFY row_number() OVER (PARTITION BY model ORDER BY cost, threshold) = 1""",
)
def best(spark, sf_dir):
    return P.best_threshold(M.threshold_table(models(spark, sf_dir), ["model"]), ["model"])


TOP_SQL = """, k AS (SELECT {k} AS k FROM scored), f AS (SELECT s.*, row_number() OVER (ORDER BY p DESC, contact_id) <= k AS taken FROM scored AS s, k)
"""


@query(
    "evl11_precision_at_k",
    SCORED + TOP_SQL.format(k="sum(y)") + """, c AS (SELECT count(*) FILTER (WHERE taken) AS k, count(*) FILTER (WHERE taken AND y = 1) AS hits, sum(y) AS pos, count(*) AS n FROM f)
SELECT k, hits, round(hits / CAST(k AS DOUBLE), 6) AS precision_at_k, round(hits / CAST(pos AS DOUBLE), 6) AS recall_at_k,
  round((hits / CAST(k AS DOUBLE)) / (pos / CAST(n AS DOUBLE)), 6) AS lift_at_k FROM c""",
)
def at_k(spark, sf_dir):
    rows = scored(spark, sf_dir)
    k = rows.agg(F.sum("y")).scalar()
    return P.top_k_metrics(P.top_k_flags(rows, k, "contact_id"))


@query(
    "evl12_capacity_policy",
    SCORED + TOP_SQL.format(k="CAST(floor(count(*) / 10) AS BIGINT)") + """, c AS (SELECT count(*) FILTER (WHERE NOT taken AND y = 0) AS tn, count(*) FILTER (WHERE taken AND y = 0) AS fp,
  count(*) FILTER (WHERE NOT taken AND y = 1) AS fn, count(*) FILTER (WHERE taken AND y = 1) AS tp FROM f)
""" + f"SELECT tn, fp, fn, tp, {decision_sql()} FROM c",
)
def capacity(spark, sf_dir):
    rows = scored(spark, sf_dir)
    k = rows.agg(F.floor(F.count(F.lit(1)) / 10)).scalar()
    return P.capacity_policy(P.top_k_flags(rows, k, "contact_id"))


@query(
    "evl13_gain_table",
    MODELS + """, r AS (SELECT model, y, CAST(floor((rank() OVER (PARTITION BY model ORDER BY p DESC) - 1) * 10.0 / count(*) OVER (PARTITION BY model)) AS INTEGER) + 1 AS part FROM models),
d AS (SELECT model, part, count(*) AS n, sum(y) AS positives FROM r GROUP BY model, part),
c AS (SELECT *, sum(n) OVER w AS workload, sum(positives) OVER w AS captured, sum(n) OVER (PARTITION BY model) AS nn, sum(positives) OVER (PARTITION BY model) AS pp
  FROM d WINDOW w AS (PARTITION BY model ORDER BY part))
SELECT model, part, n, CAST(positives AS BIGINT) AS positives, CAST(workload AS BIGINT) AS workload, CAST(captured AS BIGINT) AS captured,
  round(CAST(captured AS DOUBLE) / CAST(pp AS DOUBLE), 6) AS gain,
  round((CAST(captured AS DOUBLE) / CAST(pp AS DOUBLE)) / (CAST(workload AS DOUBLE) / CAST(nn AS DOUBLE)), 6) AS lift,
  CAST(captured AS DOUBLE) * 5.0 - CAST(workload AS DOUBLE) AS profit,
  round((CAST(captured AS DOUBLE) * 5.0 - CAST(workload AS DOUBLE)) / CAST(workload AS DOUBLE), 6) AS roi FROM c""",
)
def gain(spark, sf_dir):
    return P.gain_table(models(spark, sf_dir), ["model"])


@query(
    "evl14_cost_sensitivity",
    SCORED + f""", sweep AS ({sweep_sql('scored')}), c AS (SELECT fn_cost, threshold, fp + fn * fn_cost AS cost FROM sweep, (SELECT unnest([2.0::DOUBLE, 10.0::DOUBLE, 20.0::DOUBLE]) AS fn_cost))
SELECT fn_cost, threshold, cost FROM c QUALIFY row_number() OVER (PARTITION BY fn_cost ORDER BY cost, threshold) = 1""",
)
def sensitivity(spark, sf_dir):
    return P.cost_sensitivity(M.threshold_table(scored(spark, sf_dir)), [2, 10, 20])


@query(
    "evl15_precision_at_prevalence",
    MODELS + f""", c AS (SELECT model, {counts_sql('0.14')} FROM models GROUP BY model),
r AS (SELECT model, CAST(tp AS DOUBLE) / (tp + fn) AS r, CAST(tn AS DOUBLE) / (tn + fp) AS s, unnest([0.05::DOUBLE, 0.13::DOUBLE, 0.4::DOUBLE]) AS prevalence FROM c)
SELECT model, prevalence, round(coalesce(r * prevalence / nullif(r * prevalence + (1 - s) * (1 - prevalence), 0), 0.0), 6) AS precision FROM r""",
)
def prevalence(spark, sf_dir):
    return M.precision_at_prevalence(M.confusion(models(spark, sf_dir), ["model"], CUT), ["model"], [0.05, 0.13, 0.4])


@query(
    "evl16_selectivity",
    MODELS + f"SELECT model, round(avg(CAST(p >= 0.14 AS INTEGER)), 6) AS predicted_rate, round(avg(y), 6) AS actual_rate, {mean_p()} AS mean_score FROM models GROUP BY model",
)
def selectivity(spark, sf_dir):
    return models(spark, sf_dir).groupBy("model").agg(
        r6(F.avg((F.col("p") >= CUT).cast("int"))).alias("predicted_rate"),
        r6(F.avg("y")).alias("actual_rate"),
        mean_score(F.col("p")).alias("mean_score"),
    )


@query(
    "evl17_base_rates",
    CONTACTS + 'SELECT job, count(*) AS "rows", round(avg(y), 6) AS prevalence, round(greatest(avg(y), 1 - avg(y)), 6) AS majority_accuracy FROM contacts GROUP BY job',
)
def base_rates(spark, sf_dir):
    return M.base_rates(contacts(spark, sf_dir), ["job"])


CV = ["balanced_accuracy", "f1", "precision", "recall", "cost"]
CV_SQL = MODELS + FOLD_SQL + f""", c AS (SELECT model, fold, {counts_sql('0.14')} FROM folds GROUP BY model, fold), m AS (SELECT model, fold, {decision_sql()} FROM c),
t AS (UNPIVOT (SELECT model, fold, balanced_accuracy, f1, precision, recall, cost FROM m) ON balanced_accuracy, f1, precision, recall, cost INTO NAME metric VALUE value)
"""


@query(
    "evl18_cv_summary",
    CV_SQL + "SELECT model, metric, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(stddev_samp(value) / sqrt(count(*)), 6) AS sem FROM t GROUP BY 1, 2",
)
def cv_summary(spark, sf_dir):
    per_fold = M.decision_metrics(fold_confusion(spark, sf_dir), ["model", "fold"])
    return dispersion(melt_metrics(per_fold, ["model", "fold"], CV), ["model", "metric"])


@query(
    "evl20_paired_fold_differences",
    CV_SQL + """, d AS (SELECT a.model, a.metric, a.value - b.value AS value FROM t AS a JOIN t AS b ON a.fold = b.fold AND a.metric = b.metric AND b.model = 'history_only' WHERE a.model <> 'history_only')
SELECT model, metric, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(stddev_samp(value) / sqrt(count(*)), 6) AS sem FROM d GROUP BY 1, 2""",
)
def paired(spark, sf_dir):
    per_fold = M.decision_metrics(fold_confusion(spark, sf_dir), ["model", "fold"])
    return dispersion(M.paired_differences(per_fold, "history_only", CV), ["model", "metric"])


AUDIT = ["age", "balance", "campaign", "pdays", "duration"]


@query(
    "evl22_univariate_leakage_audit",
    CONTACTS + """, t AS (UNPIVOT (SELECT y, CAST(age AS DOUBLE) AS age, balance, CAST(campaign AS DOUBLE) AS campaign, CAST(pdays AS DOUBLE) AS pdays, duration FROM contacts)
  ON age, balance, campaign, pdays, duration INTO NAME feature VALUE value),
""" + ranking_sql("t", "feature", "value") + " SELECT feature, roc_auc, feature IN ('campaign', 'duration') AS known_too_late FROM auc",
)
def audit(spark, sf_dir):
    tidy = tall(contacts(spark, sf_dir), ["y"], AUDIT)
    table = M.value_auc(tidy, ["feature"])
    return table.withColumn("known_too_late", F.col("feature").isin("campaign", "duration"))


REPLICATES = 2000


def weights_sql(source: str, key: str, seed: str = "boot", replicates: int = REPLICATES) -> str:
    """Every row of ``source`` per replicate, with its weight as column w; every key and replicate draws on its own."""
    digest = f"md5('{seed}' || '|' || CAST(b AS VARCHAR) || '|' || CAST({key} AS VARCHAR))"
    cuts = " + ".join(f"CAST(u >= '{c:04x}' AS INTEGER)" for c in B.POISSON_CUTS if c < 65536)
    return f"""digests AS (SELECT s.*, b, {digest} AS d FROM {source} AS s, range({-(-replicates // 8)}) AS t(b)),
drawn AS (SELECT * EXCLUDE (d, b, j), CAST(b * 8 + j AS INTEGER) AS replicate, substr(d, CAST(4 * j + 1 AS INTEGER), 4) AS u FROM digests, range(8) AS t(j) WHERE b * 8 + j < {replicates}),
weighted AS (SELECT *, {cuts} AS w FROM drawn)"""


def linear_weights_sql(source: str, key: str, seed: str = "boot", replicates: int = REPLICATES) -> str:
    """The same with the weights of all replicates from one hash a key."""
    number = lambda text: f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"
    draw = f"(((slope * h + intercept) % {B.PRIME}) >> {B.DRAW_SHIFT})"
    cuts = " + ".join(f"CAST({draw} >= {c} AS INTEGER)" for c in B.POISSON_CUTS if c < 65536)
    return f"""hashed AS (SELECT s.*, {number(f"'{seed}|' || CAST({key} AS VARCHAR)")} % {B.PRIME} AS h FROM {source} AS s),
lines AS (SELECT CAST(r AS INTEGER) AS replicate, 1 + {number(f"'{seed}|slope|' || CAST(r AS VARCHAR)")} % {B.PRIME - 1} AS slope,
  {number(f"'{seed}|intercept|' || CAST(r AS VARCHAR)")} % {B.PRIME} AS intercept FROM range({replicates}) AS t(r)),
weighted AS (SELECT hashed.* EXCLUDE (h), replicate, {cuts} AS w FROM hashed, lines)"""


INTERVAL_SQL = """, tidy AS (UNPIVOT samples ON cost_per_row, recall, precision INTO NAME metric VALUE value)
SELECT metric, count(value) AS replicates, round(quantile_cont(value, 0.025), 6) AS low, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.975), 6) AS high FROM tidy GROUP BY metric"""
SAMPLES_SQL = """, samples AS (SELECT (fp + 5.0 * fn) / CAST(tn + fp + fn + tp AS DOUBLE) AS cost_per_row, tp / CAST(nullif(tp + fn, 0) AS DOUBLE) AS recall, tp / CAST(nullif(tp + fp, 0) AS DOUBLE) AS precision FROM totals)"""


def cell_columns():
    hit, pos = F.col("p") >= CUT, F.col("y") == 1
    return {"tn": ~hit & ~pos, "fp": hit & ~pos, "fn": ~hit & pos, "tp": hit & pos}


def samples(totals):
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    zero = F.lit(0.0)
    return totals.select(
        ((fp + 5.0 * fn) / (tn + fp + fn + tp)).alias("cost_per_row"),
        (tp / F.nullif(tp + fn, zero)).alias("recall"),
        (tp / F.nullif(tp + fp, zero)).alias("precision"),
    )


TOTALS_SQL = """, totals AS (SELECT replicate, sum(w * CAST(p < 0.14 AND y = 0 AS INTEGER)) AS tn, sum(w * CAST(p >= 0.14 AND y = 0 AS INTEGER)) AS fp,
  sum(w * CAST(p < 0.14 AND y = 1 AS INTEGER)) AS fn, sum(w * CAST(p >= 0.14 AND y = 1 AS INTEGER)) AS tp FROM weighted GROUP BY replicate)"""


@query("evl23_bootstrap_interval", SCORED + ", " + linear_weights_sql("(SELECT contact_id, y, p FROM scored)", "contact_id") + TOTALS_SQL + SAMPLES_SQL + INTERVAL_SQL)
def bootstrap(spark, sf_dir):
    totals = B.bootstrap_totals(scored(spark, sf_dir), "contact_id", REPLICATES, cell_columns(), linear=True)
    return B.percentile_interval(samples(totals), ["cost_per_row", "recall", "precision"])


@query("evl24_cluster_bootstrap", SCORED + ", " + weights_sql("(SELECT client_id, y, p FROM scored)", "client_id") + TOTALS_SQL + SAMPLES_SQL + INTERVAL_SQL)
def cluster_bootstrap(spark, sf_dir):
    totals = B.cluster_totals(scored(spark, sf_dir), "client_id", REPLICATES, cell_columns())
    return B.percentile_interval(samples(totals), ["cost_per_row", "recall", "precision"])


REPORT_SQL = MODELS + ", " + ranking_sql("models", "model") + f""", c AS (SELECT model, {counts_sql('0.14')}, round(avg({LL_SQL}), 6) AS log_loss, round(avg((p - y) * (p - y)), 6) AS brier FROM models GROUP BY model),
rep AS (SELECT c.model, log_loss, brier, tn, fp, fn, tp, {decision_sql()}, roc_auc, average_precision FROM c JOIN auc ON c.model = auc.model JOIN ap ON c.model = ap.model)
"""


@query("evl26_model_comparison", REPORT_SQL + "SELECT * FROM rep")
def comparison(spark, sf_dir):
    return M.model_report(models(spark, sf_dir), ["model"], CUT)


@query(
    "evl26_best_by_metric",
    REPORT_SQL + """SELECT 'log_loss' AS metric, arg_min(model, {'v': log_loss, 'm': model}) AS best, min(log_loss) AS value FROM rep
UNION ALL SELECT 'cost', arg_min(model, {'v': cost, 'm': model}), min(cost) FROM rep
UNION ALL SELECT 'roc_auc', arg_min(model, {'v': -roc_auc, 'm': model}), max(roc_auc) FROM rep""",
)
def best_by_metric(spark, sf_dir):
    return M.best_models(M.model_report(models(spark, sf_dir), ["model"], CUT), ["log_loss", "cost"], ["roc_auc"])


QUANTILE_BINS = ", ".join(f"{i / 10}" for i in range(1, 10))
CURVE_SQL = MODELS + f""", e AS (SELECT model, quantile_cont(p, [{QUANTILE_BINS}]) AS edges FROM models GROUP BY model),
b AS (SELECT m.model, y, p, CAST(len(list_filter(edges, lambda x: x < p)) AS INTEGER) AS bin FROM models AS m JOIN e ON e.model = m.model),
curve AS (SELECT model, bin, count(*) AS n, {mean_p()} AS mean_predicted, round(avg(y), 6) AS observed_rate FROM b GROUP BY model, bin)
"""
FIXED_SQL = MODELS + f""", b AS (SELECT model, y, p, CAST(greatest(ceil(CAST(round(p * 1000000.0) AS BIGINT) * 10 / 1000000.0) - 1, 0) AS INTEGER) AS bin FROM models),
curve AS (SELECT model, bin, count(*) AS n, {mean_p()} AS mean_predicted, round(avg(y), 6) AS observed_rate FROM b GROUP BY model, bin)
"""


@query("cal1_quantile_reliability", CURVE_SQL + "SELECT * FROM curve")
def quantile_reliability(spark, sf_dir):
    return K.quantile_curve(staged(models(spark, sf_dir).select("model", "y", "p"), "scores"), ["model"])


@query("cal2_fixed_reliability", FIXED_SQL + "SELECT * FROM curve")
def fixed_reliability(spark, sf_dir):
    return K.fixed_curve(models(spark, sf_dir), ["model"])


@query(
    "cal3_expected_calibration_error",
    FIXED_SQL + 'SELECT model, CAST(sum(n) AS BIGINT) AS "rows", round(sum(n * abs(observed_rate - mean_predicted)) / CAST(sum(n) AS DOUBLE), 6) AS ece FROM curve GROUP BY model',
)
def calibration_error(spark, sf_dir):
    return K.expected_calibration_error(K.fixed_curve(models(spark, sf_dir), ["model"]), ["model"])
