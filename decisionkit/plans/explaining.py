"""Explanations of the frozen scorecard, and replays of a search over its weights."""

from pyspark.sql import functions as F

from ..functions.scalars import r6, row_log_loss, sigmoid
from ..operators import explain as X
from ..operators import metrics as M
from ..operators import tuning as T
from ..operators.scoring import FULL, score
from ..operators.splits import stratified_folds
from ..session import staged
from ..sources.frames import contacts
from .base import CONTACTS, LEVEL_SQL, P_FULL, SCORED, hash_sql, mean_p, query, ranking_sql

PHI_SQL = SCORED + f""", tm AS (SELECT contact_id, p, contact_date, CAST({LEVEL_SQL} AS DOUBLE) AS contact, CAST(0.00004 AS DOUBLE) * balance AS balance, CAST(0.004 AS DOUBLE) * age AS age, CAST(-0.03 AS DOUBLE) * previous AS previous FROM scored),
mn AS (SELECT avg(contact) AS c, avg(balance) AS b, avg(age) AS a, avg(previous) AS v FROM tm),
ph AS (SELECT contact_id, p, contact - c AS contact, balance - b AS balance, age - a AS age, previous - v AS previous FROM tm, mn),
lg AS (UNPIVOT ph ON contact, balance, age, previous INTO NAME feature VALUE phi)
"""


def attributions(spark, sf_dir):
    return X.linear_attributions(contacts(spark, sf_dir), FULL, "contact_id")


@query("xpl1_linear_attributions", PHI_SQL + "SELECT contact_id, feature, round(phi, 6) AS phi FROM lg")
def linear(spark, sf_dir):
    return attributions(spark, sf_dir).withColumn("phi", r6(F.col("phi")))


@query("xpl2_global_importance", PHI_SQL + "SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_phi FROM lg GROUP BY feature")
def importance(spark, sf_dir):
    return X.global_importance(attributions(spark, sf_dir))


LEVELS_SQL = CONTACTS + """, f AS (SELECT contact_id, 1.4::DOUBLE * CAST(contact = '1-URGENT' AS DOUBLE) AS a, 1.1::DOUBLE * CAST(contact = '2-HIGH' AS DOUBLE) AS b FROM contacts),
m AS (SELECT avg(a) AS ma, avg(b) AS mb FROM f), g AS (SELECT a - ma AS a, b - mb AS b FROM f, m)
SELECT 'contact' AS source, '1-URGENT' AS level, round(avg(abs(a)), 6) AS mean_abs_phi FROM g UNION ALL
SELECT 'contact', '2-HIGH', round(avg(abs(b)), 6) FROM g UNION ALL SELECT 'contact', NULL, round(avg(abs(a + b)), 6) FROM g"""


@query("xpl3_source_aggregation", LEVELS_SQL)
def by_source(spark, sf_dir):
    levels = X.level_attributions(contacts(spark, sf_dir), FULL, "contact_id", "contact")
    per_level = X.global_importance(levels, "level").select(F.lit("contact").alias("source"), "level", "mean_abs_phi")
    summed = levels.groupBy("contact_id").agg(F.sum("phi").alias("phi")).withColumn("source", F.lit("contact"))
    per_source = X.global_importance(summed, "source").select("source", F.lit(None).cast("string").alias("level"), "mean_abs_phi")
    return per_level.unionByName(per_source)


@query("xpl4_local_explanation", PHI_SQL + "SELECT contact_id, feature, round(phi, 6) AS phi FROM lg WHERE contact_id = (SELECT contact_id FROM scored ORDER BY p DESC, contact_id LIMIT 1)")
def local(spark, sf_dir):
    scores = score(contacts(spark, sf_dir)).select("contact_id", "p")
    top = X.local_explanation(attributions(spark, sf_dir), scores, "contact_id")
    return top.withColumn("phi", r6(F.col("phi")))


@query(
    "xpl5_importance_stability",
    SCORED + f""", tm AS (SELECT contact_id % 2 AS half, CAST({LEVEL_SQL} AS DOUBLE) AS contact, CAST(0.00004 AS DOUBLE) * balance AS balance, CAST(0.004 AS DOUBLE) * age AS age, CAST(-0.03 AS DOUBLE) * previous AS previous FROM scored),
mn AS (SELECT half AS hm, avg(contact) AS c, avg(balance) AS b, avg(age) AS a, avg(previous) AS v FROM tm GROUP BY half),
ph AS (SELECT half, contact - c AS contact, balance - b AS balance, age - a AS age, previous - v AS previous FROM tm JOIN mn ON hm = half),
lg AS (UNPIVOT ph ON contact, balance, age, previous INTO NAME feature VALUE phi),
im AS (SELECT feature, round(avg(abs(phi)) FILTER (WHERE half = 0), 6) AS x, round(avg(abs(phi)) FILTER (WHERE half = 1), 6) AS y FROM lg GROUP BY feature),
rk AS (SELECT rank() OVER (ORDER BY x) AS rx, rank() OVER (ORDER BY y) AS ry FROM im)
SELECT count(*) AS n, round(corr(rx, ry), 6) AS spearman FROM rk""",
)
def stability(spark, sf_dir):
    frame = contacts(spark, sf_dir)
    runs = [
        X.global_importance(X.linear_attributions(frame.filter(F.col("contact_id") % 2 == i), FULL, "contact_id"))
        for i in (0, 1)
    ]
    return X.importance_stability(*runs)


PERM_SQL = CONTACTS + f""", r0 AS (SELECT *, row_number() OVER (ORDER BY {hash_sql('5-0', 'contact_id')}, contact_id) AS rk FROM contacts),
r1 AS (SELECT balance AS b1, contact AS c1, row_number() OVER (ORDER BY {hash_sql('5-1', 'contact_id')}, contact_id) AS rk FROM contacts),
bal AS (SELECT r0.* REPLACE (b1 AS balance) FROM r0 JOIN r1 ON r1.rk = r0.rk), con AS (SELECT r0.* REPLACE (c1 AS contact) FROM r0 JOIN r1 ON r1.rk = r0.rk),
al AS (SELECT 'none' AS feature, y, {P_FULL} AS p FROM contacts UNION ALL SELECT 'balance', y, {P_FULL} FROM bal UNION ALL SELECT 'contact', y, {P_FULL} FROM con),
""" + ranking_sql("al", "feature") + " SELECT feature, roc_auc, round((SELECT roc_auc FROM auc WHERE feature = 'none') - roc_auc, 6) AS auc_drop FROM auc"


@query("xpl6_permutation_importance", PERM_SQL)
def permutation(spark, sf_dir):
    frame = staged(contacts(spark, sf_dir).select("contact_id", "y", *FULL.required_columns()))

    def scored(rows, name):
        return score(rows).select(F.lit(name).alias("feature"), "y", "p")

    rows = scored(frame, "none")
    for column in ("balance", "contact"):
        rows = rows.unionByName(scored(X.permuted(frame, "contact_id", column), column))
    table = M.ranking_metrics(rows, ["feature"]).select("feature", "roc_auc")
    base = table.filter("feature = 'none'").select("roc_auc")
    return table.withColumn("auc_drop", r6(base.scalar() - F.col("roc_auc")))


@query(
    "xpl7_monotonicity_audit",
    SCORED + f""", b AS (SELECT CAST(floor(balance / 1000) AS INTEGER) AS bin, p FROM scored), g AS (SELECT bin, count(*) AS n, {mean_p()} AS mean_score FROM b GROUP BY bin)
SELECT 'balance' AS feature, bin, n, mean_score, coalesce(mean_score < lag(mean_score) OVER (ORDER BY bin), FALSE) AS violation FROM g""",
)
def monotone(spark, sf_dir):
    rows = score(contacts(spark, sf_dir))
    return X.monotonicity(rows, "balance", F.floor(F.col("balance") / 1000).cast("int"))


TRIALS = 12
GRID_SQL = CONTACTS + f""", fl AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY h, contact_id) - 1) % 5 AS INTEGER) AS step FROM contacts),
tr AS (SELECT CAST(t AS INTEGER) AS trial, ((t * 7) % 12) / 4.0::DOUBLE - 4.0::DOUBLE AS intercept, ((t * 5) % 12) / 6.0::DOUBLE AS slope FROM range({TRIALS}) AS g(t)),
pr AS (SELECT trial, intercept, slope, step, y, 1.0 / (1.0 + exp(-(intercept + slope * CAST({LEVEL_SQL} AS DOUBLE)))) AS p FROM fl, tr),
lo AS (SELECT trial, intercept, slope, step, avg(-ln(CASE WHEN y = 1 THEN p ELSE 1.0 - p END)) AS loss FROM pr GROUP BY ALL)
"""


def trial_log(spark, sf_dir):
    """Fold losses of a fixed grid of trials: all trials are scored in one pass over the rows."""
    rows = stratified_folds(contacts(spark, sf_dir), "contact_id", 5, name="step").select("step", "y", "contact")
    grid = F.array(
        *[
            F.struct(
                F.lit(t).alias("trial"),
                F.lit(((t * 7) % 12) / 4.0 - 4.0).alias("intercept"),
                F.lit(((t * 5) % 12) / 6.0).alias("slope"),
            )
            for t in range(TRIALS)
        ]
    )
    tried = rows.withColumn("t", F.explode(grid)).select("step", "y", "contact", "t.*")
    p = sigmoid(F.col("intercept") + F.col("slope") * FULL.terms()["contact"])
    return tried.groupBy("trial", "intercept", "slope", "step").agg(F.avg(row_log_loss(F.col("y"), p)).alias("loss"))


def pruning_sql(source: str, trials: int, steps: int, startup: int = 3, wave: int = 4) -> str:
    """CTEs j0, j1, ...: per wave the steps that are run, judged by what earlier waves completed. ``source`` has trial, step, value, best."""
    parts, done = [], "SELECT trial, step, value FROM " + source + " WHERE FALSE"
    for w in range(-(-trials // wave)):
        parts.append(f"""d{w} AS ({done}), m{w} AS (SELECT step, count(*) AS n, round(median(value), 6) AS median FROM d{w} GROUP BY step),
f{w} AS (SELECT s.trial, s.step, s.value, CASE WHEN n >= {startup} THEN median END AS median, coalesce(n >= {startup} AND best > median AND s.step + 1 < {steps}, FALSE) AS prune
  FROM {source} AS s LEFT JOIN m{w} ON m{w}.step = s.step WHERE s.trial // {wave} = {w}),
j{w} AS (SELECT * FROM f{w} QUALIFY coalesce(max(prune) OVER (PARTITION BY trial ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) = FALSE)""")
        done += f" UNION ALL SELECT trial, step, value FROM j{w} WHERE trial NOT IN (SELECT trial FROM j{w} WHERE prune)"
    return ",\n".join(parts)


RULE_SQL = GRID_SQL + """, rm AS (SELECT trial, step, round(avg(loss) OVER (PARTITION BY trial ORDER BY step), 6) AS value FROM lo),
vb AS (SELECT *, min(value) OVER (PARTITION BY trial ORDER BY step) AS best FROM rm),
""" + pruning_sql("vb", TRIALS, 5)
JUDGED_SQL = " UNION ALL ".join(f"SELECT * FROM j{w}" for w in range(-(-TRIALS // 4)))


@query("tun2_median_pruning", RULE_SQL + " " + JUDGED_SQL)
def pruning(spark, sf_dir):
    return T.replay_pruning(trial_log(spark, sf_dir))


@query("tun2_live_pruning", RULE_SQL + f" SELECT trial, step, value, CASE WHEN prune THEN 'PRUNED' ELSE 'RAN' END AS state FROM ({JUDGED_SQL})")
def live_pruning(spark, sf_dir):
    """The same grid as concurrent trials that score their folds in Spark jobs of their own: the log of what they ran."""
    rows = staged(stratified_folds(contacts(spark, sf_dir), "contact_id", 5, name="step").select("step", "y", "contact"), "folds")

    def loss(params, fold):
        t = params["trial"]
        p = sigmoid(F.lit(((t * 7) % 12) / 4.0 - 4.0) + F.lit(((t * 5) % 12) / 6.0) * FULL.terms()["contact"])
        return rows.filter(F.col("step") == fold).agg(F.avg(row_log_loss(F.col("y"), p))).first()[0]

    history = T.search({}, loss, 5, TRIALS, spark=spark, drawn=[{"trial": t} for t in range(TRIALS)])
    return T.live_log(spark, history)


@query(
    "tun3_trial_history",
    GRID_SQL + """, v AS (SELECT trial, intercept, slope, round(avg(loss), 6) AS value FROM lo GROUP BY ALL)
SELECT trial, intercept, slope, value, min(value) OVER (ORDER BY trial) AS best_so_far FROM v""",
)
def history(spark, sf_dir):
    values = trial_log(spark, sf_dir).groupBy("trial", "intercept", "slope").agg(r6(F.avg("loss")).alias("value"))
    return T.history_with_best(values)


@query(
    "tun3_parameter_importance",
    GRID_SQL + """, v AS (SELECT trial, intercept, slope, avg(loss) AS value FROM lo GROUP BY ALL)
SELECT 'intercept' AS parameter, round(abs(corr(intercept, value)), 6) AS importance FROM v UNION ALL SELECT 'slope', round(abs(corr(slope, value)), 6) FROM v""",
)
def parameter_importance(spark, sf_dir):
    values = trial_log(spark, sf_dir).groupBy("trial", "intercept", "slope").agg(F.avg("loss").alias("value"))
    return T.parameter_importance(values, ["intercept", "slope"])

