"""Drift, delayed-label performance, retraining gate."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import mean_score, r6, ratio
from ..operators import drift as D
from ..operators import metrics as M
from ..operators.quantiles import tall
from ..operators.scoring import CONTACT_ONLY, score
from ..session import staged
from ..sources.frames import contacts, read_table
from .base import CONTACTS, P_CONTACT, SCORED, counts_sql, decision_sql, mean_p, query
from .evaluation import weights_sql

PART_SQL = "CASE WHEN contact_date < DATE '1998-01-01' THEN 'ref' ELSE 'cur' END"
TALL_SQL = CONTACTS + f""", tidy AS (SELECT part, contact_id, feature, value FROM (UNPIVOT (SELECT contact_id, {PART_SQL} AS part, CAST(age AS DOUBLE) AS age, balance, CAST(previous AS DOUBLE) AS previous,
  CAST(pdays AS DOUBLE) AS pdays, CAST(contact_id % 2 AS DOUBLE) AS parity FROM contacts) ON age, balance, previous, pdays, parity INTO NAME feature VALUE value))
"""
FEATURES = ["age", "balance", "previous", "pdays", "parity"]


def drift_sql(source: str = "tidy", by: str = "feature") -> str:
    """CTEs ed, sh, div, ks over a tidy table (part, <by>, value)."""
    points = ", ".join(str(i / 10) for i in range(11))
    return f""", qs AS (SELECT {by}, quantile_cont(value, [{points}]) AS q FROM {source} WHERE part = 'ref' GROUP BY {by}),
ed AS (SELECT {by}, list_sort(list_distinct(q)) AS edges FROM qs),
bn AS (SELECT t.{by}, part, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) AS bin FROM {source} AS t JOIN ed ON ed.{by} = t.{by}),
grid AS (SELECT {by}, unnest(range(len(edges) - 1)) AS bin FROM ed WHERE len(edges) >= 3),
ct AS (SELECT g.{by}, g.bin, count(*) FILTER (WHERE part = 'ref') AS n_ref, count(*) FILTER (WHERE part = 'cur') AS n_cur FROM grid AS g LEFT JOIN bn ON bn.{by} = g.{by} AND bn.bin = g.bin GROUP BY 1, 2),
sh AS (SELECT {by}, bin, greatest(n_ref / CAST(sum(n_ref) OVER (PARTITION BY {by}) AS DOUBLE), 1e-6) AS p, greatest(n_cur / CAST(sum(n_cur) OVER (PARTITION BY {by}) AS DOUBLE), 1e-6) AS q FROM ct),
nm AS (SELECT *, p / sum(p) OVER (PARTITION BY {by}) AS p1, q / sum(q) OVER (PARTITION BY {by}) AS q1 FROM sh),
div AS (SELECT {by}, round(sum((q - p) * ln(q / p)), 6) AS psi, round(sum((p1 * log2(p1 / ((p1 + q1) / 2)) + q1 * log2(q1 / ((p1 + q1) / 2))) / 2), 6) AS js FROM nm GROUP BY {by}),
vc AS (SELECT {by}, value, count(*) FILTER (WHERE part = 'ref') AS r, count(*) FILTER (WHERE part = 'cur') AS c FROM {source} GROUP BY 1, 2),
cd AS (SELECT {by}, sum(r) OVER w / CAST(sum(r) OVER (PARTITION BY {by}) AS DOUBLE) AS fr, sum(c) OVER w / CAST(sum(c) OVER (PARTITION BY {by}) AS DOUBLE) AS fc,
  sum(r) OVER (PARTITION BY {by}) AS n, sum(c) OVER (PARTITION BY {by}) AS m FROM vc WINDOW w AS (PARTITION BY {by} ORDER BY value)),
k0 AS (SELECT {by}, max(abs(fr - fc)) AS d, CAST(max(n) AS BIGINT) AS n_ref, CAST(max(m) AS BIGINT) AS n_cur FROM cd GROUP BY {by}),
k1 AS (SELECT *, CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur) * d * d AS x2 FROM k0),
ks AS (SELECT {by}, n_ref, n_cur, round(d, 6) AS ks_stat, round(CASE WHEN x2 < 0.04 THEN 1.0 ELSE greatest(least(2.0 * list_sum(list_transform(range(1, 101), lambda j: CASE WHEN j % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * exp(-2.0::DOUBLE * j * j * x2))), 1.0), 0.0) END, 6) AS ks_p FROM k1)
"""


REPORT_SQL = """SELECT ed.feature, CASE WHEN len(edges) >= 3 THEN psi ELSE 0.0 END AS psi, CASE WHEN len(edges) >= 3 THEN js ELSE 0.0 END AS js,
  CASE WHEN len(edges) >= 3 THEN ks_stat ELSE 0.0 END AS ks_stat, CASE WHEN len(edges) >= 3 THEN ks_p ELSE 1.0 END AS ks_p
FROM ed LEFT JOIN div ON div.feature = ed.feature LEFT JOIN ks ON ks.feature = ed.feature"""


def tidy_contacts(spark, sf_dir):
    part = F.when(F.col("contact_date") < F.lit("1998-01-01").cast("date"), "ref").otherwise("cur")
    frame = contacts(spark, sf_dir).withColumns({"part": part, "parity": F.col("contact_id") % 2})
    return staged(tall(frame, ["part", "contact_id"], FEATURES), "drift")


@query("drf1_psi", TALL_SQL + drift_sql() + "SELECT ed.feature, CASE WHEN len(edges) >= 3 THEN psi ELSE 0.0 END AS psi FROM ed LEFT JOIN div ON div.feature = ed.feature")
def psi(spark, sf_dir):
    return D.numeric_drift(tidy_contacts(spark, sf_dir), ks=False).select("feature", "psi")


@query("drf2_ks", TALL_SQL + drift_sql() + "SELECT feature, n_ref, n_cur, ks_stat, ks_p FROM ks")
def ks(spark, sf_dir):
    return D.ks_two_sample(tidy_contacts(spark, sf_dir))


@query("drf3_jensen_shannon", TALL_SQL + drift_sql() + "SELECT feature, js FROM div")
def jensen_shannon(spark, sf_dir):
    tidy = tidy_contacts(spark, sf_dir)
    cells = D.value_cells(tidy)
    return D.divergences(D.share_table(cells, D.reference_edges(cells))).select("feature", "js")


LARGE_SQL = """WITH tidy AS (SELECT * FROM (UNPIVOT (SELECT CASE WHEN l_shipdate < TIMESTAMP '1997-01-01' THEN 'ref' ELSE 'cur' END AS part, l_quantity AS quantity, l_extendedprice AS price, l_tax AS tax FROM lineitem)
  ON quantity, price, tax INTO NAME feature VALUE value))
"""


@query("drf1_large_frame", LARGE_SQL + drift_sql() + REPORT_SQL)
def large(spark, sf_dir):
    raw = read_table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"), "ref").otherwise("cur").alias("part"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("tax"),
    )
    return D.numeric_drift(staged(tall(raw, ["part"], ["quantity", "price", "tax"]), "drift"))


LEVELS_SQL = CONTACTS + f""", t AS (SELECT part, feature, value FROM (UNPIVOT (SELECT {PART_SQL} AS part, job, contact, poutcome, CAST(y AS VARCHAR) AS outcome FROM contacts) ON job, contact, poutcome, outcome INTO NAME feature VALUE value)),
lv AS (SELECT feature, value AS level, count(*) FILTER (WHERE part = 'ref') AS r, count(*) FILTER (WHERE part = 'cur') AS c FROM t GROUP BY 1, 2),
tt AS (SELECT *, CAST(sum(r) OVER f AS DOUBLE) AS ra, CAST(sum(c) OVER f AS DOUBLE) AS ca, count(*) OVER f - 1 AS df FROM lv WINDOW f AS (PARTITION BY feature)),
ex AS (SELECT *, ra * (r + c) / (ra + ca) AS er, ca * (r + c) / (ra + ca) AS ec FROM tt),
gp AS (SELECT feature, df, er, ec, CASE WHEN df = 1 THEN abs(r - er) - least(0.5, abs(r - er)) ELSE abs(r - er) END AS gr, CASE WHEN df = 1 THEN abs(c - ec) - least(0.5, abs(c - ec)) ELSE abs(c - ec) END AS gc FROM ex),
chi AS (SELECT feature, max(df) AS df, round(sum(gr * gr / er + gc * gc / ec), 6) AS chi2 FROM gp GROUP BY feature)
"""


def tidy_levels(spark, sf_dir):
    part = F.when(F.col("contact_date") < F.lit("1998-01-01").cast("date"), "ref").otherwise("cur")
    frame = contacts(spark, sf_dir).withColumns({"part": part, "outcome": F.col("y")})
    return tall(frame, ["part"], ["job", "contact", "poutcome", "outcome"], cast="string")


@query("drf4_chi_square", LEVELS_SQL + "SELECT feature, df, chi2 FROM chi")
def chi_square(spark, sf_dir):
    return D.chi_square(D.level_table(tidy_levels(spark, sf_dir)))


@query(
    "drf4_category_shares",
    LEVELS_SQL + """, sh AS (SELECT feature, greatest(r / ra, 1e-6) AS p, greatest(c / ca, 1e-6) AS q FROM tt), nm AS (SELECT feature, p, q, p / sum(p) OVER (PARTITION BY feature) AS p1, q / sum(q) OVER (PARTITION BY feature) AS q1 FROM sh)
SELECT feature, round(sum((q - p) * ln(q / p)), 6) AS psi, round(sum((p1 * log2(p1 / ((p1 + q1) / 2)) + q1 * log2(q1 / ((p1 + q1) / 2))) / 2), 6) AS js FROM nm GROUP BY feature""",
)
def category_shares(spark, sf_dir):
    return D.divergences(D.level_shares(D.level_table(tidy_levels(spark, sf_dir))))


@query("drf4_chi_square_p_value")
def chi_square_p(spark, sf_dir):
    return D.benjamini_hochberg(D.chi_square_tail(D.chi_square(D.level_table(tidy_levels(spark, sf_dir)))))


@query(
    "drf5_benjamini_hochberg",
    TALL_SQL + drift_sql() + """, r AS (SELECT feature, ks_p, row_number() OVER (ORDER BY ks_p, feature) AS rk, count(*) OVER () AS m FROM ks)
SELECT feature, ks_p, round(least(greatest(min(ks_p * m / rk) OVER (ORDER BY rk DESC), 0.0), 1.0), 6) AS p_adjusted FROM r""",
)
def adjust(spark, sf_dir):
    tests = D.ks_two_sample(tidy_contacts(spark, sf_dir)).select("feature", "ks_p")
    return D.benjamini_hochberg(tests, "ks_p")


SCORE_SQL = SCORED + f""", halves AS (SELECT {PART_SQL} AS part, p, {P_CONTACT} AS other FROM scored),
tidy AS (SELECT 'self' AS feature, part, p AS value FROM (SELECT 'ref' AS part, p FROM halves WHERE part = 'ref' UNION ALL SELECT 'cur', p FROM halves WHERE part = 'ref')
  UNION ALL SELECT 'natural', part, p FROM halves UNION ALL SELECT 'shifted', part, CASE WHEN part = 'cur' THEN other ELSE p END FROM halves)
"""


@query("drf6_prediction_drift", SCORE_SQL + drift_sql() + REPORT_SQL)
def prediction_drift(spark, sf_dir):
    part = F.when(F.col("contact_date") < F.lit("1998-01-01").cast("date"), "ref").otherwise("cur")
    halves = staged(
        score(score(contacts(spark, sf_dir)), CONTACT_ONLY, "other").select(part.alias("part"), "p", "other"), "scores"
    )
    ref = halves.filter("part = 'ref'")

    def named(df, feature, value, part="part"):
        return df.select(F.lit(feature).alias("feature"), F.expr(part).alias("part"), F.expr(value).alias("value"))

    tidy = named(ref, "self", "p").unionByName(named(ref, "self", "p", "'cur'"))
    tidy = tidy.unionByName(named(halves, "natural", "p"))
    tidy = tidy.unionByName(named(halves, "shifted", "CASE WHEN part = 'cur' THEN other ELSE p END"))
    return D.numeric_drift(tidy)


@query(
    "drf7_prevalence_drift",
    CONTACTS + """, m AS (SELECT CAST(date_trunc('year', contact_date) AS DATE) AS "window", count(*) AS n, round(avg(y), 6) AS rate FROM contacts GROUP BY 1)
SELECT "window", n, rate, round(rate - lag(rate) OVER (ORDER BY "window"), 6) AS change FROM m""",
)
def prevalence(spark, sf_dir):
    rates = contacts(spark, sf_dir).groupBy(F.trunc("contact_date", "year").alias("window")).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("y")).alias("rate")
    )
    return rates.withColumn("change", r6(F.col("rate") - F.lag("rate").over(Window.orderBy("window"))))


@query(
    "drf8_status_board",
    TALL_SQL + drift_sql() + """SELECT feature || ' PSI' AS signal, psi AS value, 0.1::DOUBLE AS warn, 0.25::DOUBLE AS critical,
  CASE WHEN psi >= 0.25 THEN 'critical' WHEN psi >= 0.1 THEN 'warning' ELSE 'ok' END AS status FROM div""",
)
def board(spark, sf_dir):
    report = D.numeric_drift(tidy_contacts(spark, sf_dir), ks=False).filter("feature <> 'parity'")
    signals = report.select(F.concat("feature", F.lit(" PSI")).alias("signal"), F.col("psi").alias("value"))
    return D.status_board(signals)


LIMITS = 2000
LIMIT_SQL = TALL_SQL + drift_sql() + """, rows0 AS (SELECT t.contact_id, t.feature, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= value)) AS bin FROM tidy AS t JOIN ed ON ed.feature = t.feature WHERE part = 'ref'),
bb AS (SELECT feature, bin, greatest(count(*) / CAST(sum(count(*)) OVER (PARTITION BY feature) AS DOUBLE), 1e-6) AS p FROM rows0 GROUP BY feature, bin), """ + weights_sql("rows0", "contact_id", "limits", LIMITS) + """,
dr AS (SELECT feature, replicate, bin, sum(w) AS w FROM weighted WHERE w > 0 GROUP BY 1, 2, 3),
sq AS (SELECT dr.feature, replicate, p, greatest(w / CAST(sum(w) OVER (PARTITION BY dr.feature, replicate) AS DOUBLE), 1e-6) AS q FROM dr JOIN bb ON bb.feature = dr.feature AND bb.bin = dr.bin),
ps AS (SELECT feature, replicate, sum((q - p) * ln(q / p)) AS psi FROM sq GROUP BY 1, 2)
SELECT feature, count(*) AS replicates, round(quantile_cont(psi, 0.95), 6) AS psi_limit FROM ps GROUP BY feature"""


@query("drf9_control_limits", LIMIT_SQL)
def limits(spark, sf_dir):
    return D.psi_control_limit(tidy_contacts(spark, sf_dir), "contact_id", LIMITS)


DELAYED_SQL = SCORED + f""", j AS (SELECT CAST(date_trunc('quarter', contact_date) AS DATE) AS "window", job, p, s.y AS y0, CASE WHEN o_orderstatus <> 'P' THEN s.y END AS y FROM scored AS s JOIN orders ON o_orderkey = contact_id),
c AS (SELECT "window", job, count(*) AS predictions, round(count(y) / CAST(count(*) AS DOUBLE), 6) AS label_coverage,
  {mean_p('CASE WHEN y IS NOT NULL THEN p END')} AS mean_score, round(avg(y), 6) AS observed_rate, {counts_sql('0.14')} FROM j GROUP BY GROUPING SETS (("window"), ("window", job)))
SELECT "window", job, predictions, label_coverage, mean_score, observed_rate, tn, fp, fn, tp, {decision_sql()} FROM c"""


def labelled_later(spark, sf_dir):
    """Scores with the outcome that has arrived; orders still open have none yet."""
    predictions = score(contacts(spark, sf_dir)).select("contact_id", "contact_date", "job", "p", "y")
    settled = read_table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("contact_id"), F.lit(True).alias("settled"))
    joined = predictions.join(settled, "contact_id", "left")
    return joined.withColumn("y", F.when(F.col("settled"), F.col("y"))).drop("settled")


@query("drf10_delayed_label_performance", DELAYED_SQL)
def delayed(spark, sf_dir):
    rows = labelled_later(spark, sf_dir).withColumn("window", F.date_trunc("quarter", "contact_date").cast("date"))
    hit, pos, neg = F.col("p") >= 0.14, F.col("y") == 1, F.col("y") == 0
    window, job = F.col("window"), F.col("job")
    table = rows.groupingSets([[window], [window, job]], window, job).agg(
        F.count(F.lit(1)).alias("predictions"),
        r6(ratio(F.count("y"), F.count(F.lit(1)))).alias("label_coverage"),
        mean_score(F.when(F.col("y").isNotNull(), F.col("p"))).alias("mean_score"),
        r6(F.avg("y")).alias("observed_rate"),
        F.count_if(~hit & neg).alias("tn"),
        F.count_if(hit & neg).alias("fp"),
        F.count_if(~hit & pos).alias("fn"),
        F.count_if(hit & pos).alias("tp"),
    )
    return M.decision_metrics(table, ["window", "job", "predictions", "label_coverage", "mean_score", "observed_rate"])


GATE_SQL = SCORED + f""", q AS (SELECT CAST(date_trunc('quarter', contact_date) AS DATE) AS "window", y, p, {P_CONTACT} AS other FROM scored),
s AS (SELECT "window", round(avg(CASE WHEN p >= 0.14 THEN 1 - y ELSE 5 * y END), 6) AS base_cost, round(avg(CASE WHEN other >= 0.14 THEN 1 - y ELSE 5 * y END), 6) AS candidate_cost, {mean_p()} AS mean_score FROM q GROUP BY 1),
b AS (SELECT *, mean_score > 0.1558 AS breach, base_cost > 0.26 AS degraded, candidate_cost <= base_cost AS candidate_passes FROM s),
i AS (SELECT *, sum(CAST(NOT breach AS INTEGER)) OVER (ORDER BY "window") AS island FROM b),
r AS (SELECT *, CASE WHEN breach THEN CAST(sum(CAST(breach AS BIGINT)) OVER (PARTITION BY island ORDER BY "window") AS BIGINT) ELSE 0 END AS run_length FROM i)
SELECT "window", base_cost, candidate_cost, mean_score, breach, degraded, candidate_passes, CAST(run_length AS BIGINT) AS run_length, run_length >= 2 AND degraded AND candidate_passes AS retrain FROM r"""


@query("drf11_retraining_gate", GATE_SQL)
def gate(spark, sf_dir):
    rows = score(score(contacts(spark, sf_dir)), CONTACT_ONLY, "other")

    def cost(p):
        return r6(F.avg(F.when(F.col(p) >= 0.14, 1 - F.col("y")).otherwise(5 * F.col("y"))))

    series = rows.groupBy(F.date_trunc("quarter", "contact_date").cast("date").alias("window")).agg(
        cost("p").alias("base_cost"), cost("other").alias("candidate_cost"), mean_score(F.col("p")).alias("mean_score")
    )
    flagged = series.withColumns(
        {
            "breach": F.col("mean_score") > 0.1558,
            "degraded": F.col("base_cost") > 0.26,
            "candidate_passes": F.col("candidate_cost") <= F.col("base_cost"),
        }
    )
    return D.retraining_gate(D.breach_runs(flagged, "window", "breach"), 2)


@query(
    "drf12_missing_rate_monitor",
    CONTACTS + """SELECT CAST(date_trunc('year', contact_date) AS DATE) AS "window", feature, count(*) AS "rows", round(avg(missing), 6) AS missing_rate FROM (
  SELECT contact_date, 'poutcome' AS feature, CAST(poutcome = 'unknown' AS INTEGER) AS missing FROM contacts UNION ALL SELECT contact_date, 'pdays', CAST(pdays = -1 AS INTEGER) FROM contacts
  UNION ALL SELECT contact_date, 'job', CAST(job IS NULL OR job = 'unknown' AS INTEGER) FROM contacts) GROUP BY 1, 2""",
)
def missing_monitor(spark, sf_dir):
    frame = contacts(spark, sf_dir).select(
        F.trunc("contact_date", "year").alias("window"),
        F.nullif(F.col("pdays"), F.lit(-1)).cast("string").alias("pdays"), "poutcome", "job",
    )
    tidy = frame.unpivot(["window"], ["pdays", "poutcome", "job"], "feature", "value")
    missing = F.coalesce(F.col("value") == "unknown", F.lit(True)).cast("int")
    return tidy.groupBy("window", "feature").agg(F.count(F.lit(1)).alias("rows"), r6(F.avg(missing)).alias("missing_rate"))

