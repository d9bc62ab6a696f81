"""Joins, aggregates, windows, sorts, set operations and reshaping."""

from pyspark.sql import functions as F

from ..functions.scalars import mean_score, r6, row_brier, row_log_loss
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import sketches as K
from ..operators.ordered import ordered_state
from ..operators.quantiles import exact_quantiles, tall
from ..operators.scoring import SCORECARDS, score, score_many
from ..operators.splits import stratified_folds, stratified_split
from ..session import staged
from ..sources.frames import contacts, day_number, event_log, lineitem_frame, read_table
from .base import (
    CONTACTS, LL_SQL, MODELS, P_CONTACT, P_FULL, P_HISTORY, SCORED, SPLITS, counts_sql, decision_sql, mean_p, query, sweep_sql,
)

FOLD_SQL = ", folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY model, y ORDER BY h, contact_id) - 1) % 5 AS INTEGER) AS fold FROM models)"
FOLD_METRICS = MODELS + FOLD_SQL + f""", fm AS (SELECT model, fold, avg({LL_SQL}) AS log_loss, avg((p - y) * (p - y)) AS brier, avg(CAST((p >= 0.14) = (y = 1) AS INTEGER)) AS accuracy FROM folds GROUP BY model, fold)
"""


@query(
    "jn1_delayed_label_join",
    SCORED + """SELECT contact_id AS prediction_id, p, CASE WHEN o_orderstatus <> 'P' THEN s.y END AS outcome
FROM scored AS s JOIN orders ON contact_id = o_orderkey""",
)
def delayed(spark, sf_dir):
    predictions = score(contacts(spark, sf_dir)).select(F.col("contact_id").alias("prediction_id"), "p")
    settled = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    positive = (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    outcomes = settled.select(F.col("o_orderkey").alias("prediction_id"), F.when(positive, 1).otherwise(0).alias("outcome"))
    return J.delayed_labels(predictions, outcomes)


@query(
    "jn2_as_of_join",
    """SELECT d.event_id, d.user_id, h.event_id AS latest_id, h.value AS latest_value
FROM (SELECT * FROM events WHERE event_type IN ('view', 'click')) AS d
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') AS h ON d.user_id = h.user_id AND d.ts > h.ts""",
)
def as_of(spark, sf_dir):
    log = event_log(spark, sf_dir)
    joined = J.as_of_join(
        log.filter(F.col("event_type").isin("view", "click")).select("event_id", "user_id", "ts"),
        log.filter("event_type = 'purchase'").withColumn("bought_id", F.col("event_id")),
        by="user_id",
        time="ts",
        key="event_id",
        history_columns=["bought_id", "value"],
        bucket=F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000),
    )
    return joined.select(
        "event_id", "user_id", F.col("latest.bought_id").alias("latest_id"), F.col("latest.value").alias("latest_value")
    )


@query(
    "jn3_vocabulary_join",
    """WITH v AS (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
SELECT source, count(*) AS n, source IN (SELECT source FROM v) AS known FROM documents GROUP BY source""",
)
def vocabulary(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    toxic = read_table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    vocab = docs.join(toxic, "doc_id").select("source").distinct()
    count = F.count(F.lit(1)).alias("n")
    known = J.in_vocabulary(docs, vocab, "source").groupBy("source").agg(count).withColumn("known", F.lit(True))
    other = J.outside_vocabulary(docs, vocab, "source").groupBy("source").agg(count).withColumn("known", F.lit(False))
    return known.unionByName(other)


@query("jn4_threshold_theta_join", MODELS + sweep_sql("models", "model"))
def theta(spark, sf_dir):
    return M.threshold_table(score_many(contacts(spark, sf_dir), keep=["y"]), ["model"])


@query(
    "jn6_score_alignment",
    MODELS + """SELECT contact_id, max(p) FILTER (WHERE model = 'full') AS "full", max(p) FILTER (WHERE model = 'contact_only') AS contact_only,
  max(p) FILTER (WHERE model = 'history_only') AS history_only FROM models GROUP BY contact_id""",
)
def alignment(spark, sf_dir):
    return J.align_scores(score_many(contacts(spark, sf_dir), keep=["contact_id"]), ["contact_id"], list(SCORECARDS))


@query(
    "agg1_value_counts",
    CONTACTS + "SELECT job, y, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS rate FROM contacts GROUP BY job, y",
)
def value_counts(spark, sf_dir):
    return A.value_counts(contacts(spark, sf_dir), ["job", "y"])


@query(
    "agg2_crosstab",
    CONTACTS + """SELECT poutcome, count(*) FILTER (WHERE y = 0) AS n_0, count(*) FILTER (WHERE y = 1) AS n_1,
  round(avg(CAST(y = 0 AS INTEGER)), 6) AS rate_0, round(avg(y), 6) AS rate_1 FROM contacts GROUP BY poutcome""",
)
def crosstab(spark, sf_dir):
    return A.crosstab_rates(contacts(spark, sf_dir), "poutcome", "y", [0, 1])


PROBS = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@query(
    "agg3_exact_quantiles",
    """WITH t AS (UNPIVOT (SELECT l_quantity AS quantity, l_extendedprice AS price, l_tax AS tax FROM lineitem) ON quantity, price, tax INTO NAME feature VALUE value)
SELECT feature, """ + ", ".join(f"round(quantile_cont(value, {p}), 6) AS q{int(p * 100):02d}" for p in PROBS) + " FROM t GROUP BY feature",
)
def quantiles(spark, sf_dir):
    raw = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("tax")
    )
    q = exact_quantiles(tall(raw, [], ["quantity", "price", "tax"]), ["feature"], "value", PROBS)
    return q.select("feature", *[r6(F.col("quantiles")[i]).alias(f"q{int(p * 100):02d}") for i, p in enumerate(PROBS)])


@query(
    "agg3_sketched_quantiles",
    """WITH u AS (SELECT event_type, count(*) AS "rows", count(value) AS "values", count(DISTINCT user_id) AS users FROM events GROUP BY event_type), p AS (SELECT unnest([0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]) AS probability)
SELECT event_type, "rows", "values", users, CAST(probability AS DOUBLE) AS probability, TRUE AS quantile_within, TRUE AS users_within FROM u, p""",
)
def sketched(spark, sf_dir):
    """Sketches per day of load are written down and merged; the exact answers, from the rows, lie within the bounds of the merged ones."""
    rows = read_table(spark, sf_dir, "events").select("event_type", "value", "user_id", F.col("ts").cast("date").alias("load"))
    stored = staged(K.load_sketches(rows, "load", ["event_type"], "value", "user_id"), "sketches")
    merged = staged(K.merged_sketches(stored, ["event_type"]), "merged")
    bounds = K.sketched_quantiles(merged, ["event_type"], PROBS).join(merged.select("event_type", "rows"), "event_type")
    users = K.sketched_distinct(merged, ["event_type"]).select("event_type", F.col("low").alias("u_low"), F.col("high").alias("u_high"))
    exact = exact_quantiles(rows.select("event_type", "value"), ["event_type"], "value", PROBS)
    exact = exact.select("event_type", F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in PROBS]).alias("p"), F.col("quantiles").alias("q"))).alias("e"))
    exact = exact.select("event_type", F.col("e.p").alias("probability"), F.col("e.q").alias("exact"))
    known = rows.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    both = bounds.join(exact, ["event_type", "probability"]).join(users, "event_type").join(known, "event_type")
    return both.select(
        "event_type", "rows", "values", "users", "probability", F.col("exact").between(F.col("low"), F.col("high")).alias("quantile_within"),
        F.col("users").between(F.col("u_low"), F.col("u_high")).alias("users_within"),
    )


@query(
    "agg4_histogram",
    CONTACTS + """, b AS (SELECT y, CAST(CASE WHEN balance >= 9000 THEN 10 WHEN balance < 0 THEN 0 ELSE floor(balance / 1000) + 1 END AS INTEGER) AS bin
  FROM contacts WHERE balance BETWEEN -1000 AND 10000)
SELECT y, bin, count(*) AS n, round(count(*) / (CAST(sum(count(*)) OVER (PARTITION BY y) AS DOUBLE) * 1000.0), 6) AS density FROM b GROUP BY y, bin""",
)
def histogram(spark, sf_dir):
    edges = F.array(*[F.lit(float(e)) for e in range(-1000, 10001, 1000)])
    return A.histogram(contacts(spark, sf_dir), ["y"], "balance", edges, density=True)


@query(
    "agg5_fold_dispersion",
    FOLD_METRICS + """, t AS (UNPIVOT fm ON log_loss, brier, accuracy INTO NAME metric VALUE value)
SELECT model, metric, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(stddev_samp(value) / sqrt(count(*)), 6) AS sem
FROM t GROUP BY model, metric""",
)
def fold_dispersion(spark, sf_dir):
    return A.dispersion(A.melt_metrics(fold_metrics(spark, sf_dir), ["model", "fold"], ["log_loss", "brier", "accuracy"]), ["model", "metric"])


def fold_metrics(spark, sf_dir):
    rows = stratified_folds(contacts(spark, sf_dir), "contact_id", 5)
    scored = score_many(rows, keep=["contact_id", "y", "fold"])
    right = (F.col("p") >= 0.14) == (F.col("y") == 1)
    return scored.groupBy("model", "fold").agg(
        F.avg(row_log_loss(F.col("y"), F.col("p"))).alias("log_loss"),
        F.avg(row_brier(F.col("y"), F.col("p"))).alias("brier"),
        F.avg(right.cast("int")).alias("accuracy"),
    )


@query(
    "agg6_score_correlation",
    CONTACTS + f""", w AS (SELECT {P_FULL} AS "full", {P_CONTACT} AS contact_only, {P_HISTORY} AS history_only FROM contacts)
SELECT 'full' AS "left", 'contact_only' AS "right", round(corr("full", contact_only), 6) AS correlation FROM w UNION ALL
SELECT 'full', 'history_only', round(corr("full", history_only), 6) FROM w UNION ALL
SELECT 'contact_only', 'history_only', round(corr(contact_only, history_only), 6) FROM w""",
)
def correlation(spark, sf_dir):
    frame = contacts(spark, sf_dir).select(*[c.probability().alias(m) for m, c in SCORECARDS.items()])
    return A.correlation_pairs(frame, list(SCORECARDS))


@query(
    "agg7_spearman",
    SCORED + """, r AS (SELECT rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS a,
  rank() OVER (ORDER BY duration) + (count(*) OVER (PARTITION BY duration) - 1) / 2.0 AS b FROM scored)
SELECT count(*) AS n, round(corr(CAST(a AS DOUBLE), CAST(b AS DOUBLE)), 6) AS spearman FROM r""",
)
def spearman(spark, sf_dir):
    return A.spearman(score(contacts(spark, sf_dir)), "p", "duration")


@query(
    "agg8_sliced_metrics",
    SCORED + f""", s AS (SELECT 'overall' AS slice, 'all' AS level, y, p FROM scored UNION ALL SELECT 'job', job, y, p FROM scored
  UNION ALL SELECT 'poutcome', poutcome, y, p FROM scored),
c AS (SELECT slice, level, {counts_sql('0.14')} FROM s GROUP BY slice, level)
SELECT slice, level, tn, fp, fn, tp, {decision_sql()} FROM c""",
)
def sliced(spark, sf_dir):
    rows = A.by_slice(score(contacts(spark, sf_dir)).select("job", "poutcome", "y", "p"), ["job", "poutcome"])
    return M.decision_metrics(M.confusion(rows, ["slice", "level"], 0.14), ["slice", "level"])


@query(
    "agg8_grouping_sets",
    SCORED + f"""SELECT job, poutcome, count(*) AS n, round(avg(y), 6) AS rate, {mean_p()} AS mean_score FROM scored
GROUP BY GROUPING SETS ((job, poutcome), (job), (poutcome), ())""",
)
def grouping_sets(spark, sf_dir):
    frame = score(contacts(spark, sf_dir))
    job, poutcome = F.col("job"), F.col("poutcome")
    return frame.groupingSets([[job, poutcome], [job], [poutcome], []], job, poutcome).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("y")).alias("rate"), mean_score(F.col("p")).alias("mean_score")
    )


@query("win1_group_mean", CONTACTS + "SELECT contact_id, round(avg(y) OVER (PARTITION BY job), 6) AS naive_mean FROM contacts")
def group_mean(spark, sf_dir):
    rows = A.group_mean(contacts(spark, sf_dir), "job", "y", "naive_mean")
    return rows.select("contact_id", r6(F.col("naive_mean")).alias("naive_mean"))


@query(
    "win3_expanding_count",
    CONTACTS + "SELECT contact_id, row_number() OVER (PARTITION BY job ORDER BY contact_date, contact_id) - 1 AS earlier_same_job_rows FROM contacts",
)
def expanding(spark, sf_dir):
    frame = contacts(spark, sf_dir).select("contact_id", "contact_date", "job")
    ranked = ordered_state(frame, ["job"], ["contact_date", "contact_id"], day_number("contact_date"), rank="_rn")
    return ranked.select("contact_id", (F.col("_rn") - 1).alias("earlier_same_job_rows"))


@query(
    "win4_running_best",
    SCORED + f""", sweep AS ({sweep_sql('scored')})
SELECT threshold, cost, min(cost) OVER (ORDER BY threshold) AS best_so_far,
  struct_extract(min({{'cost': cost, 'threshold': threshold}}) OVER (ORDER BY threshold), 'threshold') AS best_step FROM sweep""",
)
def running_best(spark, sf_dir):
    sweep = M.threshold_table(score(contacts(spark, sf_dir)))
    return A.running_best(sweep.select("threshold", "cost"), "threshold", "cost")


@query(
    "srt1_sort_by_metric",
    SCORED + f"""SELECT poutcome, {mean_p()} AS mean_score, CASE WHEN poutcome <> 'unknown' THEN round(avg(pdays), 6) END AS mean_gap FROM scored GROUP BY poutcome ORDER BY 3 NULLS LAST""",
)
def sort_by_metric(spark, sf_dir):
    gap = F.when(F.col("poutcome") != "unknown", r6(F.avg("pdays")))
    table = score(contacts(spark, sf_dir)).groupBy("poutcome").agg(mean_score(F.col("p")).alias("mean_score"), gap.alias("mean_gap"))
    return table.orderBy(F.col("mean_gap").asc_nulls_last(), "poutcome")


@query(
    "srt2_top_k",
    SCORED + """SELECT * FROM (SELECT 'top' AS side, contact_id, p FROM scored ORDER BY p DESC, contact_id LIMIT 10) UNION ALL
SELECT * FROM (SELECT 'bottom', contact_id, p FROM scored ORDER BY p, contact_id LIMIT 10)""",
)
def top_k(spark, sf_dir):
    frame = score(contacts(spark, sf_dir)).select("contact_id", "p")
    top = frame.orderBy(F.col("p").desc(), "contact_id").limit(10).withColumn("side", F.lit("top"))
    low = frame.orderBy("p", "contact_id").limit(10).withColumn("side", F.lit("bottom"))
    return top.unionByName(low)


@query("set1_union_all", SPLITS + "SELECT split, count(*) AS n FROM splits WHERE split <> 'test' GROUP BY split UNION ALL SELECT 'test', count(*) FROM splits WHERE split = 'test'")
def union_all(spark, sf_dir):
    rows = stratified_split(contacts(spark, sf_dir), "contact_id").select("contact_id", "split")
    parts = [rows.filter(F.col("split") == s) for s in ("development", "validation", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "set2_key_difference",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def difference(spark, sf_dir):
    orders, items = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    return A.key_difference(orders, items.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])


@query(
    "set2_row_difference",
    """SELECT o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS load FROM orders
EXCEPT ALL SELECT o_custkey, o_orderstatus, CAST(year(o_orderdate) - 1 AS INTEGER) FROM orders""",
)
def row_difference(spark, sf_dir):
    """Rows of each year's load that the next year's does not repeat."""
    orders = read_table(spark, sf_dir, "orders")
    load = F.year("o_orderdate")
    pick = lambda year: orders.select("o_custkey", "o_orderstatus", year.alias("load"))
    return pick(load).exceptAll(pick(load - 1))


@query("rsh1_melt", FOLD_METRICS + ", t AS (UNPIVOT fm ON log_loss, brier, accuracy INTO NAME metric VALUE value) SELECT model, fold, metric, round(value, 6) AS value FROM t")
def melt(spark, sf_dir):
    tidy = A.melt_metrics(fold_metrics(spark, sf_dir), ["model", "fold"], ["log_loss", "brier", "accuracy"])
    return tidy.withColumn("value", r6(F.col("value")))


@query(
    "rsh2_pivot",
    MODELS + f"SELECT model, round(avg({LL_SQL}), 6) AS log_loss, round(avg((p - y) * (p - y)), 6) AS brier FROM models GROUP BY model",
)
def pivot(spark, sf_dir):
    scored = score_many(contacts(spark, sf_dir), keep=["y"])
    wide = scored.groupBy("model").agg(*[c.alias(n) for n, c in M.probability_columns().items()])
    return A.pivot_metrics(A.melt_metrics(wide, ["model"], ["log_loss", "brier"]), "model", ["log_loss", "brier"])


@query(
    "agg1_large_frame",
    """SELECT l_linestatus, CAST(month(l_shipdate) AS INTEGER) AS ship_month, count(*) AS n,
  round(avg(CASE WHEN l_returnflag = 'R' AND l_discount >= 0.07 THEN 1 ELSE 0 END), 6) AS rate FROM lineitem GROUP BY 1, 2""",
)
def large_counts(spark, sf_dir):
    frame = lineitem_frame(spark, sf_dir)
    return frame.groupBy("l_linestatus", "ship_month").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("y")).alias("rate"))
