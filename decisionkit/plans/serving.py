"""Guarded batch inference, run records, and streams drained over the whole event tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_order
from ..functions.scalars import r6
from ..operators import contracts as C
from ..operators import drift as D
from ..operators import inference as V
from ..operators import metrics as M
from ..operators.quantiles import exact_quantiles
from ..operators.scoring import FULL, score
from ..operators.splits import stratified_split
from ..session import scratch_path, staged
from ..sources import files
from ..sources.frames import contacts, read_table
from ..sources.versions import VersionedTable
from ..streaming import monitors as S
from .base import LL_SQL, SCORED, SPLITS, counts_sql, decision_sql, hash_sql, query, ranking_sql

CUT = 0.14
BATCH = ["contact_id", "age", "balance", "previous", "contact", "job"]


@query(
    "inf1_guarded_scoring",
    SCORED + "SELECT contact_id, p AS subscription_probability, p >= 0.14 AS prioritize_call, 0.14::DOUBLE AS model_threshold FROM scored",
)
def guarded(spark, sf_dir):
    batch = staged(contacts(spark, sf_dir).select(*BATCH), "batch")
    return V.predict_batch(batch, FULL, CUT, "contact_id", BATCH)


TEST_SQL = SPLITS + ", ts AS (SELECT * FROM splits WHERE split = 'test'), " + ranking_sql("ts") + f""", c AS (SELECT {counts_sql('0.14')}, round(avg({LL_SQL}), 6) AS log_loss, round(avg((p - y) * (p - y)), 6) AS brier FROM ts),
final AS (SELECT log_loss, brier, tn, fp, fn, tp, {decision_sql()}, roc_auc, average_precision FROM c, auc, ap)
"""


@query("inf2_sealed_test", TEST_SQL + "SELECT 'round-1' AS \"cycle\", 0.14::DOUBLE AS threshold, * FROM final")
def sealed(spark, sf_dir):
    test = stratified_split(contacts(spark, sf_dir), "contact_id").filter("split = 'test'")
    return V.evaluate_sealed(staged(test.select("y", *FULL.required_columns())), FULL, CUT, scratch_path(spark, "runs"), "round-1")


@query(
    "inf3_run_record",
    SPLITS + """SELECT 'scorecard-1' AS model_version, CAST(42 AS INTEGER) AS seed, 0.14::DOUBLE AS threshold,
  (SELECT CAST(sum(CAST(CAST('0x' || substr(sha256(coalesce(CAST(contact_id AS VARCHAR), '∅') || '␟' || coalesce(CAST(y AS VARCHAR), '∅')), 1, 13) AS BIGINT) AS HUGEINT)) AS VARCHAR) FROM splits) AS fingerprint,
  count(*) FILTER (WHERE split = 'development') AS development_rows, count(*) FILTER (WHERE split = 'validation') AS validation_rows, count(*) FILTER (WHERE split = 'test') AS test_rows,
  CAST(sum(CASE WHEN split = 'test' THEN CASE WHEN p >= 0.14 THEN 1 - y ELSE 5 * y END ELSE 0 END) AS DOUBLE) AS cost FROM splits""",
)
def record(spark, sf_dir):
    rows = staged(stratified_split(contacts(spark, sf_dir), "contact_id").select("contact_id", "split", "y", *FULL.required_columns()))
    final = M.decision_metrics(M.confusion(score(rows.filter("split = 'test'")), [], CUT)).select("cost")
    fingerprint = files.table_fingerprint(rows, [F.col("contact_id"), F.col("y")])
    return V.run_record(rows, fingerprint, final, {"model_version": "scorecard-1", "seed": 42, "threshold": CUT})


DELAY = "10 minutes"
DONE_SQL = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def stream_rules():
    return [
        C.Rule("value is between 0 and 30", C.out_of_range("value", 0, 30)),
        C.Rule("event type is known", C.not_in_vocabulary("event_type", ["view", "click", "purchase", "signup"])),
    ]


def stream(spark, sf_dir):
    table = read_table(spark, sf_dir, "events")
    return S.event_stream(spark, f"{sf_dir}/events.parquet*", table.schema)


def in_two_loads(spark, sf_dir, late, run):
    """Drain a stream, add a hash-chosen part of the table (late rows or repeats), and drain it again."""
    rows = read_table(spark, sf_dir, "events")
    again = hash_order("late", "event_id") % 20 == 0
    path = scratch_path(spark, "replay")
    for i, part in enumerate([rows.filter(~again) if late else rows, rows.filter(again)]):
        part.write.parquet(f"{path}/part={i}")
        run(S.event_stream(spark, f"{path}/part=*", rows.schema))


@query(
    "str1_contract_gate",
    """SELECT event_id, concat_ws('; ', CASE WHEN value NOT BETWEEN 0 AND 30 THEN 'value is between 0 and 30' END,
  CASE WHEN event_type NOT IN ('view', 'click', 'purchase', 'signup') THEN 'event type is known' END) AS reasons FROM events""",
)
def gate(spark, sf_dir):
    path = scratch_path(spark, "gate")
    S.gate(stream(spark, sf_dir), stream_rules(), f"{path}/good", f"{path}/bad", f"{path}/checkpoint")
    good = spark.read.parquet(f"{path}/good").select("event_id", F.lit("").alias("reasons"))
    return good.unionByName(spark.read.parquet(f"{path}/bad").select("event_id", F.concat_ws("; ", "reasons").alias("reasons")))


@query(
    "str2_volume_monitor",
    f"""SELECT CAST(ts AS DATE) AS window_start, event_type, count(*) AS volume, round(count(*) FILTER (WHERE value > 20) / CAST(count(*) AS DOUBLE), 6) AS decision_rate,
  round(count(*) FILTER (WHERE props IS NULL) / CAST(count(*) AS DOUBLE), 6) AS missing_rate FROM events WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= {DONE_SQL} GROUP BY 1, 2""",
)
def volume(spark, sf_dir):
    path = scratch_path(spark, "volume")
    rows = S.volume_monitor(stream(spark, sf_dir), "ts", ["event_type"], F.col("value") > 20, F.col("props").isNull(), DELAY)
    S.to_table(rows, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


REFERENCE_SQL = "CAST(ts AS DATE) < DATE '2024-01-16'"


@query(
    "str3_sliding_drift",
    f"""WITH ed AS (SELECT quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS e FROM events WHERE {REFERENCE_SQL}),
b AS (SELECT CAST(ts AS DATE) AS d, len(list_filter(e[2:10], lambda x: x <= value)) AS bin FROM events, ed),
r AS (SELECT bin, greatest(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 1e-6) AS p FROM b WHERE d < DATE '2024-01-16' GROUP BY bin),
w AS (SELECT d AS window_start, bin FROM b UNION ALL SELECT CAST(d - INTERVAL 1 DAY AS DATE), bin FROM b),
c AS (SELECT window_start, bin, count(*) AS n FROM w WHERE window_start + INTERVAL 2 DAY <= {DONE_SQL} GROUP BY 1, 2),
g AS (SELECT DISTINCT window_start FROM c), f AS (SELECT g.window_start, r.bin, r.p, coalesce(n, 0) AS n FROM g CROSS JOIN r LEFT JOIN c ON c.window_start = g.window_start AND c.bin = r.bin),
s AS (SELECT *, greatest(n / CAST(sum(n) OVER (PARTITION BY window_start) AS DOUBLE), 1e-6) AS q FROM f)
SELECT window_start, CAST(sum(n) AS BIGINT) AS volume, round(sum((q - p) * ln(q / p)), 6) AS psi, CASE WHEN round(sum((q - p) * ln(q / p)), 6) >= 0.25 THEN 'critical' WHEN round(sum((q - p) * ln(q / p)), 6) >= 0.1 THEN 'warning' ELSE 'ok' END AS status FROM s GROUP BY 1""",
)
def sliding(spark, sf_dir):
    table = read_table(spark, sf_dir, "events")
    reference = table.filter(F.col("ts").cast("date") < F.lit("2024-01-16").cast("date"))
    edges = exact_quantiles(reference, [], "value", [i / 10 for i in range(11)]).first()[0]
    path = scratch_path(spark, "sliding")
    with S.rocksdb_state(spark):
        S.drift_monitor(stream(spark, sf_dir), reference, "ts", "value", edges, DELAY, "2 days", "1 day", f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").drop("batch")


JOIN_SQL = """WITH p AS (SELECT o_orderkey AS prediction_id, o_orderdate AS predicted_at FROM orders),
l AS (SELECT l_orderkey AS prediction_id, l_shipdate AS labelled_at, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem),
wm AS (SELECT least((SELECT max(predicted_at) FROM p), (SELECT max(labelled_at) FROM l)) - INTERVAL 1 DAY AS w),
j AS (SELECT p.prediction_id, p.predicted_at, l.labelled_at, l.label FROM p LEFT JOIN l ON l.prediction_id = p.prediction_id AND labelled_at >= predicted_at AND labelled_at <= predicted_at + INTERVAL 180 DAY)
SELECT prediction_id, CAST(predicted_at AS DATE) AS predicted_on, CAST(labelled_at AS DATE) AS labelled_on, label FROM j, wm WHERE label IS NOT NULL OR predicted_at + INTERVAL 180 DAY < w"""


@query("str4_delayed_label_join", JOIN_SQL)
def label_join(spark, sf_dir):
    orders, items = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    predictions = S.event_stream(spark, f"{sf_dir}/orders.parquet*", orders.schema, "o_orderdate").select(
        F.col("o_orderkey").alias("prediction_id"), F.col("o_orderdate").alias("predicted_at")
    )
    labels = S.event_stream(spark, f"{sf_dir}/lineitem.parquet*", items.schema, "l_shipdate").select(
        F.col("l_orderkey").alias("prediction_id"),
        F.col("l_shipdate").alias("labelled_at"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )
    path = scratch_path(spark, "label-join")
    joined = S.delayed_labels(predictions, labels, "prediction_id", "1 day", "180 days")
    with S.rocksdb_state(spark):  # predictions of 180 days wait for their labels
        S.to_table(joined, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").select(
        "prediction_id", F.col("predicted_at").cast("date").alias("predicted_on"),
        F.col("labelled_at").cast("date").alias("labelled_on"), "label",
    )


@query(
    "str5_late_label_backfill",
    'SELECT CAST(ts AS DATE) AS "day", count(*) AS labels, round(avg(CAST(event_type = \'purchase\' AS INTEGER)), 6) AS rate FROM events GROUP BY 1',
)
def backfill(spark, sf_dir):
    path = scratch_path(spark, "labels")

    def run(events):
        label = (F.col("event_type") == "purchase").cast("int").alias("label")
        S.label_log(events.select("event_id", F.col("ts").cast("date").alias("day"), label), f"{path}/log", f"{path}/checkpoint")

    in_two_loads(spark, sf_dir, True, run)
    newest = S.latest_labels(spark.read.parquet(f"{path}/log"), "event_id", ["day", "label"])
    return newest.groupBy("day").agg(F.count(F.lit(1)).alias("labels"), r6(F.avg("label")).alias("rate"))


VERSIONS_SQL = f"""WITH labels AS (SELECT CAST(ts AS DATE) AS "day", CAST(event_type = 'purchase' AS INTEGER) AS label,
  {hash_sql('late', 'event_id')} % 5 = 0 AS late FROM events)
SELECT 1 AS version, "day", count(*) AS labels, sum(CASE WHEN late THEN 0 ELSE label END)::BIGINT AS positives FROM labels GROUP BY "day"
UNION ALL SELECT 3, "day", count(*), sum(label)::BIGINT FROM labels GROUP BY "day\""""


@query("str5_versioned_labels", VERSIONS_SQL)
def versioned_labels(spark, sf_dir):
    """A stream upserts labels, a fifth of them provisional, and then their corrections; the old and the compacted version stay readable."""
    path = scratch_path(spark, "versioned-labels")
    table = VersionedTable(spark, f"{path}/table", "event_id", ["day", "label"])
    rows = read_table(spark, sf_dir, "events")
    late = hash_order("late", "event_id") % 5 == 0
    label = (F.col("event_type") == "purchase").cast("int")
    for i, part in enumerate([rows.withColumn("label", F.when(late, 0).otherwise(label)), rows.filter(late).withColumn("label", label)]):
        part.select("event_id", "ts", "label").write.parquet(f"{path}/arrived/part={i}")
        stream = S.event_stream(spark, f"{path}/arrived/part=*", spark.read.parquet(f"{path}/arrived/part={i}").schema)
        S.upsert_stream(stream.withColumn("day", F.col("ts").cast("date")), table, f"{path}/checkpoint")
    shown = [(1, table.read(1)), (table.compact(), table.read())]
    per_day = [df.groupBy("day").agg(F.count(F.lit(1)).alias("labels"), F.sum("label").alias("positives")).select(F.lit(v).alias("version"), "*") for v, df in shown]
    return per_day[0].union(per_day[1])


@query("str6_alert_deduplication", "SELECT event_id, user_id, event_type FROM events WHERE value > 20")
def deduplication(spark, sf_dir):
    path = scratch_path(spark, "alerts")

    def run(events):
        alerts = events.filter("value > 20").select("event_id", "ts", "user_id", "event_type")
        S.to_table(S.deduplicated(alerts, "ts", ["event_id"], "31 days"), f"{path}/out", f"{path}/checkpoint")

    with S.rocksdb_state(spark):  # the ids of 31 days
        in_two_loads(spark, sf_dir, False, run)
    return spark.read.parquet(f"{path}/out").select("event_id", "user_id", "event_type")


BREACH_SQL = f"""WITH m AS (SELECT event_type AS signal, CAST(ts AS DATE) AS "day", round(count(*) FILTER (WHERE value > 20) / CAST(count(*) AS DOUBLE), 6) > 0.1 AS breach FROM events WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= {DONE_SQL} GROUP BY 1, 2),
i AS (SELECT *, sum(CAST(NOT breach AS INTEGER)) OVER (PARTITION BY signal ORDER BY "day") AS island FROM m)
SELECT signal, "day", CAST(CASE WHEN breach THEN sum(CAST(breach AS INTEGER)) OVER (PARTITION BY signal, island ORDER BY "day") ELSE 0 END AS BIGINT) AS run_length FROM i
QUALIFY "day" <= max("day") OVER () - INTERVAL 2 DAY"""


@query("str7_sustained_alerts", BREACH_SQL)
def sustained(spark, sf_dir):
    path = scratch_path(spark, "sustained")
    rows = S.volume_monitor(stream(spark, sf_dir), "ts", ["event_type"], F.col("value") > 20, F.col("props").isNull(), DELAY)
    S.to_table(rows, f"{path}/daily", f"{path}/checkpoint-daily")
    daily = spark.readStream.schema(spark.read.parquet(f"{path}/daily").schema).parquet(f"{path}/daily")
    signals = daily.select(F.col("event_type").alias("signal"), F.col("window_start").cast("timestamp").alias("day"), (F.col("decision_rate") > 0.1).alias("breach"))
    with S.rocksdb_state(spark):
        S.to_table(S.sustained_alerts(signals, "signal", "day", "breach", "2 days"), f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").withColumn("day", F.col("day").cast("date"))


@query(
    "str8_session_pressure",
    f"""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR lag(ts) OVER w + INTERVAL 6 HOUR <= ts THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g),
a AS (SELECT user_id, sid, count(*) AS contacts, min(ts) AS f, max(ts) AS l FROM s GROUP BY 1, 2)
SELECT user_id, contacts, f AS first_contact, round(contacts / (1.0::DOUBLE + (epoch_us(l) - epoch_us(f)) / 60e6::DOUBLE), 6) AS pressure FROM a WHERE l + INTERVAL 6 HOUR <= {DONE_SQL}""",
)
def sessions(spark, sf_dir):
    path = scratch_path(spark, "sessions")
    rows = S.session_pressure(stream(spark, sf_dir), "ts", "user_id", "6 hours", DELAY)
    S.to_table(rows, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")

