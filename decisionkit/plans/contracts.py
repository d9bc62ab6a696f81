"""Contract checks over the whole frames."""

from pyspark.sql import functions as F

from ..operators import contracts as C
from ..sources.frames import contacts, event_log, labelled_documents, read_table
from .base import CONTACTS, query

REQUIRED = {"age", "balance", "contact", "previous", "housing"}


def strict_rules():
    return [
        C.Rule("age within 18..95", C.out_of_range("age", 18, 95)),
        C.Rule("gap of three days or marked -1", C.not_sentinel_or_range("pdays", low=3)),
        C.Rule("job among four segments", C.not_in_vocabulary("job", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"])),
        C.Rule("no overdrawn account", C.out_of_range("balance", 0)),
    ]


STRICT_SQL = {
    "age within 18..95": "age NOT BETWEEN 18 AND 95",
    "gap of three days or marked -1": "NOT (pdays = -1 OR pdays >= 3)",
    "job among four segments": "job NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')",
    "no overdrawn account": "NOT balance >= 0",
}
CHECKS_SQL = {
    "label known as 0 or 1": "y IS NULL OR y NOT IN (0, 1)",
    "age within 18..100": "age NOT BETWEEN 18 AND 100",
    "calendar day exists": '"day" NOT BETWEEN 1 AND 31',
    "calendar month exists": '"month" NOT BETWEEN 1 AND 12',
    "gap counted in days or marked -1": "NOT (pdays = -1 OR pdays >= 0)",
    "attempt number starts at 1": "campaign < 1",
}


def report_sql(checks, source="contacts"):
    return "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "check", count(*) FILTER (WHERE {bad}) AS violations, count(*) FILTER (WHERE {bad}) = 0 AS passed FROM {source}"""
        for name, bad in checks.items()
    )


REASONS_SQL = "concat_ws('; ', " + ", ".join(f"CASE WHEN {bad} THEN '{n}' END" for n, bad in STRICT_SQL.items()) + ")"


@query(
    "con1_column_set",
    CONTACTS + """SELECT 'missing' AS problem, 'housing' AS feature, count(*) AS "rows" FROM contacts UNION ALL
  SELECT 'extra', unnest(['campaign','client_id','contact_date','contact_id','day','duration','h','job','month','pdays','poutcome','y']), (SELECT count(*) FROM contacts)""",
)
def column_set(spark, sf_dir):
    frame = contacts(spark, sf_dir)
    missing, extra = C.column_set(frame.columns, REQUIRED, exact=True)
    lines = F.array(
        *[F.struct(F.lit("missing").alias("problem"), F.lit(c).alias("feature")) for c in missing],
        *[F.struct(F.lit("extra").alias("problem"), F.lit(c).alias("feature")) for c in extra],
    )
    return frame.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(lines), "rows")


@query(
    "con2_type_check",
    """SELECT o_orderkey AS contact_id, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS raw_age
FROM orders WHERE o_orderstatus = 'P'""",
)
def type_check(spark, sf_dir):
    raw = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("contact_id"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("raw_age"),
    )
    return raw.filter(C.not_numeric("raw_age"))


@query(
    "con3_range_check",
    CONTACTS + report_sql({"age": "age NOT BETWEEN 18 AND 95", "day": '"day" NOT BETWEEN 1 AND 28', "previous": "previous < 0", "balance": "balance < 0"}),
)
def ranges(spark, sf_dir):
    return C.quality_report(
        contacts(spark, sf_dir),
        [
            C.Rule("age", C.out_of_range("age", 18, 95)),
            C.Rule("day", C.out_of_range("day", 1, 28)),
            C.Rule("previous", C.out_of_range("previous", 0)),
            C.Rule("balance", C.out_of_range("balance", 0)),
        ],
    )


@query(
    "con4_sentinel_or_range",
    CONTACTS + report_sql({"pdays non-negative": "NOT (pdays = -1 OR pdays >= 0)", "pdays at least a week": "NOT (pdays = -1 OR pdays >= 7)"}),
)
def sentinel(spark, sf_dir):
    return C.quality_report(
        contacts(spark, sf_dir),
        [
            C.Rule("pdays non-negative", C.not_sentinel_or_range("pdays")),
            C.Rule("pdays at least a week", C.not_sentinel_or_range("pdays", low=7)),
        ],
    )


@query(
    "con5_closed_vocabulary",
    report_sql({"snapshot": "lang IS NULL OR lang NOT IN ('en', 'de')", "serving": "lang IS NOT NULL AND lang NOT IN ('en', 'de')"},
               "(SELECT CASE WHEN n_chars % 7 <> 0 THEN lang END AS lang FROM documents) AS d"),
)
def vocabulary(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select(F.when(F.col("n_chars") % 7 != 0, F.col("lang")).alias("lang"))
    return C.quality_report(
        docs,
        [
            C.Rule("snapshot", C.not_in_vocabulary("lang", ["en", "de"], nulls_allowed=False)),
            C.Rule("serving", C.not_in_vocabulary("lang", ["en", "de"])),
        ],
    )


@query(
    "con6_label_domain",
    report_sql({"binary": "target IS NULL OR target NOT IN (0, 1)"},
               "(SELECT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS target FROM orders) AS o"),
)
def label_domain(spark, sf_dir):
    target = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    orders = read_table(spark, sf_dir, "orders").select(target.alias("target"))
    return C.quality_report(orders, [C.Rule("binary", C.bad_label("target"))])


@query(
    "con7_row_count",
    """WITH n AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS load, count(*) AS "rows" FROM orders GROUP BY 1)
SELECT load, "rows", lag("rows") OVER w AS previous_rows, abs("rows" - lag("rows") OVER w) <= lag("rows") OVER w * 0.02 AS passed FROM n WINDOW w AS (ORDER BY load)""",
)
def row_count(spark, sf_dir):
    return C.row_count_bands(read_table(spark, sf_dir, "orders"), F.year("o_orderdate").alias("load"), 0.02)


@query(
    "con8_duplicate_key",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicates(spark, sf_dir):
    return C.duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "con9_missing_rate",
    CONTACTS + """, f AS (SELECT nullif(pdays, -1) AS pdays, nullif(poutcome, 'unknown') AS poutcome, age FROM contacts)
SELECT feature, missing, ceiling, round(missing / n, 6) AS missing_rate, missing / n <= ceiling AS passed FROM (
  SELECT 'pdays' AS feature, count(*) - count(pdays) AS missing, CAST(0.05 AS DOUBLE) AS ceiling, CAST(count(*) AS DOUBLE) AS n FROM f UNION ALL
  SELECT 'poutcome', count(*) - count(poutcome), CAST(0.2 AS DOUBLE), CAST(count(*) AS DOUBLE) FROM f UNION ALL
  SELECT 'age', count(*) - count(age), CAST(0.0 AS DOUBLE), CAST(count(*) AS DOUBLE) FROM f)""",
)
def missing(spark, sf_dir):
    frame = contacts(spark, sf_dir).withColumns(
        {"poutcome": F.nullif(F.col("poutcome"), F.lit("unknown")), "pdays": F.nullif(F.col("pdays"), F.lit(-1))}
    )
    return C.missing_rates(frame, {"pdays": 0.05, "poutcome": 0.2, "age": 0.0})


@query(
    "con10_finite_check",
    CONTACTS + report_sql({"ratio": "isnan(ratio) OR isinf(ratio)"}, "(SELECT CASE WHEN previous = 0 THEN CAST('NaN' AS DOUBLE) WHEN pdays = 0 THEN CAST('Infinity' AS DOUBLE) ELSE balance / previous END AS ratio FROM contacts) AS r"),
)
def finite(spark, sf_dir):
    # Unguarded division as a careless producer would deliver it: x/0 arrives as NaN or infinity.
    ratio = (
        F.when(F.col("previous") == 0, F.lit(float("nan")))
        .when(F.col("pdays") == 0, F.lit(float("inf")))
        .otherwise(F.col("balance") / F.nullif(F.col("previous").cast("double"), F.lit(0.0)))
    )
    frame = contacts(spark, sf_dir).select(ratio.alias("ratio"))
    return C.quality_report(frame, [C.Rule("ratio", C.not_finite("ratio"))])


@query(
    "con11_feature_availability",
    CONTACTS + """SELECT unnest(['campaign','duration','y','client_id','contact_date','contact_id','h']) AS feature,
  unnest(['not available','not available','not available','not in contract','not in contract','not in contract','not in contract']) AS problem,
  count(*) AS "rows" FROM contacts""",
)
def availability(spark, sf_dir):
    frame = contacts(spark, sf_dir)
    found = C.availability_violations(frame.columns, C.PREDICTION_FEATURES)
    lines = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(p).alias("problem")) for c, p in found])
    return frame.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(lines), "rows")


@query(
    "con12_freshness",
    """SELECT CAST(max(ts) AS DATE) AS newest, CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-15') AS INTEGER) AS age_days,
  date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-15') <= 7 AS fresh FROM events""",
)
def freshness(spark, sf_dir):
    return C.freshness(read_table(spark, sf_dir, "events"), "ts", F.lit("2024-02-15").cast("date"), 7)


@query(
    "con13_new_category_rate",
    """WITH d AS (SELECT doc_id, source FROM documents), ref AS (SELECT DISTINCT source FROM d WHERE doc_id % 50 = 0),
b AS (SELECT * FROM d WHERE doc_id % 50 <> 0), f AS (SELECT b.source FROM b LEFT JOIN ref ON b.source = ref.source WHERE ref.source IS NULL)
SELECT (SELECT count(*) FROM b) AS "rows", count(*) AS new_rows, count(DISTINCT source) AS new_levels,
  round(count(*) / CAST((SELECT count(*) FROM b) AS DOUBLE), 6) AS rate,
  round(count(*) / CAST((SELECT count(*) FROM b) AS DOUBLE), 6) > 0.05 AS alert FROM f""",
)
def new_categories(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    first = F.col("doc_id") % 50 == 0
    return C.new_category_rate(docs.filter(first), docs.filter(~first), "source", 0.05)


@query(
    "con14_mean_shift",
    """WITH m AS (SELECT CAST(ts AS DATE) AS "day", count(*) AS "rows", avg(value) AS mean FROM events GROUP BY 1)
SELECT "day", "rows", round(mean, 6) AS mean, round(mean - lag(mean) OVER (ORDER BY "day"), 6) AS shift,
  abs(mean - lag(mean) OVER (ORDER BY "day")) > 1.0 AS alert FROM m""",
)
def shift(spark, sf_dir):
    return C.mean_shift(event_log(spark, sf_dir), "day", "value", 1.0)


@query("con15_quality_report", CONTACTS + report_sql(CHECKS_SQL))
def quality(spark, sf_dir):
    return C.quality_report(contacts(spark, sf_dir), C.contact_rules())


@query(
    "con16_quarantine",
    CONTACTS + f"""SELECT contact_id, age, balance, {REASONS_SQL} AS reasons, {REASONS_SQL} = '' AS accepted FROM contacts""",
)
def quarantine(spark, sf_dir):
    good, bad = C.quarantine(contacts(spark, sf_dir).select("contact_id", "age", "balance", "pdays", "job"), strict_rules())
    keep = ["contact_id", "age", "balance"]
    accepted = good.select(*keep, F.lit("").alias("reasons"), F.lit(True).alias("accepted"))
    rejected = bad.select(*keep, F.concat_ws("; ", "reasons").alias("reasons"), F.lit(False).alias("accepted"))
    return accepted.unionByName(rejected)


@query("con16_fail_fast", CONTACTS + "SELECT contact_id, age, y FROM contacts")
def fail_fast(spark, sf_dir):
    return C.fail_fast(contacts(spark, sf_dir), C.contact_rules()).select("contact_id", "age", "y")


@query("con17_empty_batch", "SELECT count(*) AS labelled, count(*) > 0 AS passed FROM documents JOIN labels USING (doc_id)")
def empty_batch(spark, sf_dir):
    docs = C.require_rows(labelled_documents(spark, sf_dir))
    return docs.agg(F.count(F.lit(1)).alias("labelled")).withColumn("passed", F.col("labelled") > 0)
