"""Scans, catalog rows, and sinks that are written and read back."""

from pyspark.sql import functions as F

from ..functions.scalars import mean_score
from ..operators.scoring import score
from ..operators.splits import split_summary, stratified_split
from ..session import scratch_path
from ..sources import catalog, files
from ..sources.frames import contacts, read_table
from .base import CONTACTS, SCORED, SPLITS, mean_p, query

ROLES = {
    "age": "customer profile", "job": "customer segment", "contact": "order priority", "day": "order date",
    "month": "order date", "campaign": "running number of the customer's orders", "previous": "earlier orders",
    "pdays": "earlier orders", "poutcome": "earlier orders", "y": "outcome",
}
LATE = {"campaign", "y"}
TYPES = {"age": "int", "job": "string", "contact": "string", "day": "int", "month": "int", "campaign": "bigint",
         "previous": "bigint", "pdays": "int", "poutcome": "string", "y": "int"}
DICTIONARY_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, '{ROLES[c].replace("'", "''")}' AS role, '{TYPES[c]}' AS dtype, count(*) - count("{c}") AS missing,
  round(100.0 * (count(*) - count("{c}")) / count(*), 6) AS missing_pct, count(DISTINCT "{c}") AS distinct_values,
  {'FALSE' if c in LATE else 'TRUE'} AS available_at_prediction, min(CAST("{c}" AS VARCHAR)) AS example FROM frame"""
    for c in ROLES
)


@query(
    "src1_csv_source",
    CONTACTS + """SELECT contact_id, CAST(age AS BIGINT) AS age, job, balance, contact, CAST("day" AS BIGINT) AS "day",
  CAST("month" AS BIGINT) AS "month", CAST(pdays AS BIGINT) AS pdays, previous, poutcome, y,
  campaign - 1 AS prior_contacts_in_campaign FROM contacts""",
)
def csv_source(spark, sf_dir):
    path = scratch_path(spark, "contacts_csv")
    files.write_contacts_csv(contacts(spark, sf_dir), path)
    return files.read_contacts_csv(spark, path)


@query(
    "src2_snapshot_fingerprint",
    """SELECT count(*) AS "rows", CAST(sum(CAST(CAST('0x' || substr(sha256(coalesce(CAST(o_orderkey AS VARCHAR), '∅') || '␟' ||
  coalesce(CAST(o_custkey AS VARCHAR), '∅') || '␟' || coalesce(o_orderstatus, '∅') || '␟' ||
  coalesce(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), '∅') || '␟' ||
  coalesce(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '∅') || '␟' || coalesce(o_orderpriority, '∅')), 1, 13) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS fingerprint
FROM orders""",
)
def fingerprint(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return files.table_fingerprint(
        orders,
        [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), cents,
         F.col("o_orderdate").cast("date"), F.col("o_orderpriority")],
    )


@query("src2_file_digest")
def digest(spark, sf_dir):
    return files.file_digests(spark, f"{sf_dir}/orders.parquet")


ORDER_FILE_KEYS = 1 << 20  # order keys of one exported file
LINE = "concat_ws('|', o_orderkey, o_custkey, coalesce(o_orderstatus, ''), CAST(round(o_totalprice * 100) AS BIGINT), coalesce(o_orderpriority, ''))"


def tree_sql(levels: int, fan: int) -> str:
    """Levels of a hash tree above ``nodes0`` (file, chunk, chunks, digest)."""
    return ",\n".join(
        f"""nodes{i + 1} AS (SELECT file, chunk // {fan} AS chunk, (chunks + {fan - 1}) // {fan} AS chunks,
  CASE WHEN chunks = 1 THEN min(digest) ELSE sha256('node' || string_agg(digest, '' ORDER BY chunk)) END AS digest
  FROM nodes{i} GROUP BY file, chunk // {fan}, chunks)"""
        for i in range(levels)
    )


@query(
    "src2_chunked_digest",
    f"""WITH lines AS (SELECT o_orderkey // {ORDER_FILE_KEYS} AS file, o_orderkey, {LINE} || chr(10) AS line FROM orders),
whole AS (SELECT file, string_agg(line, '' ORDER BY o_orderkey) AS body FROM lines GROUP BY file),
nodes0 AS (SELECT file, unnest(range(0, (length(body) + 4095) // 4096)) AS chunk, (length(body) + 4095) // 4096 AS chunks,
  sha256(substr(body, unnest(range(0, (length(body) + 4095) // 4096)) * 4096 + 1, 4096)) AS digest FROM whole),
{tree_sql(6, 16)}
SELECT file, length(body) AS bytes, (length(body) + 4095) // 4096 AS chunks, digest AS root FROM whole JOIN nodes6 USING (file)""",
)
def chunked_digest(spark, sf_dir):
    """Orders exported as sorted text files of a million keys each, and the hash tree of each file."""
    path = scratch_path(spark, "order-files")
    lines = read_table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / ORDER_FILE_KEYS).alias("file"), "o_orderkey", F.expr(LINE).alias("line"))
    lines = lines.repartition("file").sortWithinPartitions("file", "o_orderkey")
    lines.select("file", "line").write.partitionBy("file").text(path)
    trees = files.file_digests(spark, path, chunk=4096, fan=16, tasks=8)
    return trees.select(F.regexp_extract("path", r"/file=(\d+)/", 1).cast("bigint").alias("file"), "bytes", "chunks", "root")


@query(
    "src3_asset_catalog",
    """SELECT 'contacts' AS asset_name, 'an order with its customer' AS grain, 'y' AS target,
  'when the order is placed' AS prediction_moment, 'rewritten with each load of orders' AS refresh_policy,
  'order desk' AS "owner", 'customer master data' AS steward, count(*) AS "rows", CAST(6 AS BIGINT) AS "columns" FROM orders""",
)
def asset_catalog(spark, sf_dir):
    return catalog.asset_row(
        read_table(spark, sf_dir, "orders"),
        {
            "asset_name": "contacts",
            "grain": "an order with its customer",
            "target": "y",
            "prediction_moment": "when the order is placed",
            "refresh_policy": "rewritten with each load of orders",
            "owner": "order desk",
            "steward": "customer master data",
        },
    )


@query(
    "src4_data_dictionary",
    CONTACTS + ", frame AS (SELECT * REPLACE (nullif(poutcome, 'unknown') AS poutcome, nullif(pdays, -1) AS pdays) FROM contacts)\n" + DICTIONARY_SQL,
)
def dictionary(spark, sf_dir):
    frame = contacts(spark, sf_dir).withColumns(
        {"poutcome": F.nullif(F.col("poutcome"), F.lit("unknown")), "pdays": F.nullif(F.col("pdays"), F.lit(-1))}
    )
    return catalog.data_dictionary(frame, ROLES, {c: c not in LATE for c in ROLES})


@query(
    "src5_cardinality",
    CONTACTS + """SELECT 'job' AS feature, count(DISTINCT job) AS levels FROM contacts UNION ALL
  SELECT 'contact', count(DISTINCT contact) FROM contacts UNION ALL
  SELECT 'poutcome', count(DISTINCT poutcome) FROM contacts UNION ALL SELECT 'client_id', count(DISTINCT client_id) FROM contacts""",
)
def cardinality(spark, sf_dir):
    return catalog.cardinality(contacts(spark, sf_dir), ["job", "contact", "poutcome", "client_id"])


@query(
    "src5_approximate_cardinality",
    CONTACTS + """SELECT 'job' AS feature, count(DISTINCT job) AS exact_levels, TRUE AS within_bounds FROM contacts UNION ALL
  SELECT 'poutcome', count(DISTINCT poutcome), TRUE FROM contacts UNION ALL SELECT 'balance', count(DISTINCT balance), TRUE FROM contacts UNION ALL
  SELECT 'client_id', count(DISTINCT client_id), TRUE FROM contacts UNION ALL SELECT 'contact_id', count(DISTINCT contact_id), TRUE FROM contacts""",
)
def approximate_cardinality(spark, sf_dir):
    columns = ["job", "poutcome", "balance", "client_id", "contact_id"]
    frame = contacts(spark, sf_dir).select(*columns)
    exact = catalog.cardinality(frame, columns).select("feature", F.col("levels").alias("exact_levels"))
    both = exact.join(catalog.cardinality(frame, columns, approximate=True), "feature")
    return both.select("feature", "exact_levels", F.col("exact_levels").between(F.col("low"), F.col("high")).alias("within_bounds"))


@query(
    "src6_metadata_sink",
    SPLITS + """SELECT split, count(*) AS "rows", CAST(sum(y) AS BIGINT) AS positives, round(avg(y), 6) AS positive_rate FROM splits GROUP BY split""",
)
def metadata_sink(spark, sf_dir):
    summary = split_summary(stratified_split(contacts(spark, sf_dir), "contact_id"))
    path = scratch_path(spark, "reports")
    files.write_report(summary, path)
    return files.read_report(spark, path, summary.schema)


@query(
    "src7_prediction_sink",
    SCORED + f"""SELECT 'v1' AS model_version, date_trunc('month', contact_date)::DATE AS score_date, count(*) AS predictions,
  {mean_p()} AS mean_probability, count(*) FILTER (WHERE p >= 0.14) AS prioritized FROM scored GROUP BY ALL""",
)
def prediction_sink(spark, sf_dir):
    scored = score(contacts(spark, sf_dir)).select(
        F.col("contact_id").alias("prediction_id"),
        F.col("contact_date").alias("event_time"),
        F.lit("v1").alias("model_version"),
        F.trunc("contact_date", "month").alias("score_date"),
        "p",
        (F.col("p") >= 0.14).alias("prioritize_call"),
    )
    path = scratch_path(spark, "predictions")
    files.write_predictions(scored, path)
    stored = spark.read.schema(scored.schema).parquet(path)
    return stored.groupBy("model_version", "score_date").agg(
        F.count(F.lit(1)).alias("predictions"),
        mean_score(F.col("p")).alias("mean_probability"),
        F.count_if("prioritize_call").alias("prioritized"),
    )
