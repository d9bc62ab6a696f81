"""The analysis frames: one row per decision, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_order
from ..operators.ordered import HOT_ROWS, ordered_state

SEED = 42
NUMERIC = ["age", "balance", "campaign", "previous", "pdays"]
CATEGORICAL = ["job", "contact", "poutcome"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_number(day: str | Column) -> Column:
    """Days since 1900, so that the bucket is non-negative for any business date."""
    return F.datediff(F.col(day) if isinstance(day, str) else day, F.lit("1900-01-01").cast("date"))


def contacts(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Marketing-contact frame: each order is one contact with the client's history before it."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("contact_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderdate").cast("date").alias("contact_date"),
        F.col("o_orderpriority").alias("contact"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("duration"),
    )
    history = ordered_state(
        orders,
        by=["client_id"],
        order=["contact_date", "contact_id"],
        bucket=day_number("contact_date"),
        rank="campaign",
        lasts={"last_contact": F.struct("contact_date", "status")},
        hot_rows=hot_rows,
    )
    customer = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("client_id"),
        F.col("c_mktsegment").alias("job"),
        F.col("c_acctbal").alias("balance"),
    )
    last = F.col("last_contact")
    positive = (F.col("status") == "F") & F.col("contact").isin("1-URGENT", "2-HIGH")
    return history.join(customer, "client_id").select(
        "contact_id",
        "client_id",
        "contact_date",
        (18 + F.col("client_id") % 83).cast("int").alias("age"),
        "job",
        "balance",
        "contact",
        F.dayofmonth("contact_date").alias("day"),
        F.month("contact_date").alias("month"),
        "campaign",
        (F.col("campaign") - 1).alias("previous"),
        F.coalesce(F.datediff("contact_date", last["contact_date"]), F.lit(-1)).alias("pdays"),
        F.coalesce(last["status"], F.lit("unknown")).alias("poutcome"),
        "duration",
        hash_order(SEED, "contact_id").alias("h"),
        F.when(positive, 1).otherwise(0).alias("y"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their day and the integer inside the JSON properties."""
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("ts").cast("date").alias("day"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").join(read_table(spark, sf_dir, "labels"), "doc_id")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings")


def lineitem_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large bench frame. Order keys repeat in the data, so the order is a hash of the whole row."""
    raw = read_table(spark, sf_dir, "lineitem")
    row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\u2205")) for c in raw.columns]))
    return raw.select(
        F.conv(F.substring(row, 1, 8), 16, 10).cast("bigint").alias("h"),
        row.alias("row_hash"),
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        "l_linestatus",
        F.month("l_shipdate").alias("ship_month"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.07), 1).otherwise(0).alias("y"),
    )
