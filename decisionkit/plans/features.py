"""Projections, guards and scalar features."""

from pyspark.sql import functions as F

from ..functions.scalars import clipped, log_odds, r6, ratio, right_closed_band, sigmoid
from ..operators import features as X
from ..operators.scoring import FULL, score
from ..sources.frames import contacts, read_table
from .base import CONTACTS, SCORED, query

BAND_SQL = """CASE WHEN age > 0 AND age <= 29 THEN '<30' WHEN age > 29 AND age <= 39 THEN '30s'
  WHEN age > 39 AND age <= 49 THEN '40s' WHEN age > 49 AND age <= 59 THEN '50s' WHEN age > 59 THEN '60+' END"""
ENGINEERED_SQL = f"""CAST(pdays <> -1 AS INTEGER) AS was_previously_contacted, nullif(pdays, -1) AS pdays_clean,
  round(CAST(campaign - 1 AS DOUBLE) / (1 + previous), 6) AS contact_pressure,
  round(balance / greatest(age, 18), 6) AS balance_per_age, {BAND_SQL} AS age_band"""


@query(
    "prj1_target_encode",
    "SELECT o_orderkey AS contact_id, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS target FROM orders",
)
def target_encode(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderkey").alias("contact_id"), X.encode_target("o_orderstatus", "F", "O").alias("target"))


@query(
    "prj2_precontact_projection",
    CONTACTS + """SELECT contact_id, client_id, age, job, balance, contact, "day", "month", previous, pdays, poutcome, y,
  campaign - 1 AS prior_contacts_in_campaign FROM contacts""",
)
def precontact(spark, sf_dir):
    return X.prepare_precontact(contacts(spark, sf_dir)).drop("h", "contact_date")


@query(
    "prj3_feature_target_split",
    CONTACTS + "SELECT contact_id, age, job, balance, contact, poutcome, y AS target FROM contacts",
)
def feature_target(spark, sf_dir):
    frame = contacts(spark, sf_dir).select("contact_id", "age", "job", "balance", "contact", "poutcome", "y")
    features, target = X.split_xy(frame)
    return features.join(target.withColumnRenamed("y", "target"), "contact_id")


@query(
    "prj4_feature_groups",
    CONTACTS + """, one AS (SELECT age, job, balance, contact, "day", "month", campaign, previous, pdays, poutcome, duration FROM contacts)
SELECT column_name AS feature, CASE WHEN column_type = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS kind,
  (SELECT count(*) FROM contacts) AS "rows"
FROM (SELECT unnest(['age','balance','day','month','campaign','previous','pdays','duration']) AS column_name, 'DOUBLE' AS column_type
  UNION ALL SELECT unnest(['job','contact','poutcome']), 'VARCHAR')""",
)
def groups(spark, sf_dir):
    frame = contacts(spark, sf_dir)
    numeric, categorical = X.feature_groups(frame, exclude=["contact_id", "client_id", "contact_date", "h", "y"])
    kinds = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.lit("numeric").alias("kind")) for c in numeric],
        *[F.struct(F.lit(c).alias("feature"), F.lit("categorical").alias("kind")) for c in categorical],
    )
    return frame.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(kinds))


@query(
    "prj5_sentinel_split",
    CONTACTS + "SELECT contact_id, CAST(pdays <> -1 AS INTEGER) AS was_previously_contacted, nullif(pdays, -1) AS pdays_clean FROM contacts",
)
def sentinel(spark, sf_dir):
    frame = contacts(spark, sf_dir)
    return frame.select(
        "contact_id",
        (F.col("pdays") != -1).cast("int").alias("was_previously_contacted"),
        F.nullif(F.col("pdays"), F.lit(-1)).alias("pdays_clean"),
    )


@query(
    "prj6_contact_pressure",
    CONTACTS + "SELECT contact_id, round(CAST(campaign AS DOUBLE) / (1 + previous), 6) AS contact_pressure, round(CAST(campaign - 1 AS DOUBLE) / (1 + previous), 6) AS prior_pressure FROM contacts",
)
def pressure(spark, sf_dir):
    d = 1 + F.col("previous")
    return contacts(spark, sf_dir).select(
        "contact_id",
        r6(ratio(F.col("campaign"), d)).alias("contact_pressure"),
        r6(ratio(F.col("campaign") - 1, d)).alias("prior_pressure"),
    )


@query(
    "prj7_clipped_ratio",
    CONTACTS + """SELECT contact_id, CASE WHEN age % 10 <> 0 THEN round(balance / greatest(age, 25), 6) END AS balance_per_age FROM contacts""",
)
def clipped_ratio(spark, sf_dir):
    # Ages divisible by ten are blanked: a NULL age must give NULL, not balance / 25.
    age = F.when(F.col("age") % 10 != 0, F.col("age"))
    return contacts(spark, sf_dir).select(
        "contact_id", r6(ratio(F.col("balance"), clipped(age, low=25))).alias("balance_per_age")
    )


@query("prj8_banding", CONTACTS + f"SELECT contact_id, age, {BAND_SQL} AS age_band FROM contacts")
def banding(spark, sf_dir):
    return contacts(spark, sf_dir).select("contact_id", "age", right_closed_band("age").alias("age_band"))


@query("prj9_guarded_features", CONTACTS + f"SELECT contact_id, {ENGINEERED_SQL} FROM contacts")
def guarded(spark, sf_dir):
    frame = X.guarded_domain_features(X.prepare_precontact(contacts(spark, sf_dir)))
    return frame.select(
        "contact_id", "was_previously_contacted", "pdays_clean",
        r6(F.col("contact_pressure")).alias("contact_pressure"),
        r6(F.col("balance_per_age")).alias("balance_per_age"), "age_band",
    )


@query(
    "prj10_family_drop",
    CONTACTS + f", e AS (SELECT contact_id, {ENGINEERED_SQL} FROM contacts) SELECT * EXCLUDE (was_previously_contacted, pdays_clean) FROM e",
)
def family_drop(spark, sf_dir):
    frame = X.add_domain_features(X.prepare_precontact(contacts(spark, sf_dir))).select(
        "contact_id", "was_previously_contacted", "pdays_clean",
        r6(F.col("contact_pressure")).alias("contact_pressure"),
        r6(F.col("balance_per_age")).alias("balance_per_age"), "age_band",
    )
    return X.without_family(frame, "history")


@query(
    "prj11_category_normalise",
    CONTACTS + "SELECT contact_id, coalesce(nullif(poutcome, 'unknown'), '__MISSING__') AS poutcome FROM contacts",
)
def normalise(spark, sf_dir):
    frame = contacts(spark, sf_dir).withColumn("poutcome", F.nullif(F.col("poutcome"), F.lit("unknown")))
    return frame.select("contact_id", X.normalise_category("poutcome").alias("poutcome"))


@query(
    "prj12_quantile_winsorise",
    CONTACTS + """, q AS (SELECT quantile_cont(balance, 0.01) AS lo, quantile_cont(balance, 0.99) AS hi FROM contacts)
SELECT contact_id, round(least(greatest(balance, lo), hi), 6) AS balance_winsorised FROM contacts, q""",
)
def winsorise(spark, sf_dir):
    frame = X.winsorise(contacts(spark, sf_dir), "balance")
    return frame.select("contact_id", r6(F.col("balance_winsorised")).alias("balance_winsorised"))


@query(
    "prj13_log_odds",
    SCORED + """, b AS (SELECT ln(avg(y) / (1 - avg(y))) AS f0 FROM scored)
SELECT contact_id, round(ln(p / (1 - p)), 6) AS raw_score, round(1 / (1 + exp(-ln(p / (1 - p)))), 6) AS probability,
  round(f0, 6) AS base_raw_score FROM scored, b""",
)
def odds(spark, sf_dir):
    frame = score(contacts(spark, sf_dir))
    z = log_odds(F.col("p"))
    return frame.select(
        "contact_id",
        r6(z).alias("raw_score"),
        r6(sigmoid(z)).alias("probability"),
        r6(X.base_rate_start(frame)).alias("base_raw_score"),
    )


@query("prj14_pseudo_residual", SCORED + "SELECT contact_id, round(y - p, 6) AS residual FROM scored")
def residual(spark, sf_dir):
    frame = score(contacts(spark, sf_dir))
    return frame.select("contact_id", r6(X.pseudo_residual(FULL.raw_score())).alias("residual"))


@query(
    "prj15_crossed_category",
    CONTACTS + "SELECT job || '_' || contact AS crossed, count(*) AS n, round(avg(y), 6) AS rate FROM contacts GROUP BY 1",
)
def crossed(spark, sf_dir):
    frame = contacts(spark, sf_dir).withColumn("crossed", X.crossed_category("job", "contact"))
    return frame.groupBy("crossed").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("y")).alias("rate"))
