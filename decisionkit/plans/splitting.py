"""Splits, folds and samples."""

from pyspark.sql import functions as F

from ..operators import splits as S
from ..operators.aggregates import key_difference
from ..sources.frames import contacts, event_log, lineitem_frame
from .base import CONTACTS, SCORED, SPLITS, hash_sql, query

ENTITY_SIDE = f"CASE WHEN {hash_sql(42, 'client_id')} / 4294967296.0 < 0.7 THEN 'development' ELSE 'validation' END"
FOLDS = SCORED + ", folds AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY h, contact_id) - 1) % 5 AS INTEGER) AS fold FROM scored)\n"


def sample_sql(n):
    return CONTACTS + f""", sz AS (SELECT y, count(*) AS size FROM contacts GROUP BY y),
tot AS (SELECT sum(size) AS total FROM sz),
q AS (SELECT y, size, total, CAST(round(size * CAST({n} AS DOUBLE) / total) AS BIGINT) AS quota, row_number() OVER (ORDER BY size DESC, y) AS place FROM sz, tot),
f AS (SELECT y, CASE WHEN total <= {n} THEN size ELSE least(size, quota + CASE WHEN place = 1 THEN {n} - (SELECT sum(quota) FROM q) ELSE 0 END) END AS quota FROM q),
r AS (SELECT contact_id, y, row_number() OVER (PARTITION BY y ORDER BY h, contact_id) AS rn FROM contacts)
SELECT contact_id, r.y FROM r JOIN f ON r.y = f.y WHERE rn <= quota"""


@query("spl1_stratified_split", SPLITS + "SELECT contact_id, y, split FROM splits")
def split(spark, sf_dir):
    return S.stratified_split(contacts(spark, sf_dir), "contact_id").select("contact_id", "y", "split")


@query("spl2_stratified_sample", sample_sql(12000))
def sample(spark, sf_dir):
    return S.stratified_sample(contacts(spark, sf_dir), "contact_id", 12000).select("contact_id", "y")


@query("spl3_stratified_folds", FOLDS + "SELECT contact_id, y, fold FROM folds")
def folds(spark, sf_dir):
    return S.stratified_folds(contacts(spark, sf_dir), "contact_id", 5).select("contact_id", "y", "fold")


@query(
    "spl4_inner_holdout",
    SPLITS + f""", d AS (SELECT contact_id, y, row_number() OVER (PARTITION BY y ORDER BY {hash_sql(43, 'contact_id')}, contact_id) AS rn,
  count(*) OVER (PARTITION BY y) AS n FROM splits WHERE split = 'development')
SELECT contact_id, y, rn > floor(n * 0.8) AS is_stop FROM d""",
)
def holdout(spark, sf_dir):
    dev = S.stratified_split(contacts(spark, sf_dir), "contact_id").filter("split = 'development'").drop("split")
    inner = S.stratified_split(dev, "contact_id", shares=(0.8,), names=("fit", "stop"), seed=43)
    return inner.select("contact_id", "y", (F.col("split") == "stop").alias("is_stop"))


@query("spl5_entity_split", CONTACTS + f"SELECT contact_id, client_id, {ENTITY_SIDE} AS split FROM contacts")
def entity(spark, sf_dir):
    return S.entity_split(contacts(spark, sf_dir), "client_id", 0.7).select("contact_id", "client_id", "split")


@query(
    "spl6_temporal_split",
    CONTACTS + "SELECT contact_id, contact_date, CASE WHEN contact_date < DATE '1999-01-01' THEN 'development' ELSE 'validation' END AS split FROM contacts",
)
def temporal(spark, sf_dir):
    return S.temporal_split(contacts(spark, sf_dir), "contact_date", "1999-01-01").select("contact_id", "contact_date", "split")


@query(
    "spl6_rolling_origins",
    """WITH o AS (SELECT unnest([DATE '2024-01-11', DATE '2024-01-16', DATE '2024-01-21']) AS origin),
r AS (SELECT origin, CASE WHEN CAST(ts AS DATE) < origin THEN 'train' WHEN CAST(ts AS DATE) < origin + 5 THEN 'validate' END AS part, value FROM events, o)
SELECT origin, part, count(*) AS "rows", round(avg(value), 6) AS mean_value FROM r WHERE part IS NOT NULL GROUP BY 1, 2""",
)
def rolling(spark, sf_dir):
    rows = S.rolling_origins(event_log(spark, sf_dir), "day", ["2024-01-11", "2024-01-16", "2024-01-21"], 5)
    return rows.groupBy("origin", "part").agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("value"), 6).alias("mean_value"))


@query(
    "spl7_entity_time_split",
    CONTACTS + f""", s AS (SELECT contact_id, {ENTITY_SIDE} AS e, CASE WHEN contact_date < DATE '1999-01-01' THEN 'development' ELSE 'validation' END AS t FROM contacts)
SELECT contact_id, e AS split FROM s WHERE e = t""",
)
def entity_time(spark, sf_dir):
    frame = contacts(spark, sf_dir)
    return S.entity_time_split(frame, "client_id", "contact_date", "1999-01-01", 0.7).select("contact_id", "split")


@query(
    "spl8_split_summary",
    SPLITS + 'SELECT split, count(*) AS "rows", CAST(sum(y) AS BIGINT) AS positives, round(avg(y), 6) AS positive_rate FROM splits GROUP BY split',
)
def summary(spark, sf_dir):
    return S.split_summary(S.stratified_split(contacts(spark, sf_dir), "contact_id"))


@query(
    "spl8_entity_overlap",
    SPLITS + """, e AS (SELECT client_id, count(DISTINCT split) AS sides, count(*) AS n FROM splits GROUP BY client_id)
SELECT count(*) AS entities, count(*) FILTER (WHERE sides > 1) AS shared_entities,
  CAST(coalesce(sum(n) FILTER (WHERE sides > 1), 0) AS BIGINT) AS rows_of_shared_entities FROM e""",
)
def overlap(spark, sf_dir):
    return S.entity_overlap(S.stratified_split(contacts(spark, sf_dir), "contact_id"), "client_id")


@query(
    "spl8_disjoint_and_complete",
    SPLITS + """SELECT (SELECT count(*) FROM (SELECT contact_id FROM splits GROUP BY contact_id HAVING count(DISTINCT split) > 1)) AS in_two_splits,
  (SELECT count(*) FROM contacts WHERE contact_id NOT IN (SELECT contact_id FROM splits)) AS in_no_split""",
)
def disjoint(spark, sf_dir):
    frame = contacts(spark, sf_dir)
    split_rows = S.stratified_split(frame, "contact_id")
    twice = split_rows.groupBy("contact_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lost = key_difference(frame, split_rows, ["contact_id"])
    return twice.agg(F.count(F.lit(1)).alias("in_two_splits")).withColumn(
        "in_no_split", lost.agg(F.count(F.lit(1))).scalar()
    )


@query(
    "spl9_simple_sample",
    CONTACTS + f"SELECT contact_id, y FROM contacts ORDER BY {hash_sql(9, 'contact_id')}, contact_id LIMIT 2000",
)
def simple_sample(spark, sf_dir):
    frame = contacts(spark, sf_dir).select("contact_id", "y")
    ranked = S.stratum_rank(frame, "contact_id", None, seed=9)
    return ranked.filter("rn <= 2000").select("contact_id", "y")


@query(
    "spl10_repeated_folds",
    CONTACTS + f""", x AS (SELECT contact_id, y, CAST(r AS INTEGER) AS repeat, {hash_sql(7, 'r', 'contact_id')} AS hr FROM contacts, range(3) AS t(r))
SELECT contact_id, repeat, CAST((row_number() OVER (PARTITION BY repeat, y ORDER BY hr, contact_id) - 1) % 3 AS INTEGER) AS fold FROM x""",
)
def repeated(spark, sf_dir):
    frame = contacts(spark, sf_dir).select("contact_id", "y")
    return S.repeated_folds(frame, "contact_id", 3, 3).select("contact_id", "repeat", "fold")


@query(
    "spl11_nested_folds",
    CONTACTS + f""", o AS (SELECT contact_id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY h, contact_id) - 1) % 3 AS INTEGER) AS own FROM contacts),
x AS (SELECT contact_id, y, CAST(k AS INTEGER) AS outer_fold, {hash_sql(11, 'k', 'contact_id')} AS hr FROM o, range(3) AS t(k) WHERE k <> own)
SELECT contact_id, outer_fold, CAST((row_number() OVER (PARTITION BY outer_fold, y ORDER BY hr, contact_id) - 1) % 3 AS INTEGER) AS inner_fold FROM x""",
)
def nested(spark, sf_dir):
    frame = contacts(spark, sf_dir).select("contact_id", "y")
    return S.nested_folds(frame, "contact_id", 3, 3).select("contact_id", "outer_fold", "inner_fold")


@query(
    "spl1_large_frame",
    """WITH l AS (SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS k,
  CASE WHEN l_returnflag = 'R' AND l_discount >= 0.07 THEN 1 ELSE 0 END AS y FROM lineitem)
SELECT CAST(y AS INTEGER) AS y, CAST(floor(count(*) * 0.6) AS BIGINT) AS development, CAST(floor(count(*) * 0.8) - floor(count(*) * 0.6) AS BIGINT) AS validation,
  CAST(count(*) - floor(count(*) * 0.8) AS BIGINT) AS test FROM l GROUP BY y""",
)
def large_split(spark, sf_dir):
    # Class sizes per split of the bench frame; equal rows are interchangeable, so only counts are fixed.
    rows = S.stratified_split(lineitem_frame(spark, sf_dir), "row_hash", order=F.col("h"))
    return rows.groupBy("y").agg(*[F.count_if(F.col("split") == s).alias(s) for s in S.SPLIT_NAMES])


