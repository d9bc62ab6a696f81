"""Registry of queries and the equivalent SQL text used to check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` computes the same table on the same input, where SQL can."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def hash_sql(seed: int | str, *keys: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def hex_sql(seed: int | str, start: int, digits: int, *keys: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), {start}, {digits}) AS BIGINT)"


CONTACTS = f"""
WITH contacts AS (
  SELECT o_orderkey AS contact_id, o_custkey AS client_id, CAST(o_orderdate AS DATE) AS contact_date,
    CAST(18 + o_custkey % 83 AS INTEGER) AS age, c_mktsegment AS job, c_acctbal AS balance,
    o_orderpriority AS contact, CAST(day(o_orderdate) AS INTEGER) AS "day",
    CAST(month(o_orderdate) AS INTEGER) AS "month",
    row_number() OVER w AS campaign, row_number() OVER w - 1 AS previous,
    CAST(coalesce(date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER w, CAST(o_orderdate AS DATE)), -1) AS INTEGER) AS pdays,
    coalesce(lag(o_orderstatus) OVER w, 'unknown') AS poutcome,
    o_totalprice AS duration, {hash_sql(42, 'o_orderkey')} AS h,
    CAST(CASE WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS INTEGER) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey
  WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
)
"""

LEVEL_SQL = "CASE contact WHEN '1-URGENT' THEN 1.4 WHEN '2-HIGH' THEN 1.1 ELSE 0.0 END"


def _p(z: str) -> str:
    return f"round(1.0 / (1.0 + exp(-({z}))), 6)"


P_FULL = _p(f"CAST(-2.6 AS DOUBLE) + CAST({LEVEL_SQL} AS DOUBLE) + CAST(0.00004 AS DOUBLE) * balance "
            "+ CAST(0.004 AS DOUBLE) * age + CAST(-0.03 AS DOUBLE) * previous")
P_CONTACT = _p(f"CAST(-2.4 AS DOUBLE) + CAST({LEVEL_SQL} AS DOUBLE)")
P_HISTORY = _p("CAST(-2.1 AS DOUBLE) + CAST(0.00004 AS DOUBLE) * balance + CAST(0.004 AS DOUBLE) * age "
               "+ CAST(-0.03 AS DOUBLE) * previous")

SCORED = CONTACTS + f", scored AS (SELECT *, {P_FULL} AS p FROM contacts)\n"
MODELS = CONTACTS + f""", models AS (
  SELECT *, 'full' AS model, {P_FULL} AS p FROM contacts
  UNION ALL SELECT *, 'contact_only', {P_CONTACT} FROM contacts
  UNION ALL SELECT *, 'history_only', {P_HISTORY} FROM contacts)
"""

SPLIT_CASE = """CASE WHEN rn <= floor(n * 0.6) THEN 'development' WHEN rn <= floor(n * 0.8) THEN 'validation' ELSE 'test' END"""
SPLITS = SCORED + f""", ranked AS (
  SELECT *, row_number() OVER (PARTITION BY y ORDER BY h, contact_id) AS rn, count(*) OVER (PARTITION BY y) AS n FROM scored),
splits AS (SELECT * EXCLUDE (rn, n), {SPLIT_CASE} AS split FROM ranked)
"""

EPS = "2.220446e-16"
LL_SQL = f"-ln(greatest(least(CASE WHEN y = 1 THEN p ELSE 1.0 - p END, 1.0 - {EPS}), {EPS}))"


def decision_sql(fp_cost: str = "1.0", fn_cost: str = "5.0") -> str:
    """Metric columns over tn, fp, fn, tp."""
    rec = "CAST(tp AS DOUBLE) / nullif(tp + fn, 0)"
    spec = "CAST(tn AS DOUBLE) / nullif(tn + fp, 0)"
    return f"""round(CAST(tp + tn AS DOUBLE) / nullif(tp + tn + fp + fn, 0), 6) AS accuracy,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 6) AS precision,
  round(coalesce({rec}, 0.0), 6) AS recall, round({spec}, 6) AS specificity,
  round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1,
  round((coalesce({rec}, {spec}) + coalesce({spec}, {rec})) / 2, 6) AS balanced_accuracy,
  CAST(fp * {fp_cost} + fn * {fn_cost} AS DOUBLE) AS cost"""


def counts_sql(threshold: str) -> str:
    return f"""CAST(count(*) FILTER (WHERE p < {threshold} AND y = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE p >= {threshold} AND y = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE p < {threshold} AND y = 1) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE p >= {threshold} AND y = 1) AS BIGINT) AS tp"""


def ranking_sql(source: str, by: str = "", score: str = "p", label: str = "y") -> str:
    """CTEs ``auc`` and ``ap`` per group of ``source``: Mann-Whitney ranks and the step-wise sum."""
    part = f"PARTITION BY {by} " if by else ""
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""rk AS (SELECT {key}{label} AS _y, rank() OVER ({part}ORDER BY {score}) + (count(*) OVER (PARTITION BY {key}{score}) - 1) / 2.0 AS avg_rank
  FROM {source}),
auc AS (SELECT {key}round(CASE WHEN sum(_y) > 0 AND sum(1 - _y) > 0 THEN
    (sum(CASE WHEN _y = 1 THEN CAST(avg_rank AS DOUBLE) ELSE 0.0 END) - CAST(sum(_y) AS DOUBLE) * (sum(_y) + 1) / 2)
    / (CAST(sum(_y) AS DOUBLE) * sum(1 - _y)) END, 6) AS roc_auc FROM rk {group}),
cell AS (SELECT {key}{score} AS _s, sum({label}) AS pos, count(*) AS n FROM {source} GROUP BY {key}{score}),
cum AS (SELECT {key}pos, sum(pos) OVER ({part}ORDER BY _s DESC) AS tp, sum(n) OVER ({part}ORDER BY _s DESC) AS seen,
    sum(pos) OVER ({part.strip()}) AS allp FROM cell),
ap AS (SELECT {key}round(sum(CAST(pos AS DOUBLE) * CAST(tp AS DOUBLE) / CAST(seen AS DOUBLE)) / nullif(CAST(max(allp) AS DOUBLE), 0), 6) AS average_precision
  FROM cum {group})"""


SWEEP_COUNTS = f"""SELECT CAST(i AS DOUBLE) / 100.0 AS threshold, {counts_sql('(CAST(i AS DOUBLE) / 100.0)')},
  round(avg({LL_SQL}), 6) AS log_loss, round(avg((p - y) * (p - y)), 6) AS brier"""


def sweep_sql(source: str, by: str = "") -> str:
    """Threshold table by brute force: every row against every cut-off."""
    key = f"{by}, " if by else ""
    return f"""SELECT {key}threshold, tn, fp, fn, tp, log_loss, brier, {decision_sql()} FROM (
  {SWEEP_COUNTS}{', ' + by if by else ''} FROM {source}, range(5, 81) AS t(i) GROUP BY {key}i) AS c"""


def mean_p(p: str = "p") -> str:
    return f"round(CAST(sum(CAST(round({p} * 1000000.0) AS BIGINT)) AS DOUBLE) / count({p}) / 1000000.0, 9)"
