"""Neighbour joins, imbalance treatment and anomaly ranking."""

from pyspark.sql import functions as F

from ..functions.hashing import hash_order
from ..functions.scalars import r6
from ..operators import anomaly as A
from ..operators import contracts as C
from ..operators import imbalance as I
from ..operators import policy as P
from ..operators.aggregates import equal_width_histogram
from ..operators.neighbors import approximate_knn_join, knn_join, neighbour_recall, neighbour_rows
from ..session import staged
from ..sources.frames import contacts, embeddings, event_log, labelled_documents
from .base import CONTACTS, hash_sql, hex_sql, query


def distance_sql(a: str, b: str) -> str:
    return f"round(sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda t: (t[1] - t[2]) * (t[1] - t[2])))), 6)"


VEC = "WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings)"


@query(
    "jn5_nearest_neighbours",
    VEC + f""", p AS (SELECT a.vec_id, b.vec_id AS neighbour, {distance_sql('a.e', 'b.e')} AS distance FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id)
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS INTEGER) AS place, neighbour, distance FROM p
QUALIFY place <= 5""",
)
def nearest(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    return neighbour_rows(knn_join(rows, rows, 5, "vec_id", "embedding", exclude_self=True), "vec_id")


@query(
    "jn5_approximate_neighbours",
    """SELECT count(*) AS queries, 10 * count(*) AS neighbours, CAST(0 AS BIGINT) AS wrong_distances, CAST(0 AS BIGINT) AS better_than_exact, TRUE AS recall_at_least_090 FROM embeddings""",
)
def approximate(spark, sf_dir):
    """Every row's ten nearest from hash tables, held against the exact join over all rows and against distances computed anew."""
    rows = embeddings(spark, sf_dir)
    found = staged(approximate_knn_join(rows, rows, 10, "vec_id", "embedding", exclude_self=True), "approximate")
    exact = knn_join(rows, rows, 10, "vec_id", "embedding", exclude_self=True)
    pairs = neighbour_rows(found, "vec_id").join(found.select("vec_id", "vector"), "vec_id")
    other = rows.select(F.col("vec_id").alias("neighbour"), F.col("embedding").cast("array<double>").alias("other"))
    square = F.aggregate(F.zip_with("vector", "other", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, x: total + x)
    checked = pairs.join(other, "neighbour").agg(F.count(F.lit(1)).alias("neighbours"), F.count_if(F.abs(F.sqrt(square) - F.col("distance")) > 2e-6).alias("wrong_distances"))
    recall = neighbour_recall(found, exact, "vec_id")
    return recall.select(
        "queries", *[checked.select(c).scalar().alias(c) for c in ("neighbours", "wrong_distances")], "better_than_exact", (F.col("recall") >= 0.9).alias("recall_at_least_090")
    )


@query("jn5_approximate_recall")
def approximate_recall(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    found = approximate_knn_join(rows, rows, 10, "vec_id", "embedding", exclude_self=True)
    return neighbour_recall(found, knn_join(rows, rows, 10, "vec_id", "embedding", exclude_self=True), "vec_id")


NUMERIC = ["age", "balance", "previous"]
Z_SQL = CONTACTS + """, st AS (SELECT avg(age) AS am, stddev_pop(age) AS asd, avg(balance) AS bm, stddev_pop(balance) AS bsd, avg(previous) AS pm, stddev_pop(previous) AS psd FROM contacts),
z AS (SELECT contact_id, y, age, balance, previous, job, contact, [round((age - am) / asd, 9), round((balance - bm) / bsd, 9), round((previous - pm) / psd, 9)] AS v FROM contacts, st)
"""
SMALL_SQL = f""", nm AS (SELECT sum(y) AS n FROM contacts),
small AS (SELECT *, row_number() OVER (ORDER BY {hash_sql(19, 'contact_id')}, contact_id) AS base_rank FROM z WHERE y = 1),
big AS (SELECT contact_id, row_number() OVER (ORDER BY {hash_sql(17, 'contact_id')}, contact_id) AS rn FROM contacts WHERE y = 0),
slots AS (SELECT contact_id AS slot, CAST({hex_sql(23, 1, 15, 'contact_id')} % n + 1 AS BIGINT) AS base_rank FROM big, nm WHERE rn > n)
"""


def neighbours_sql(vector: str, k: int) -> str:
    return f""", pairs AS (SELECT a.contact_id, b.contact_id AS neighbour, {distance_sql(f'a.{vector}', f'b.{vector}')} AS distance FROM small AS a JOIN small AS b ON a.contact_id <> b.contact_id),
nb AS (SELECT contact_id, list(neighbour ORDER BY distance, neighbour) AS ns FROM (
  SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY distance, neighbour) <= {k}) GROUP BY contact_id),
mix AS (SELECT slot, b.contact_id AS base, ns[CAST({hex_sql(29, 1, 15, 'slot')} % len(ns) AS INTEGER) + 1] AS neighbour, {hex_sql(31, 1, 13, 'slot')} / 4503599627370496.0::DOUBLE AS u,
  b.age AS a0, b.balance AS b0, b.previous AS p0 FROM slots JOIN small AS b ON b.base_rank = slots.base_rank JOIN nb ON nb.contact_id = b.contact_id)
"""


SYNTH_SQL = """SELECT slot, base, neighbour, round(a0 + u * (o.age - a0), 6) AS age, round(b0 + u * (o.balance - b0), 6) AS balance,
  round(p0 + u * (o.previous - p0), 6) AS previous"""


def z_frame(spark, sf_dir):
    frame = contacts(spark, sf_dir).select("contact_id", "y", "job", "contact", *NUMERIC)
    frame = staged(frame)
    return staged(A.scaled_vector(frame, frame, NUMERIC), "scaled")


@query(
    "imb1_balanced_weights",
    CONTACTS + "SELECT contact_id, y, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY y)), 6) AS weight FROM contacts",
)
def weights(spark, sf_dir):
    return I.balanced_weights(contacts(spark, sf_dir).select("contact_id", "y")).withColumn("weight", r6(F.col("weight")))


@query(
    "imb2_undersample",
    CONTACTS + f", r AS (SELECT contact_id, y, row_number() OVER (PARTITION BY y ORDER BY {hash_sql(17, 'contact_id')}, contact_id) AS rn FROM contacts) SELECT contact_id, y FROM r WHERE y = 1 OR rn <= (SELECT sum(y) FROM contacts)",
)
def undersample(spark, sf_dir):
    return I.undersample(contacts(spark, sf_dir).select("contact_id", "y"), "contact_id")


@query(
    "imb3_oversample",
    Z_SQL + SMALL_SQL + """, d AS (SELECT base_rank, count(*) AS drawn FROM slots GROUP BY base_rank)
SELECT contact_id, y, 1 + coalesce(drawn, 0) AS copies FROM small LEFT JOIN d USING (base_rank) UNION ALL SELECT contact_id, y, 1 FROM contacts WHERE y = 0""",
)
def oversample(spark, sf_dir):
    return I.oversample_copies(contacts(spark, sf_dir).select("contact_id", "y"), "contact_id")


@query(
    "imb3_materialised_copies",
    Z_SQL + SMALL_SQL + """, d AS (SELECT base_rank, count(*) AS drawn FROM slots GROUP BY base_rank),
c AS (SELECT y, 1 + coalesce(drawn, 0) AS copies FROM small LEFT JOIN d USING (base_rank) UNION ALL SELECT y, 1 FROM contacts WHERE y = 0)
SELECT y, CAST(sum(copies) AS BIGINT) AS n FROM c GROUP BY y""",
)
def copies(spark, sf_dir):
    rows = I.repeat_rows(I.oversample_copies(contacts(spark, sf_dir).select("contact_id", "y"), "contact_id"))
    return rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@query("imb4_smote", Z_SQL + SMALL_SQL + neighbours_sql("v", 5) + SYNTH_SQL + " FROM mix JOIN contacts AS o ON o.contact_id = neighbour")
def smote(spark, sf_dir):
    rows = I.smote(z_frame(spark, sf_dir), "contact_id", "vector", NUMERIC, k=5)
    return rows.select("slot", "base", "neighbour", *[r6(F.col(c)).alias(c) for c in NUMERIC])


JOBS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
MIXED_SQL = ", ".join(f"CASE WHEN job = '{j}' THEN pen ELSE 0.0 END" for j in JOBS)


def mixed_frame(spark, sf_dir):
    frame = contacts(spark, sf_dir).select(
        "contact_id", "y", "job", "age", (F.col("balance") / 100.0).alias("balance"), "previous"
    )
    return staged(I.mixed_vector(frame, frame, NUMERIC, {"job": JOBS}), "mixed")


@query(
    "imb5_smotenc",
    CONTACTS + f""", s AS (SELECT list_sort([stddev_samp(age), stddev_samp(balance / 100.0::DOUBLE), stddev_samp(previous)])[2] / sqrt(2.0::DOUBLE) AS pen FROM contacts),
z AS (SELECT contact_id, y, age, balance / 100.0::DOUBLE AS balance, previous, job, [CAST(age AS DOUBLE), balance / 100.0::DOUBLE, CAST(previous AS DOUBLE), {MIXED_SQL}] AS v FROM contacts, s)"""
    + SMALL_SQL + neighbours_sql("v", 5)
    + """, votes AS (SELECT contact_id, unnest(ns) AS nid FROM nb), cnt AS (SELECT v.contact_id, o.job, count(*) AS c FROM votes AS v JOIN small AS o ON o.contact_id = nid GROUP BY 1, 2),
modes AS (SELECT contact_id, job FROM cnt QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY c DESC, job) = 1)
""" + SYNTH_SQL + ", modes.job FROM mix JOIN small AS o ON o.contact_id = neighbour JOIN modes ON modes.contact_id = base",
)
def smotenc(spark, sf_dir):
    rows = I.smote(mixed_frame(spark, sf_dir), "contact_id", "vector", NUMERIC, ["job"], k=5)
    return rows.select("slot", "base", "neighbour", *[r6(F.col(c)).alias(c) for c in NUMERIC], "job")


@query(
    "imb7_synthetic_audit",
    Z_SQL + SMALL_SQL + neighbours_sql("v", 5) + ", syn AS (" + SYNTH_SQL + """ FROM mix JOIN contacts AS o ON o.contact_id = neighbour)
SELECT 'age is whole' AS "check", count(*) FILTER (WHERE age <> floor(age)) AS violations, count(*) FILTER (WHERE age <> floor(age)) = 0 AS passed FROM syn UNION ALL
SELECT 'previous is whole', count(*) FILTER (WHERE previous <> floor(previous)), count(*) FILTER (WHERE previous <> floor(previous)) = 0 FROM syn UNION ALL
SELECT 'age within 18..100', count(*) FILTER (WHERE age NOT BETWEEN 18 AND 100), count(*) FILTER (WHERE age NOT BETWEEN 18 AND 100) = 0 FROM syn""",
)
def audit(spark, sf_dir):
    rows = I.smote(z_frame(spark, sf_dir), "contact_id", "vector", NUMERIC, k=5)
    rows = rows.select(*[r6(F.col(c)).alias(c) for c in NUMERIC])
    return C.quality_report(
        rows,
        [
            C.Rule("age is whole", F.col("age") != F.floor("age")),
            C.Rule("previous is whole", F.col("previous") != F.floor("previous")),
            C.Rule("age within 18..100", C.out_of_range("age", 18, 100)),
        ],
    )


DETECT = ["length", "lines", "digits"]
#: Documents with labels: poor quality is what the detectors are judged by; they are fitted on a hash part of the rows.
DOCS_SQL = f"""WITH d AS (SELECT doc_id, CAST(quality = 0 AS INTEGER) AS poor, CAST(length(text) AS DOUBLE) AS c1, CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS c2,
  CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) AS c3, {hash_sql(42, 'doc_id')} % 10 < 6 AS train FROM documents JOIN labels USING (doc_id)),
dev AS (SELECT avg(c1) AS m1, stddev_pop(c1) AS s1, avg(c2) AS m2, stddev_pop(c2) AS s2, avg(c3) AS m3, stddev_pop(c3) AS s3 FROM d WHERE train),
zs AS (SELECT doc_id, poor, train, round((c1 - m1) / s1, 9) AS z1, round((c2 - m2) / s2, 9) AS z2, round((c3 - m3) / s3, 9) AS z3 FROM d, dev),
sc AS (SELECT doc_id, poor, round(1.0 - 1.0 / (1.0 + sqrt(z1 * z1 + z2 * z2 + z3 * z3)), 6) AS score FROM zs WHERE NOT train)
"""


def detection_frames(spark, sf_dir):
    size = lambda c: F.length(c).cast("double")
    rows = labelled_documents(spark, sf_dir).select(
        "doc_id",
        (F.col("quality") == 0).cast("int").alias("poor"),
        size(F.col("text")).alias("length"),
        (size(F.col("text")) - size(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("lines"),
        size(F.regexp_replace("text", "[^0-9]", "")).alias("digits"),
        (hash_order(42, "doc_id") % 10 < 6).alias("train"),
    )
    rows = staged(rows, "documents")
    train = rows.filter("train")
    return A.scaled_vector(train, train, DETECT), A.scaled_vector(rows.filter("not train"), train, DETECT)


def distance_scores(spark, sf_dir):
    """A transparent detector: distance from the centre of the training rows, squeezed into [0, 1)."""
    _, new = detection_frames(spark, sf_dir)
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return new.select("doc_id", "poor", F.round(1.0 - 1.0 / (1.0 + F.sqrt(squares)), 6).alias("score"))


@query("ano1_isolation_forest")
def isolation_forest(spark, sf_dir):
    train, new = detection_frames(spark, sf_dir)
    nodes = A.fit_isolation_forest(train, 100, "doc_id")
    scores = A.score_isolation_forest(new, nodes, "doc_id")
    return scores.join(new.select("doc_id", "poor"), "doc_id")


@query(
    "ano1_isolation_forest_facts",
    DOCS_SQL + """SELECT count(*) AS "rows", count(DISTINCT doc_id) AS keys, CAST(0 AS BIGINT) AS outside, TRUE AS far_rows_stand_out FROM zs WHERE NOT train""",
)
def isolation_forest_facts(spark, sf_dir):
    """Each new row is scored once, within the score's bounds, and rows far from the centre score higher."""
    scored = staged(isolation_forest(spark, sf_dir), "isolation")
    far = distance_scores(spark, sf_dir).select("doc_id", F.col("score").alias("far"))
    s = F.col("score")
    return scored.join(far, "doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("keys"), F.count_if(s.isNull() | (s < -0.5) | (s > 0.5)).alias("outside"),
        (F.corr("score", "far") > 0.5).alias("far_rows_stand_out"),
    )


LOF_K = 10


@query(
    "ano2_local_outlier_factor",
    VEC + f""", ref AS (SELECT * FROM v WHERE {hash_sql(42, 'vec_id')} % 10 < 7), new AS (SELECT * FROM v WHERE {hash_sql(42, 'vec_id')} % 10 >= 7),
rr AS (SELECT a.vec_id, b.vec_id AS nb, {distance_sql('a.e', 'b.e')} AS d FROM ref AS a JOIN ref AS b ON a.vec_id <> b.vec_id QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY d, b.vec_id) <= {LOF_K}),
kd AS (SELECT vec_id, max(d) AS kd FROM rr GROUP BY vec_id),
lr AS (SELECT rr.vec_id, 1.0 / (avg(greatest(d, kd)) + 1e-10) AS lrd FROM rr JOIN kd ON kd.vec_id = nb GROUP BY rr.vec_id),
nr AS (SELECT a.vec_id, b.vec_id AS nb, {distance_sql('a.e', 'b.e')} AS d FROM new AS a, ref AS b QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY d, b.vec_id) <= {LOF_K}),
ln AS (SELECT nr.vec_id, 1.0 / (avg(greatest(d, kd)) + 1e-10) AS lrd FROM nr JOIN kd ON kd.vec_id = nb GROUP BY nr.vec_id)
SELECT nr.vec_id, round(avg(lr.lrd) / max(ln.lrd), 6) AS score FROM nr JOIN lr ON lr.vec_id = nb JOIN ln ON ln.vec_id = nr.vec_id GROUP BY nr.vec_id""",
)
def lof(spark, sf_dir):
    rows = embeddings(spark, sf_dir).withColumn("_side", hash_order(42, "vec_id") % 10)
    return A.local_outlier_factor(rows.filter("_side < 7"), rows.filter("_side >= 7"), LOF_K, "vec_id", "embedding")


DENSITY_K = 35


@query(
    "ano2_document_density",
    DOCS_SQL + f""", v AS (SELECT doc_id, poor, train, [z1, z2, z3] AS e FROM zs),
rr AS (SELECT a.doc_id, b.doc_id AS nb, {distance_sql('a.e', 'b.e')} AS d FROM v AS a JOIN v AS b ON a.doc_id <> b.doc_id AND a.train AND b.train QUALIFY row_number() OVER (PARTITION BY a.doc_id ORDER BY d, b.doc_id) <= {DENSITY_K}),
kd AS (SELECT doc_id, max(d) AS kd FROM rr GROUP BY doc_id),
lr AS (SELECT rr.doc_id, 1.0 / (avg(greatest(d, kd)) + 1e-10) AS lrd FROM rr JOIN kd ON kd.doc_id = nb GROUP BY rr.doc_id),
nr AS (SELECT a.doc_id, b.doc_id AS nb, {distance_sql('a.e', 'b.e')} AS d FROM v AS a JOIN v AS b ON NOT a.train AND b.train QUALIFY row_number() OVER (PARTITION BY a.doc_id ORDER BY d, b.doc_id) <= {DENSITY_K}),
ln AS (SELECT nr.doc_id, 1.0 / (avg(greatest(d, kd)) + 1e-10) AS lrd FROM nr JOIN kd ON kd.doc_id = nb GROUP BY nr.doc_id),
f AS (SELECT nr.doc_id, round(avg(lr.lrd) / max(ln.lrd), 6) AS score FROM nr JOIN lr ON lr.doc_id = nb JOIN ln ON ln.doc_id = nr.doc_id GROUP BY nr.doc_id)
SELECT f.doc_id, score, poor FROM f JOIN v ON v.doc_id = f.doc_id""",
)
def document_density(spark, sf_dir):
    train, new = detection_frames(spark, sf_dir)
    scores = A.local_outlier_factor(train, new, DENSITY_K, "doc_id")
    return scores.join(new.select("doc_id", "poor"), "doc_id")


@query(
    "ano3_alert_budget",
    DOCS_SQL + """, k AS (SELECT sum(poor) AS k FROM sc), f AS (SELECT sc.*, row_number() OVER (ORDER BY score DESC, doc_id) <= k AS taken FROM sc, k),
c AS (SELECT count(*) FILTER (WHERE taken) AS k, count(*) FILTER (WHERE taken AND poor = 1) AS hits, sum(poor) AS pos, count(*) AS n FROM f)
SELECT k, hits, round(hits / CAST(k AS DOUBLE), 6) AS precision_at_k, round(hits / CAST(pos AS DOUBLE), 6) AS recall_at_k, round((hits / CAST(k AS DOUBLE)) / (pos / CAST(n AS DOUBLE)), 6) AS lift_at_k FROM c""",
)
def alert_budget(spark, sf_dir):
    rows = distance_scores(spark, sf_dir)
    k = rows.agg(F.sum("poor")).scalar()
    return P.top_k_metrics(P.top_k_flags(rows, k, "doc_id", "poor", "score"), "poor")


@query(
    "ano4_score_distribution",
    DOCS_SQL + """, lim AS (SELECT min(score) AS lo, (max(score) - min(score)) / 40.0::DOUBLE AS w FROM sc),
b AS (SELECT poor, CAST(least(floor((score - lo) / w), 39) AS INTEGER) AS bin, w FROM sc, lim)
SELECT poor, bin, count(*) AS n, round(count(*) / (CAST(sum(count(*)) OVER (PARTITION BY poor) AS DOUBLE) * max(w)), 6) AS density FROM b GROUP BY poor, bin""",
)
def distribution(spark, sf_dir):
    return equal_width_histogram(distance_scores(spark, sf_dir), ["poor"], "score", 40)


@query(
    "ano5_alert_volume",
    """SELECT CAST(ts AS DATE) AS "window", count(*) AS volume, count(*) FILTER (WHERE value > 20) AS alerts, round(count(*) FILTER (WHERE value > 20) / CAST(count(*) AS DOUBLE), 6) AS alert_rate,
  round(count(*) FILTER (WHERE value > 20 AND event_type = 'error') / CAST(nullif(count(*) FILTER (WHERE value > 20), 0) AS DOUBLE), 6) AS actionable_share FROM events GROUP BY 1""",
)
def volume(spark, sf_dir):
    return A.alert_volume(event_log(spark, sf_dir), F.col("day"), F.col("value") > 20, F.col("event_type") == "error")
