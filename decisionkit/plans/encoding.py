"""Fold-safe encoders over whole frames."""

from pyspark.sql import functions as F

from ..functions.scalars import r6
from ..operators import encoders as E
from ..operators.splits import stratified_folds, stratified_split
from ..session import staged
from ..sources.frames import contacts, embeddings, labelled_documents, lineitem_frame, read_table
from .base import CONTACTS, SPLITS, hash_sql, query

K = 5
FOLDS = CONTACTS + """, folds AS (SELECT * REPLACE (nullif(pdays, -1) AS pdays, nullif(poutcome, 'unknown') AS poutcome),
  CAST((row_number() OVER (PARTITION BY y ORDER BY h, contact_id) - 1) % 5 AS INTEGER) AS fold FROM contacts),
held AS (SELECT CAST(k AS INTEGER) AS held, f.* FROM folds AS f, range(5) AS t(k) WHERE k <> f.fold)
"""
DOCS = f"""WITH docs AS (SELECT doc_id, source, toxic, n_chars, CAST((row_number() OVER (PARTITION BY toxic ORDER BY {hash_sql(42, 'doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold
  FROM documents JOIN labels USING (doc_id)),
lv AS (SELECT CAST(k AS INTEGER) AS held, source, count(*) AS n FROM docs, range(5) AS t(k) WHERE k <> fold GROUP BY 1, 2)
"""


def folded(spark, sf_dir, column):
    """(contact_id, y, column, fold); the contacts are written once, since the folds pass over them several times."""
    frame = contacts(spark, sf_dir).withColumns(
        {"poutcome": F.nullif(F.col("poutcome"), F.lit("unknown")), "pdays": F.nullif(F.col("pdays"), F.lit(-1))}
    )
    return stratified_folds(staged(frame.select("contact_id", "y", column), "contacts"), "contact_id", K)


def folded_documents(spark, sf_dir):
    docs = labelled_documents(spark, sf_dir).select("doc_id", "source", "toxic", "n_chars")
    return stratified_folds(docs, "doc_id", K, label="toxic")


@query(
    "enc1_median_impute",
    FOLDS + """, s AS (SELECT held, quantile_cont(CAST(pdays AS DOUBLE), 0.5) AS med FROM held GROUP BY held)
SELECT contact_id, fold, round(coalesce(CAST(pdays AS DOUBLE), med), 6) AS pdays FROM folds JOIN s ON held = fold""",
)
def median(spark, sf_dir):
    rows = E.impute_median(folded(spark, sf_dir, "pdays").select("contact_id", "fold", "pdays"), "pdays", K)
    return rows.select("contact_id", "fold", r6(F.col("pdays")).alias("pdays"))


@query(
    "enc2_mode_impute",
    FOLDS + """, c AS (SELECT held, poutcome, count(*) AS n FROM held WHERE poutcome IS NOT NULL GROUP BY 1, 2),
s AS (SELECT held, poutcome AS mode FROM c QUALIFY row_number() OVER (PARTITION BY held ORDER BY n DESC, poutcome) = 1)
SELECT contact_id, fold, coalesce(poutcome, mode) AS poutcome FROM folds JOIN s ON held = fold""",
)
def mode(spark, sf_dir):
    return E.impute_mode(folded(spark, sf_dir, "poutcome").select("contact_id", "fold", "poutcome"), "poutcome", K)


@query(
    "enc3_standardise",
    FOLDS + """, s AS (SELECT held, avg(balance) AS m, CASE WHEN stddev_pop(balance) = 0 THEN 1.0 ELSE stddev_pop(balance) END AS sd FROM held GROUP BY held)
SELECT contact_id, fold, round((balance - m) / sd, 6) AS balance FROM folds JOIN s ON held = fold""",
)
def standardise(spark, sf_dir):
    rows = E.standardise(folded(spark, sf_dir, "balance").select("contact_id", "fold", "balance"), "balance", K)
    return rows.withColumn("balance", r6(F.col("balance")))


@query(
    "enc4_one_hot_rare_bucket",
    DOCS + """, e AS (SELECT held, source, CASE WHEN n < 18 THEN '__infrequent__' ELSE source END AS encoded FROM lv),
b AS (SELECT held, bool_or(encoded = '__infrequent__') AS bucket FROM e GROUP BY held)
SELECT doc_id, fold, coalesce(encoded, CASE WHEN bucket THEN '__infrequent__' END) AS encoded
FROM docs AS d LEFT JOIN e ON e.held = fold AND e.source = d.source LEFT JOIN b ON b.held = fold""",
)
def rare_one_hot(spark, sf_dir):
    return E.one_hot(folded_documents(spark, sf_dir), "source", K, 18).select("doc_id", "fold", "encoded")


@query(
    "enc5_one_hot_ignore",
    DOCS + "SELECT doc_id, fold, lv.source AS encoded FROM docs AS d LEFT JOIN lv ON lv.held = fold AND lv.source = d.source",
)
def plain_one_hot(spark, sf_dir):
    return E.one_hot(folded_documents(spark, sf_dir), "source", K).select("doc_id", "fold", "encoded")


@query(
    "enc6_ordered_target_statistic",
    CONTACTS + """SELECT contact_id, row_number() OVER w - 1 AS earlier_rows,
  round((coalesce(sum(y) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1.0) / (row_number() OVER w - 1 + 2.0), 6) AS ordered_stat
FROM contacts WINDOW w AS (PARTITION BY job ORDER BY h, contact_id)""",
)
def ordered(spark, sf_dir):
    frame = contacts(spark, sf_dir).select("contact_id", "job", "h", "y")
    rows = E.ordered_target_statistic(frame, "job", "y", ["h", "contact_id"])
    return rows.select("contact_id", "earlier_rows", r6(F.col("ordered_stat")).alias("ordered_stat"))


@query(
    "enc6_large_frame",
    """WITH l AS (SELECT CAST(month(l_shipdate) AS INTEGER) AS ship_month, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1)
SELECT ship_month, n, n - 1 AS longest_history, CAST(n * (n - 1) / 2 AS BIGINT) AS history_rows FROM l""",
)
def ordered_large(spark, sf_dir):
    # Only sums that do not depend on the order of equal rows are compared.
    rows = E.ordered_target_statistic(lineitem_frame(spark, sf_dir), "ship_month", "y", ["h", "row_hash"])
    return rows.groupBy("ship_month").agg(
        F.count("ordered_stat").alias("n"),
        F.max("earlier_rows").alias("longest_history"),
        F.sum("earlier_rows").alias("history_rows"),
    )


@query(
    "enc7_smoothed_target_statistic",
    SPLITS + """, s AS (SELECT job, (sum(y) + 1.0) / (count(*) + 2.0) AS stat FROM splits WHERE split = 'development' GROUP BY job)
SELECT contact_id, round(coalesce(stat, 0.5), 6) AS target_stat FROM splits AS v LEFT JOIN s ON s.job = v.job WHERE split = 'validation'""",
)
def smoothed(spark, sf_dir):
    rows = stratified_split(contacts(spark, sf_dir), "contact_id").select("contact_id", "job", "y", "split")
    state = E.fit_target_statistic(rows.filter("split = 'development'"), "job", "y")
    out = E.apply_target_statistic(rows.filter("split = 'validation'"), state, "job")
    return out.select("contact_id", r6(F.col("target_stat")).alias("target_stat"))


@query(
    "enc8_out_of_fold_target",
    DOCS + """, s AS (SELECT CAST(k AS INTEGER) AS held, source, avg(toxic) AS m FROM docs, range(5) AS t(k) WHERE k <> fold GROUP BY 1, 2)
SELECT doc_id, fold, round(m, 6) AS oof_mean FROM docs AS d LEFT JOIN s ON s.held = d.fold AND s.source = d.source""",
)
def out_of_fold(spark, sf_dir):
    rows = E.out_of_fold_target(folded_documents(spark, sf_dir), "source", "toxic", K)
    return rows.select("doc_id", "fold", r6(F.col("oof_mean")).alias("oof_mean"))


@query(
    "enc9_ordinal",
    """WITH v AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1))
SELECT doc_id, coalesce(code, -1) AS code FROM documents LEFT JOIN v USING (source)""",
)
def ordinal(spark, sf_dir):
    state = E.fit_ordinal(labelled_documents(spark, sf_dir).filter("toxic = 1"), "source")
    return E.apply_ordinal(read_table(spark, sf_dir, "documents").select("doc_id", "source"), state, "source").select("doc_id", "code")


@query(
    "enc10_feature_names",
    CONTACTS + """, c AS (SELECT 'job' AS source, job AS level, count(*) AS n FROM contacts GROUP BY 1, 2 UNION ALL
  SELECT 'poutcome', poutcome, count(*) FROM contacts GROUP BY 1, 2),
e AS (SELECT DISTINCT source, CASE WHEN n < 2000 THEN '__infrequent__' ELSE level END AS level FROM c),
a AS (SELECT source, level, 'categorical__' || source || '_' || level AS feature FROM e UNION ALL
  SELECT unnest(['age', 'balance']), NULL, unnest(['numeric__age', 'numeric__balance']))
SELECT source, level, feature, row_number() OVER (ORDER BY level IS NULL DESC, source, level) - 1 AS position FROM a""",
)
def names(spark, sf_dir):
    return E.encoded_names(contacts(spark, sf_dir), ["age", "balance"], ["job", "poutcome"], 2000)


@query(
    "enc11_missing_indicator",
    CONTACTS + "SELECT contact_id, nullif(pdays, -1) AS pdays, CAST(pdays = -1 AS INTEGER) AS pdays_missing FROM contacts",
)
def indicator(spark, sf_dir):
    frame = contacts(spark, sf_dir).withColumn("pdays", F.nullif(F.col("pdays"), F.lit(-1)))
    return E.missing_indicator(frame, "pdays").select("contact_id", "pdays", "pdays_missing")


@query(
    "enc12_text_tfidf",
    r"""WITH t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term <> '' GROUP BY 1, 2),
v AS (SELECT term, count(*) AS df FROM c GROUP BY term ORDER BY df DESC, term LIMIT 300)
SELECT doc_id, term, tf, round(tf * (ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) + 1.0), 6) AS tfidf FROM c JOIN v USING (term)""",
)
def tfidf(spark, sf_dir):
    rows = E.tf_idf(read_table(spark, sf_dir, "documents"), "doc_id", "text", 300)
    return rows.withColumn("tfidf", r6(F.col("tfidf")))


@query(
    "enc13_embedding_features",
    """WITH e AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x, label FROM embeddings),
c AS (SELECT i, avg(x) AS m FROM e GROUP BY i)
SELECT vec_id, round(sqrt(sum(x * x)), 6) AS norm, round(sum(x * m), 6) AS centroid_dot FROM e JOIN c USING (i) GROUP BY vec_id""",
)
def embedding_features(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    return rows.withColumn("center", E.centroid(rows, "embedding", 64)).select(
        "vec_id",
        r6(E.vector_norm("embedding")).alias("norm"),
        r6(E.vector_dot(F.col("embedding"), F.col("center"))).alias("centroid_dot"),
    )
