"""The queries of this subpackage and the SQL that checks those which SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, exact, licenses, near, packing, pii, secrets, toxicity, tries, warc, webtext, whitening
from .common import read

QUERIES, ORACLES = {}, {}
VOCABULARIES = {"word": "word_bpe_49k.json", "byte": "byte_bpe_50k.json"}


def vocabulary(kind: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARIES[kind])


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op1_exact_dedup",
    r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(read(spark, sf_dir, "documents"))


@query("op8_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near.near_duplicates(read(spark, sf_dir, "documents"), width=4, share=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents"))


@query("op3_pack")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"), vocabulary("word"))


@query("op4_personal_data")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@query("op9_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), vocabulary("byte"))


@query("op5_nearest_vectors")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query(
    "op7_warc_revisits",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
r AS (SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes, sha1(t) AS payload_digest,
  max(page_id) OVER (PARTITION BY t) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to
FROM r""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read(spark, sf_dir, "pages"))


@query("op10_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.main_text(read(spark, sf_dir, "pages"))


@query("op11_secret_scan")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(read(spark, sf_dir, "documents"))


@query(
    "op12_prefix_trie",
    """
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations WHERE conv_id IS NOT NULL),
-- crc32 of the id by the bitwise rule: DuckDB has no such function
ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM o),
crc AS (SELECT conv_id, (xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(s, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(x AS BIGINT) for x in range(8)]),
      lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END))), CAST(4294967295 AS BIGINT))) % 6 AS h FROM ids),
given AS (SELECT c.conv_id, o.i AS d, o.role, o.text FROM crc c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.i <= c.h),
m AS (SELECT c.conv_id, c.h, count(g.d) AS n FROM crc c LEFT JOIN given g ON g.conv_id = c.conv_id GROUP BY ALL),
t AS (SELECT * FROM given UNION ALL SELECT o.conv_id, o.i - m.h + m.n, o.role, o.text FROM o JOIN m ON m.conv_id = o.conv_id WHERE o.i > m.h),
p AS (SELECT conv_id, d, length(text) AS len, list(struct_pack(r := role, x := text)) OVER (PARTITION BY conv_id ORDER BY d) AS pre FROM t
  UNION ALL SELECT conv_id, 0, 0, CAST([] AS STRUCT(r VARCHAR, x VARCHAR)[]) FROM crc),
q AS (SELECT conv_id, d, len, md5(CAST(pre AS VARCHAR)) || md5(CAST(list_transform(pre, lambda z: struct_pack(a := length(z.r), b := length(z.x))) AS VARCHAR)) AS k,
  max(d) OVER (PARTITION BY conv_id) AS t FROM p),
r AS (SELECT q.*, u.k AS parent FROM q LEFT JOIN q u ON u.conv_id = q.conv_id AND u.d = q.d - 1),
n AS (SELECT k, any_value(parent) AS parent, any_value(d) AS d, any_value(len) AS len, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = t), '')) AS ends_sha256 FROM r GROUP BY k),
c AS (SELECT parent, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
b AS (SELECT a.k, sum((w.n_convs - 1) * w.len) AS saved, count(*) FILTER (WHERE w.leaf) AS leaves
  FROM (SELECT n.*, c.parent IS NULL AS leaf FROM n LEFT JOIN c ON c.parent = n.k) w JOIN q a ON a.conv_id = w.conv_id AND a.d <= w.d GROUP BY a.k)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, b.leaves AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN b ON b.k = n.k LEFT JOIN c ON c.parent = n.k LEFT JOIN n u ON u.k = n.parent""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.rebuilt_trie(read(spark, sf_dir, "conversations"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read(spark, sf_dir, "embeddings"))
