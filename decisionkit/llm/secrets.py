"""Secret scans by linking the parts of a credential, with DataFrame functions only.

A credential has parts: an access identifier, a secret and an endpoint. Patterns propose spans for each part. The three patterns of the base
result (an assignment to a name such as ``token``, an access key, a long hexadecimal run) are strong: what passes their length check always
stays, whatever stands around it. The others are weak, since each of them alone also occurs in harmless text: a named identifier, an opaque or
differently named secret, an address. A text is cut into scopes at blank lines, and every part covers the interval of ``REACH`` code points on
either side of it. The interval join of the parts of a scope tells for each part which complementary parts its interval meets: a weak secret is
reported if an identifier or an endpoint is met, a weak identifier if a secret is, an endpoint if a secret and, near it, any
identifier or strong secret is. Weak spans that overlap a base span, or lie in a longer weak one, go.

The join is a sweep over the scope in order of place, as two windows: of the complementary parts before a part the one that ends last is the
nearest, of those after it the one that starts first. So a scope of m parts costs m log m, and no pairs are formed.

No pattern reaches across a line break, so the breaks between two matches of one pattern lie in the text between them; running sums of lengths
and of breaks there give each span's place (in code points) and scope.

Nulls and odd rows: a null or empty text has no spans; rows that share an id and text are read once and each get the same result; rows that
share an id but not the text stay apart; a null id is an id of its own; very long texts cost time and memory in proportion to their own length; of equal weak spans (ties)
the first kind's stays; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import filled, row_key

KINDS = ["assign", "access", "hex", "identifier", "secret", "endpoint"]  # in the order of the base result, then the method's own
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "secret": "secret", "endpoint": "endpoint"}
BASE = KINDS[:3]
REACH = 400
_FREE = "(?<![A-Za-z0-9])"
_SET = r"""["']?+\x20*+[:=]\x20*+["']?+"""
#: generator, kind, pattern, cheap test of the lower-cased text, group that is the value.
GENERATORS = [
    ("assign", "assign", rf"(?i:password|passwd|secret|token|api_?key){_SET}([A-Za-z0-9+/_.=-]++)", r"(?:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]", 1),
    ("access", "access", r"AKIA[A-Z0-9]++", "akia", 0),
    ("hex", "hex", r"[0-9a-f]{24,}+", "[0-9a-f]{24}", 0),
    ("named_id", "identifier", rf"{_FREE}(?i:access_?key_?id|client_?id|account_?id|key_?id|user_?name|user|login){_SET}([A-Za-z0-9._@+-]{{3,}}+)", r"(?:id|name|user|login)[\"']?+\x20*+[:=]", 1),
    ("named_secret", "secret", rf"{_FREE}(?i:pwd|pass|passphrase|credential|private_?key|access_?key|secret_?key|secret_?access_?key|auth){_SET}([A-Za-z0-9+/_.=~!@#$%^&*-]{{6,}}+)", r"(?:pwd|pass|passphrase|credential|key|auth)[\"']?+\x20*+[:=]", 1),
    ("bearer", "secret", rf"{_FREE}(?i:bearer)\x20++([A-Za-z0-9+/_.=-]{{16,}}+)", "bearer\x20", 1),
    ("opaque", "secret", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+", r"[a-z0-9+/_-]{20}", 0),
    ("address", "endpoint", rf"{_FREE}(?i:https?|ftps?|s3|redis|postgres|postgresql|mysql|mongodb|amqps?)://[^\x00-\x20\x22\x27<>()\x7F]++", "://", 0),
    ("named_host", "endpoint", rf"{_FREE}(?i:host|hostname|endpoint|server|base_?url|url){_SET}([A-Za-z0-9.:/_-]{{3,}}+)", r"(?:host|hostname|endpoint|server|url)[\"']?+\x20*+[:=]", 1),
    ("host_port", "endpoint", r"(?<![A-Za-z0-9@.-])[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++:[0-9]{2,5}+", ":[0-9]{2}", 0),
]
BREAK = r"\n[\x20\t\r]*+\n"
LEAST_KINDS = 12  # distinct characters of an opaque secret


def _passes() -> Column:
    """The checks that follow the patterns; what fails is dropped and not tried again."""
    value = F.col("value")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
    opaque = mixed & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_KINDS) & (6 * F.regexp_count(value, F.lit("/")) <= F.length(value))
    return F.when(F.col("generator") == "assign", F.length("value") >= 6).when(F.col("generator") == "access", F.length("value") >= 20).when(F.col("generator") == "opaque", opaque).otherwise(True)


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Proposed spans: doc_id, key, kind, role, start, end, scope, base. Each distinct (id, text) is read as one."""
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(text_col)).alias("key"), filled(F.col(text_col)).alias("text"))
    rows = rows.withColumn("low", F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

    def found(generator: str, kind: str, pattern: str, test: str, group: int) -> Column:
        text = F.col("text")
        spans = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else spans
        whole = F.struct(spans.alias("spans"), values.alias("values"), F.split(text, pattern, -1).alias("gaps"), F.lit(generator).alias("generator"), F.lit(kind).alias("kind"))
        return F.when(F.col("low").rlike(test), whole)

    rows = rows.select("doc_id", "key", F.explode(F.filter(F.array(*[found(*g) for g in GENERATORS]), lambda m: m.isNotNull())).alias("m"))
    rows = rows.select("doc_id", "key", "m.*").where(F.size("spans") > 0)
    entry = lambda span, i: F.struct(
        i.alias("i"), span.alias("span"), F.get("values", i).alias("value"), F.length(F.get("gaps", i)).cast("long").alias("gap"), F.regexp_count(F.get("gaps", i), F.lit(BREAK)).cast("long").alias("breaks")
    )
    rows = rows.select("doc_id", "key", "generator", "kind", F.explode(F.transform("spans", entry)).alias("e")).select("doc_id", "key", "generator", "kind", "e.*")
    size = F.length("span").cast("long")
    rows = rows.select("doc_id", "key", "generator", "kind", "i", "gap", "breaks", size.alias("size"), F.coalesce(_passes(), F.lit(False)).alias("passes"))
    rows = rows.repartition("doc_id", "key").dropDuplicates(["doc_id", "key", "generator", "i"])
    so_far = Window.partitionBy("doc_id", "key", "generator").orderBy("i")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)).withColumn("scope", F.sum("breaks").over(so_far))
    role = F.element_at(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair]), F.col("kind"))
    return rows.where("passes").select("doc_id", "key", "kind", role.alias("role"), (F.col("end") - F.col("size")).alias("start"), "end", "scope", F.col("kind").isin(BASE).alias("base")).distinct()


def _sweeps(*keys: str) -> tuple:
    """Windows over what stands before and after a span; both run forward, so that a running frame stays linear."""
    down = Window.partitionBy(*keys).orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    up = Window.partitionBy(*keys).orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    return down, up


def _without_overlap(found: DataFrame) -> DataFrame:
    """Base spans, and weak spans that overlap none and lie in no longer weak span."""
    down, up = _sweeps("doc_id", "key")
    wide = Window.partitionBy("doc_id", "key").orderBy("start", F.desc("end"), F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))).rowsBetween(Window.unboundedPreceding, -1)
    rows = found.withColumn("inside", F.coalesce(F.max(F.when(~F.col("base"), F.col("end"))).over(wide) >= F.col("end"), F.lit(False)))
    rows = rows.withColumn("taken", F.max(F.when(F.col("base"), F.col("end"))).over(down)).withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(up))
    free = (F.coalesce("taken", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    return rows.where(F.col("base") | (free & ~F.col("inside"))).drop("taken", "next", "inside")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """The interval join: every proposal with, per role, the start of the nearest other part of that role whose interval it meets (null: none), and
    whether it is reported. Columns: doc_id, key, kind, role, start, end, scope, base, near_identifier, near_secret, near_endpoint, near_strong, reported."""
    rows = _without_overlap(parts(docs, id_col, text_col))
    down, up = _sweeps("doc_id", "key", "scope")
    roles = {"identifier": F.col("role") == "identifier", "secret": F.col("role") == "secret", "endpoint": F.col("role") == "endpoint", "strong": F.col("base")}
    before, after = F.struct("end", "start"), F.struct("start", "end")
    for name, is_role in roles.items():
        rows = rows.withColumn(f"b_{name}", F.max(F.when(is_role, before)).over(down))
    for name, is_role in roles.items():
        rows = rows.withColumn(f"a_{name}", F.min(F.when(is_role, after)).over(up))
    for name in roles:
        gaps = {"b": F.col("start") - F.col(f"b_{name}.end"), "a": F.col(f"a_{name}.start") - F.col("end")}  # null where there is no such part
        choice = [F.when(gap <= reach, F.struct(F.greatest(gap, F.lit(0)).alias("gap"), F.col(f"{side}_{name}.start").alias("start"))) for side, gap in gaps.items()]
        rows = rows.withColumn(f"near_{name}", F.array_min(F.array_compact(F.array(*choice)))["start"])
    met = {name: F.col(f"near_{name}").isNotNull() for name in roles}
    complementary = (
        F.when(F.col("role") == "secret", met["identifier"] | met["endpoint"])
        .when(F.col("role") == "identifier", met["secret"])
        .otherwise(met["secret"] & (met["identifier"] | met["strong"]))
    )
    return rows.select("doc_id", "key", "kind", "role", "start", "end", "scope", "base", *[f"near_{n}" for n in roles], (F.col("base") | complementary).alias("reported"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("own", lambda s: s["kind"] == kind))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256 and spans."""
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    one = F.struct("start", order.alias("order"), "end", "kind", "base")
    found = linked(docs, id_col, text_col, reach).where("reported")
    found = found.groupBy(F.col("doc_id").alias("s_id"), F.col("key").alias("s_key")).agg(F.sort_array(F.collect_list(one)).alias("spans"))
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(text_col)).alias("key"))
    rows = rows.join(found, rows["doc_id"].eqNullSafe(found["s_id"]) & (rows["key"] == found["s_key"]), "left")
    rows = rows.withColumn("spans", F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))).withColumn("own", F.filter("spans", lambda s: s["base"]))
    counts = [_of_kind(k).cast("long").alias(f"n_{k}") for k in BASE]
    return rows.select("doc_id", *counts, F.sha2(_listed(F.col("own")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
