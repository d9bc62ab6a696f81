"""Personal data: candidate spans scored by boosted trees, with DataFrame functions and Spark ML's own trees only.

Generators of high recall propose spans, which may overlap. Four of them are the patterns of the base result; a proposal that passes its
check (parts, digits, Luhn) is a base span and always stays. Gradient-boosted trees then score every proposal from its format and its
context; neither the checks nor the generator are features. They learn from a bounded, documented sample of labelled proposals. Proposals of the
four patterns are labelled by their check. The two looser generators have no check, so their labels come from elsewhere: every base
email and base phone also stands there rewritten, spelt out or without its country, in the same context; a spelt address is right if its
normal form ends in a domain of letters; a bare number inside a base span of another kind is wrong; other bare numbers have no label and
teach nothing. A fixed set of made-up sentences (``example_texts``), right and wrong ones of each kind, joins the proposals that teach and
calibrate at every size, so that one rule holds for a table of one row and for one of billions. The sample is drawn by kind. Per kind, a threshold is calibrated on all labelled proposals outside it: the lowest one at which at least ``PRECISION`` of the labelled
proposals it selects are right. Proposals above it that touch no base span are added.

No pattern reaches across a line break. Positions are code points: matches and the text between them come from the same pattern, and
running sums of their lengths within a document give the places.

Nulls and odd rows: a null or empty text has no spans; repeated rows get the same result each; rows that share an id but not the text stay
apart; in a table without labels of its own the examples alone teach; an empty table gives an empty result;
other columns are not looked at. Redaction cuts a text at each of its spans, which costs spans times length within one text.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import filled, row_key, staged

KINDS = ["email", "ip", "card", "phone"]  # in the order of the base result
LOCAL = "[A-Za-z0-9._%+-]"
#: generator, kind, pattern. Possessive groups run without recursion; an address starts where no sign of its kind stands before, or where the last one ended.
BARE = r"(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}"
GENERATORS = [
    ("email", "email", rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"),
    ("ip", "ip", r"[0-9]++(?:\.[0-9]++){3}"),
    ("card", "card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email_spelt", "email", r"[A-Za-z0-9._%+-]++ ?[(\[](?:at|AT)[)\]] ?[A-Za-z0-9-]++(?:(?:\x20\.\x20|\.| ?[(\[](?:dot|DOT)[)\]] ?)[A-Za-z0-9-]++)++"),
    ("phone_bare", "phone", rf"(?<![0-9A-Za-z+.]){BARE}(?![0-9A-Za-z])"),
]
#: How a rewritten address spells its signs, and what parts a rewritten number; None leaves it as it is.
SPELT = [(" (at) ", "."), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(AT)", " (DOT) ")]
PARTED = [None, "-", " ", "."]
CONTEXT = {"c_mail": "mail|contact|@", "c_phone": "phone|tel|call|fax|mobile", "c_card": "card|visa|credit|pay", "c_net": "ip|host|server|addr", "c_secret": "token|password|key|secret|="}
FEATURES = ["size", "digits", "letters", "blanks", "dashes", "dots", "brackets", "plus", "at", "groups", "runs", "lead", "tail", "more", *CONTEXT]
SAMPLE, TREES, DEPTH, PRECISION, EXAMPLES = 20_000, 12, 4, 0.95, 40


def _matches(text: Column, pattern: str, generator: str, kind: str) -> Column:
    """Array of (gen, kind, i, gap, span, before, after) for one generator."""
    return F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("spans"), F.split(text, pattern, -1).alias("gaps"), F.lit(generator).alias("gen"), F.lit(kind).alias("kind"))


def _kept_digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of digits, every second from the right doubled, is a multiple of ten."""
    d = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    value = lambda i: F.when(i % 2 == 0, F.when(d(i) > 4, 2 * d(i) - 9).otherwise(2 * d(i))).otherwise(d(i))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def _valid() -> Column:
    digits, n = _kept_digits(F.col("span")), F.col("digits")
    part = F.transform(F.split("span", r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = F.forall(part, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p.cast("int")).otherwise(999) <= 255))
    card = F.when(n.between(14, 19), _luhn(digits)).otherwise(False)
    return (
        F.when(F.col("gen") == "email", True)
        .when(F.col("gen") == "ip", small)
        .when(F.col("gen") == "card", card)
        .when(F.col("gen") == "phone", n.between(10, 15))
        .otherwise(False)
    )


def _count(pattern: str) -> Column:
    return F.regexp_count("span", F.lit(pattern))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Proposals: doc_id, key, generator, kind, start, end, base, label, the span with its surroundings, and what the trees read. Each distinct
    (id, text) is read as one."""
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(text_col)).alias("key"), filled(F.col(text_col)).alias("text"))
    worth = {"email": F.contains("text", F.lit("@")), "email_spelt": F.lower("text").rlike(r"[(\[]at[)\]]"), "phone": F.contains("text", F.lit("+"))}
    found = [F.when(worth.get(g, F.col("text").rlike("[0-9]")), _matches(F.col("text"), p, g, k)) for g, k, p in GENERATORS]
    rows = rows.select("doc_id", "key", F.explode(F.filter(F.array(*found), lambda m: m.isNotNull())).alias("m")).where(F.size("m.spans") > 0)
    rows = rows.select("doc_id", "key", "m.gen", "m.kind", F.col("m.gaps").alias("gaps"), F.col("m.spans").alias("spans"))
    entry = lambda span, i: F.struct(
        i.alias("i"),
        F.length(F.get("gaps", i)).cast("long").alias("gap"),
        span.alias("span"),
        F.lower(F.right(F.get("gaps", i), F.lit(24))).alias("before"),
        F.left(F.get("gaps", i + 1), F.lit(2)).alias("after"),
    )
    rows = rows.select("doc_id", "key", "gen", "kind", F.explode(F.transform("spans", entry)).alias("e")).select("doc_id", "key", "gen", "kind", "e.*")
    rows = rows.repartition("doc_id", "key").dropDuplicates(["doc_id", "key", "gen", "i"])
    size = F.length("span").cast("long")
    so_far = F.sum(F.col("gap") + size).over(Window.partitionBy("doc_id", "key", "gen").orderBy("i"))
    rows = rows.withColumn("end", so_far).withColumn("start", F.col("end") - size).withColumn("digits", F.length(_kept_digits(F.col("span"))))
    rows = rows.where(F.when(F.col("gen") == "card", F.col("digits") >= 12).when(F.col("gen").isin("phone", "phone_bare"), F.col("digits") >= 7).otherwise(True))
    rows = rows.withColumn("base", F.coalesce(_valid(), F.lit(False)))
    down, up = _around()
    other = F.col("base") & (F.col("kind") != "phone")
    rows = rows.withColumn("taken", (F.max(F.when(other, F.col("end"))).over(down) >= F.col("end")) | (F.min(F.when(other, F.col("start"))).over(up) <= F.col("start")))
    rows = rows.withColumn("label", F.when(F.col("gen") == "email_spelt", _spelt_right()).when(F.col("gen") == "phone_bare", F.when(F.col("taken"), False)).otherwise(F.col("base")))
    return _described(rows.withColumnRenamed("gen", "generator"))


def _around() -> tuple:
    """Windows over the spans of a document that stand before and after a span."""
    down = Window.partitionBy("doc_id", "key").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    up = Window.partitionBy("doc_id", "key").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    return down, up


def _spelt_right() -> Column:
    """The normal form of a spelt address ends in a domain of letters."""
    normal = F.regexp_replace("span", r" ?[(\[](?:at|AT)[)\]] ?", "@")
    normal = F.regexp_replace(normal, r" ?[(\[](?:dot|DOT)[)\]] ?|\x20\.\x20", ".")
    return normal.rlike(rf"^{LOCAL}++@[A-Za-z0-9.-]*[A-Za-z0-9-]\.[A-Za-z]{{2,}}$")


def _one_of(texts: list[Column]) -> Column:
    return F.element_at(F.array(*texts), (F.pmod(F.xxhash64("key", "start"), F.lit(len(texts))) + 1).cast("int"))


def rewritten(found: DataFrame) -> DataFrame:
    """Base emails spelt out and base phones without their country, as proposals of the looser generators with labels."""
    name, host = F.substring_index("span", "@", 1), F.substring_index("span", "@", -1)
    spelt = _one_of([F.concat(name, F.lit(at), F.replace(host, F.lit("."), F.lit(dot))) for at, dot in SPELT])
    bare = F.regexp_replace("span", r"^\+[0-9]{1,3}[\x20.-]*", "")
    inner = F.regexp_replace(bare, "[()]", "")
    bare = _one_of([bare if sign is None else F.regexp_replace(inner, r"[\x20.-]", sign) for sign in PARTED])
    rows = found.where("base and kind in ('email', 'phone')").withColumn("span", F.when(F.col("kind") == "email", spelt).otherwise(bare))
    rows = rows.where((F.col("kind") == "email") | F.col("span").rlike(f"^{BARE}$"))
    rows = rows.withColumn("generator", F.when(F.col("kind") == "email", "email_spelt").otherwise("phone_bare")).withColumn("base", F.lit(False))
    rows = rows.withColumn("label", F.when(F.col("kind") == "email", _spelt_right()).otherwise(True)).withColumn("digits", F.length(_kept_digits(F.col("span"))))
    return _described(rows)


def _described(rows: DataFrame) -> DataFrame:
    """What the trees read of a span, as columns f_*."""
    numbers = {
        "size": F.least(F.length("span"), F.lit(100)),
        "digits": F.least("digits", F.lit(40)),
        "letters": F.least(_count("[A-Za-z]"), F.lit(60)),
        "blanks": _count(r"\x20"),
        "dashes": _count("-"),
        "dots": _count(r"\."),
        "brackets": _count(r"[()\[\]]"),
        "plus": _count(r"\+"),
        "at": _count("@"),
        "groups": _count("[0-9]+"),
        "runs": F.coalesce(F.array_max(F.transform(F.regexp_extract_all("span", F.lit("[0-9]+"), F.lit(0)), lambda x: F.length(x))), F.lit(0)),
        "lead": F.when(F.right("before", F.lit(1)).rlike(r"^[\x20\n]?$"), 0).when(F.right("before", F.lit(1)).rlike("[0-9a-z]"), 2).otherwise(1),
        "tail": F.when(F.left("after", F.lit(1)).rlike(r"^[\x20\n]?$"), 0).when(F.left("after", F.lit(1)).rlike("[0-9A-Za-z]"), 2).otherwise(1),
        "more": F.col("after").rlike(r"^[\x20.-]?[0-9]").cast("int"),
    } | {c: F.col("before").rlike(p).cast("int") for c, p in CONTEXT.items()}
    return rows.select("doc_id", "key", "generator", "kind", "start", "end", "base", "label", "span", "before", "after", *[v.cast("double").alias(f"f_{k}") for k, v in numbers.items()])


def _with_check_digit(digits: str) -> str:
    doubled = [2 * int(d) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits))]
    return digits + str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def example_texts(n: int = EXAMPLES) -> list[str]:
    """``n`` made-up sentences for each of nine shapes: an address, numbers with and without the right form, spelt addresses with and without a
    domain of letters, in all pairs of signs. Every second name has no digits. Right and wrong cards and ips differ in nothing that the trees see."""
    out = []
    for i in range(n):
        a, b = 200 + 13 * i % 700, 1000 + 337 * i % 9000
        name = "".join(chr(97 + (7 * i + 5 * k) % 26) for k in range(2 + i % 6)) + (str(i) if i % 2 else "")
        at, dot = [" (at) ", "(at)", " [at] ", "[at]"][i % 4], [".", "[dot]", " [dot] ", " (dot) "][i // 4 % 4]
        card = _with_check_digit(f"4{b}{a}{b + 7}{a}"[:15])
        parted = lambda c, i=i: c if i % 2 else " ".join(c[k : k + 4] for k in range(0, 16, 4))
        out += [
            f"write to {name}@host{i % 9}.example or stay",
            f"call +1 ({a}) 555-{b} then",
            f"order +{i % 9 + 1} {a}-{b} of",
            f"seen 10.{i}.{a % 256}.{b % 256} in",
            f"seen 10.{i}.{a % 256}.{256 + b % 256} in",
            f"pay by {parted(card)} now",
            f"pay by {parted(card[:15] + str((int(card[15]) + 1 + i % 9) % 10))} now",
            f"ask {name}{at}{name[::-1]}{dot}{['org', 'example'][i % 2]} too",
            f"row {name if i % 3 else i % 10}{at}{i % 10 if i % 2 else i}{dot}{a if i % 5 else i % 9} of",
        ]
    return out


def _examples(found: DataFrame) -> DataFrame:
    """The examples' proposals, in the columns of ``found``; their ids are null."""
    spark = found.sparkSession
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(example_texts())], "doc_id long, text string")
    return candidates(rows).withColumn("doc_id", F.lit(None).cast(found.schema["doc_id"].dataType)).select(found.columns)


def _scored(found: DataFrame, sample: int, trees: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """(all proposals with ``score``, every labelled proposal that was not fitted on with ``score``). Labelled proposals are those of the table
    and of the examples. The fitting sample is drawn by kind, an equal part of ``sample`` each, and takes the examples beside it; a quarter of the labelled proposals is never in it."""
    labelled = lambda df: df.where("label is not null").unionByName(rewritten(df))
    own, given = labelled(found), labelled(staged(_examples(found), "examples"))
    known = own.withColumn("example", F.lit(False)).unionByName(given.withColumn("example", F.lit(True)))
    sizes = {r["kind"]: r["n"] for r in own.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for kind in KINDS:
        share = F.when(F.col("kind") == kind, min(1.0, sample / len(KINDS) / max(1, sizes.get(kind, 0)))).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", "key", "generator", "start"), F.lit(1 << 30)) / float(1 << 30)
    gathered = VectorAssembler(inputCols=[f"f_{c}" for c in FEATURES], outputCol="features")
    every = gathered.transform(known).withColumn("label", F.col("label").cast("double"))
    every = every.withColumn("fitted", (F.col("example") | (draw < share)) & (F.pmod(F.xxhash64("start", "key"), F.lit(4)) != 0))
    fit = every.where("fitted")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=5, checkpointInterval=-1).fit(fit.select("features", "label"))
    probability = lambda df: model.transform(df).withColumn("score", F.round(vector_to_array("probability")[1], 4))
    return probability(gathered.transform(found)), probability(every.where("not fitted"))


def _thresholds(aside: DataFrame, precision: float) -> dict[str, float]:
    """Per kind the lowest score from which on enough of the selection are right. Scores are rounded, so few rows reach the driver."""
    table = aside.withColumn("bin", F.floor(F.col("score") * 200) / 200).groupBy("kind", "bin").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    rows = sorted((r["kind"], -r["bin"], r["n"], r["hits"]) for r in table.collect())
    out: dict[str, float] = {}
    for kind in KINDS:
        own = [r for r in rows if r[0] == kind]
        n = hits = 0
        for (_, bin_, more, right), below in zip(own, [-r[1] for r in own[1:]] + [0.0]):
            n, hits = n + more, hits + right
            if hits >= precision * n and -bin_ >= 0.5:
                out[kind] = max(0.5, below + 0.005)  # the lowest score that selects no more than these bins
    return out


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH, precision: float = PRECISION) -> DataFrame:
    """Selected spans: doc_id, key, kind, start, end, base, score. Added spans touch no base span."""
    found = staged(candidates(docs, id_col, text_col), "proposals")
    scored, aside = _scored(found, sample, trees, depth)
    cut = F.lit(2.0)
    for kind, value in _thresholds(aside, precision).items():
        cut = F.when(F.col("kind") == kind, F.lit(value)).otherwise(cut)
    rows = scored.where(F.col("base") | (F.col("score") >= cut)).select("doc_id", "key", "kind", "start", "end", "base", "score")
    down, up = _around()
    rows = rows.withColumn("before", F.max(F.when(F.col("base"), F.col("end"))).over(down)).withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(up))
    free = (F.coalesce("before", F.lit(-1)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    return rows.where(F.col("base") | free).drop("before", "next").dropDuplicates(["doc_id", "key", "kind", "start", "end"])


def _listed(picked: Column) -> Column:
    return F.array_join(F.transform(picked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _per_document(found: DataFrame) -> DataFrame:
    """(p_id, p_key, spans): spans of a document by start, then kind as listed."""
    order = F.lit(0)
    for k, kind in enumerate(KINDS):
        order = F.when(F.col("kind") == kind, k).otherwise(order)
    one = F.struct(F.col("start").alias("start"), order.alias("o"), F.col("end").alias("end"), F.col("kind").alias("kind"), F.col("base").alias("base"))
    return found.groupBy(F.col("doc_id").alias("p_id"), F.col("key").alias("p_key")).agg(F.sort_array(F.collect_list(one)).alias("spans"))


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("own", lambda s: s["kind"] == kind))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans."""
    per_doc = _per_document(spans(docs, id_col, text_col, **limits))
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(text_col)).alias("key"))
    rows = rows.join(per_doc, rows["doc_id"].eqNullSafe(per_doc["p_id"]) & (rows["key"] == per_doc["p_key"]), "left")
    none = F.array().cast("array<struct<start:bigint,o:int,end:bigint,kind:string,base:boolean>>")
    rows = rows.withColumn("spans", F.coalesce("spans", none)).withColumn("own", F.filter("spans", lambda s: s["base"]))
    counts = [_of_kind(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(_listed(F.col("own")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with every selected span replaced by its kind in angle brackets; overlapping spans become one. All columns kept."""
    found = spans(docs, id_col, text_col, **limits)
    down = Window.partitionBy("doc_id", "key").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("from", F.coalesce(F.max("end").over(down), F.lit(0).cast("long"))).where(F.col("end") > F.col("from"))
    one = F.struct(F.col("start").alias("start"), F.col("end").alias("end"), F.col("kind").alias("kind"), F.col("from").alias("from"))
    cuts = found.groupBy(F.col("doc_id").alias("__cut_id"), F.col("key").alias("__cut_key")).agg(F.sort_array(F.collect_list(one)).alias("__cuts"))
    rows = docs.withColumn("__key", row_key(F.col(text_col)))
    rows = rows.join(cuts, rows[id_col].eqNullSafe(cuts["__cut_id"]) & (rows["__key"] == cuts["__cut_key"]), "left")
    text = F.col(text_col)
    between = lambda s: F.substring(text, (s["from"] + 1).cast("int"), F.greatest(s["start"] - s["from"], F.lit(0)).cast("int"))
    parts = F.transform("__cuts", lambda s: F.concat(between(s), F.when(s["start"] >= s["from"], F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise(F.lit(""))))
    rest = F.substring(text, (F.get("__cuts", F.size("__cuts") - 1)["end"] + 1).cast("int"), F.length(text))
    return rows.withColumn(text_col, F.when(F.col("__cuts").isNull(), text).otherwise(F.concat(F.array_join(parts, ""), rest))).select(*docs.columns)
