"""MinHash near-dedup: many universal hash minima, banding, signature verification, exact confirmation, star components.

1. Each document becomes its set of distinct word shingles (64-bit hashes) and the minima of ``HASHES`` universal
   functions over it. Documents with equal sets are one class; everything below works on classes.
2. Classes that agree on a band of the signature share a bucket. The smallest class of a bucket is its hub; only
   (class, hub) pairs are formed, so a bucket of m classes gives m - 1 of them.
3. Pairs whose signatures are far from the threshold go; the others are confirmed on the full sets.
4. Components of the confirmed links. In buckets that still hold several components, signatures are compared between components, in
   blocks; what is near joins those components into a cluster, and a task passes on only the pairs that join something.
5. Inside a cluster all links between different components are sought on the full sets, block against block. Counts of common
   shingles come from a product of incidence matrices, and again only links that join components leave a task. So no link that matters is lost, and
   pairs inside a component, or pairs that fail, are never written.

With 32 bands of 4 rows a pair at similarity 0.8 shares no band with probability 5e-8; with 128 minima the estimate lies more than
``MARGIN`` below the truth with probability 1e-8.

Nulls and odd rows: null, empty or blank texts have the empty set, no link and their own id as component; a text with fewer words
than a shingle is one shingle; repeated rows and equal sets share a component; a null id sorts last and names a component only if it
has no other id; an empty table gives an empty result; other columns are not looked at. Long texts cost memory in
proportion to their own length only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled, rows_of, sliced, staged, target_partitions
from .components import star_components

HASHES, BANDS = 128, 32
BLOCK, SET_BLOCK = 512, 256
MARGIN = 0.2
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_CHUNK = 2048


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(body: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text; A-Z lower-cased, words split at ASCII white space."""
    words = body.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mixed(total * _MIX[0] + h[k : len(h) - width + 1 + k])
    return np.unique(total)


def _functions(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240229)
    a = draw.integers(0, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 2**63, hashes, dtype=np.uint64)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of the multiply-shift functions (a x + b) >> 32."""
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(shingles), _CHUNK):
        values = shingles[i : i + _CHUNK, None] * a[None] + b[None]
        best = np.minimum(best, (values.min(axis=0) >> np.uint64(32)).astype(np.uint32))
    return best


def _featured(width: int, hashes: int, with_sets: bool):
    """Rows leave in small batches; sets come without a key of the text, as their callers need none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _functions(hashes)
        for batch in batches:
            for part in sliced(batch, "body"):
                n, keys, out, texts = [], [], [], []
                for body in part.column("body"):
                    body = body.as_py()
                    s = shingle_hashes(body, width)
                    raw = s.astype("<u8").tobytes()
                    n.append(len(s))
                    keys.append(hashlib.blake2b(raw, digest_size=16).digest() if len(s) else None)
                    out.append(raw if with_sets else signature(s, a, b).astype("<u4").tobytes() if len(s) else None)
                    if not with_sets:
                        texts.append(hashlib.md5(body).hexdigest())
                columns = {"doc_id": part.column("doc_id"), "n_shingles": pa.array(n, pa.int64()), "set_key": pa.array(keys, pa.binary()), "data": pa.array(out, pa.binary())}
                yield pa.RecordBatch.from_pydict(columns if with_sets else columns | {"text_key": pa.array(texts, pa.string())})

    return run


def shingled(docs: DataFrame, width: int, hashes: int = HASHES, with_sets: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, set_key and data: the set itself, or the signature and text_key (md5)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.encode(filled(F.col(text_col)), "UTF-8").alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_featured(width, hashes, with_sets), f"doc_id {kind}, n_shingles long, set_key binary, data binary" + ("" if with_sets else ", text_key string"))


def _near(threshold: float):
    """Keep pairs whose signatures don't rule the threshold out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1) for c in ("sig_u", "sig_v"))
                near = (left == right).mean(axis=1) >= threshold - MARGIN
                yield batch.select(["u", "v"]).filter(pa.array(near))

    return run


def _confirm(share: int):
    """Keep pairs with 100 * intersection >= share * union, on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_u"), batch.column("set_v")):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= share * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def sets_of(docs: DataFrame, classes: DataFrame, ids: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id, data) with the full sets of the given classes, read from their representatives' texts."""
    needed = staged(ids.join(classes.select("id", "set_key", "rep"), "id"), "needed")
    reps = needed.select(F.col("rep").alias("__rep")).distinct()
    texts = docs.select(id_col, text_col).join(reps, docs[id_col].eqNullSafe(reps["__rep"]), "left_semi")
    sets = shingled(texts, width, with_sets=True, id_col=id_col, text_col=text_col).select("set_key", "data")
    sets = sets.join(needed.select("id", "set_key"), "set_key").groupBy("id").agg(F.first("data").alias("data"))
    return staged(sets, "sets")


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, share: int, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pairs (u, v) of class ids whose full sets are as similar as ``share`` percent."""
    signed = classes.select("id", "data")
    pairs = pairs.join(signed.select(F.col("id").alias("u"), F.col("data").alias("sig_u")), "u")
    pairs = pairs.join(signed.select(F.col("id").alias("v"), F.col("data").alias("sig_v")), "v")
    pairs = staged(pairs.select("u", "v", "sig_u", "sig_v").mapInArrow(_near(share / 100), "u long, v long"), "pairs")
    sets = sets_of(docs, classes, pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct(), width, id_col, text_col)
    full = pairs.join(sets.select(F.col("id").alias("u"), F.col("data").alias("set_u")), "u")
    full = full.join(sets.select(F.col("id").alias("v"), F.col("data").alias("set_v")), "v")
    return staged(full.select("u", "v", "set_u", "set_v").mapInArrow(_confirm(share), "u long, v long"), "links")


def _blocked(members: DataFrame, group: str, block: int, classes: DataFrame) -> DataFrame:
    """(group, id, comp) -> rows for every pair of blocks of every group: group, i, j, blk, id, comp; groups of one component are left out."""
    mixed = members.groupBy(group).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).where("lo < hi")
    mixed = mixed.select(group, F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    rows = members.join(mixed, group).withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.select(F.col(group).alias("key"), F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "id", "comp")
    return staged(rows.join(classes, "id"), "blocks")


def _in_shares(rows: DataFrame, share_bytes: int = 1 << 25) -> DataFrame:
    """Block pairs are dealt to shares of about ``share_bytes``, so that a task gets many small ones or a few large."""
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    shares = max(target_partitions(rows.sparkSession), -(-total // share_bytes))
    return rows.withColumn("share", F.pmod(F.xxhash64("key", "i", "j"), F.lit(shares))).groupBy("share")


def _join_blocks(near_rows):
    """Runs over block pairs. ``near_rows(first, second)`` gives, row by row of the first, a function that tells which of some rows of the second are near.

    A pair is looked at only while its components are apart, and passed on only if it joins them.
    """

    def run(table: pa.Table) -> pa.Table:
        us, vs = [], []
        data = table.column("data").to_pylist()
        key, i, j, blk, ids, comp = (table.column(c).to_numpy() for c in ("key", "i", "j", "blk", "id", "comp"))
        order = np.lexsort((ids, j, i, key))
        cut = np.flatnonzero(np.any(np.stack([np.diff(x[order]) != 0 for x in (key, i, j)]), axis=0)) + 1
        for rows in np.split(order, cut):
            first, second = rows[blk[rows] == i[rows[0]]], rows[blk[rows] == j[rows[0]]]
            mine, theirs = comp[first].copy(), comp[second].copy()
            if (comp[rows] == comp[rows[0]]).all():
                continue
            near = near_rows([data[r] for r in first], [data[r] for r in second])
            for a in range(len(first)):
                apart = np.flatnonzero(theirs != mine[a])
                if not len(apart):
                    continue
                for b in apart[near(a, apart)]:
                    old = theirs[b]
                    if old != mine[a]:
                        us.append(max(ids[first[a]], ids[second[b]]))
                        vs.append(min(ids[first[a]], ids[second[b]]))
                        new = mine[a]
                        mine[mine == old] = new
                        theirs[theirs == old] = new
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return run


def _by_signature(threshold: float):
    def near_rows(first: list[bytes], second: list[bytes]):
        a, b = (np.frombuffer(b"".join(x), "<u4").reshape(len(x), -1) for x in (first, second))
        return lambda row, others: (b[others] == a[row]).mean(axis=1) >= threshold - MARGIN

    return near_rows


def _by_set(share: int, columns: int = 1 << 13):
    def near_rows(first: list[bytes], second: list[bytes]):
        a, b = ([np.frombuffer(x, "<u8") for x in side] for side in (first, second))
        na, nb = (np.array([len(x) for x in side]) for side in (a, b))
        values, column, seen = np.unique(np.concatenate(a + b), return_inverse=True, return_counts=True)
        place = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)[column]  # what one set alone holds is in no intersection
        row = np.repeat(np.arange(len(a) + len(b)), np.concatenate([na, nb]))
        row, place = row[place >= 0], place[place >= 0]
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        both = np.zeros((len(a), len(b)), np.float64)
        for at in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
            part = slice(*np.searchsorted(place, (at, at + columns)))
            held = np.zeros((len(a) + len(b), columns), np.float32)
            held[row[part], place[part] - at] = 1
            both += held[: len(a)] @ held[len(a) :].T
        linked = 100 * both >= share * (na[:, None] + nb[None] - both) - 1e-6
        return lambda row, others: linked[row, others]

    return near_rows


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    comp = members.join(labels.select(F.col("u").alias("id"), F.col("v").alias("comp")), "id", "left")
    return comp.withColumn("comp", F.coalesce("comp", "id"))


def joined_across(docs: DataFrame, classes: DataFrame, members: DataFrame, labels: DataFrame, share: int, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Links between components that meet in a bucket, enough of them to join what belongs together."""
    met = staged(_labelled(members, labels).select("key", "id", "comp"), "members")
    rows = _blocked(met, "key", BLOCK, classes.select("id", "data"))
    near = staged(_in_shares(rows).applyInArrow(_join_blocks(_by_signature(share / 100)), "u long, v long").distinct(), "near")
    if near.isEmpty():
        return near
    whole = labels.select("u", "v").unionByName(near)
    clusters = star_components(whole)
    ids = clusters.select(F.col("u").alias("id"), F.col("v").alias("cluster"))
    ids = ids.unionByName(clusters.select(F.col("v").alias("id"), F.col("v").alias("cluster")).distinct())
    inside = staged(_labelled(ids, labels).select("cluster", "id", "comp"), "inside")
    mixed = inside.groupBy("cluster").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("cluster")
    inside = staged(inside.join(mixed, "cluster"), "inside")
    sets = sets_of(docs, classes, inside.select("id"), width, id_col, text_col)
    rows = _blocked(inside, "cluster", SET_BLOCK, sets)
    return staged(_in_shares(rows).applyInArrow(_join_blocks(_by_set(share)), "u long, v long").distinct(), "links")


def near_duplicates(docs: DataFrame, width: int = 5, share: int = 80, id_col: str = "doc_id", text_col: str = "text", hashes: int = HASHES, bands: int = BANDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, set_key, text_key."""
    rows = staged(shingled(docs, width, hashes, False, id_col, text_col), "signatures")
    classes = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("data").alias("data"))
    classes = staged(classes.select(F.monotonically_increasing_id().alias("id"), "set_key", "rep", "data"), "classes")

    size = 4 * hashes // bands
    cut = classes.select("id", "data", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"))
    cut = cut.select(F.xxhash64("band", F.substring(F.col("data"), F.col("band") * size + 1, F.lit(size))).alias("key"), "id")
    hubs = cut.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").select("key", "hub")
    members = staged(cut.join(hubs, "key"), "buckets")

    stars = members.where("id <> hub").select(F.col("id").alias("u"), F.col("hub").alias("v")).distinct()
    links = confirmed(docs, classes, stars, share, width, id_col, text_col)
    labels = star_components(links)
    more = joined_across(docs, classes, members.select("key", "id"), labels, share, width, id_col, text_col)
    if not more.isEmpty():
        labels = star_components(labels.unionByName(more))

    named = classes.select("id", "set_key", "rep").join(labels.select(F.col("u").alias("id"), F.col("v").alias("comp")), "id", "left")
    named = staged(named.select("set_key", "rep", F.coalesce("comp", "id").alias("comp")), "named")
    least = named.groupBy("comp").agg(F.min("rep").alias("component"))
    named = staged(named.join(least, "comp").select(F.col("set_key").alias("__set"), "component"), "components")
    out = rows.join(named, rows["set_key"] == named["__set"], "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.col("doc_id").isNull() & component.isNull()).alias("kept"), "set_key", "text_key")


def keep_one_of_each(docs: DataFrame, width: int = 5, share: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates (the one with the smallest id), all columns kept."""
    kept = near_duplicates(docs, width, share, id_col, text_col).where("kept")
    keyed = docs.withColumn("__text_key", F.md5(F.encode(filled(F.col(text_col)), "UTF-8")))
    return rows_of(keyed, "__text_key", kept.select(F.col("doc_id").alias(id_col), F.col("text_key").alias("__text_key")), id_col, text_col)
