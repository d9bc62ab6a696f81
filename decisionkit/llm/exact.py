"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes. Distinct blocks are sorted and get integer names in
that order; then adjacent names are paired, distinct pairs are sorted and named, and so on until one name is left for
each document. Texts with the same number of blocks and the same last name are equal, and only those.

Blocks travel by a 128-bit key, so that the text itself is shuffled once: to prove that no key stands for two
blocks. Should that ever happen, the keys are drawn anew with the next seed; the names stay free of collisions.

Nulls and odd rows: a null text counts as empty (all such rows are one group); a null id sorts last, and a group of null
ids only has a null ``keep_id``; of repeated rows with equal id and text exactly one has ``kept`` set; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filled, rows_of, staged

BLOCK_BYTES = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(filled(text), r"[\x20\x09-\x0D]+", " ")


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.encode(normalised(F.col(text_col)), "UTF-8").alias("body"))


def _n_blocks(block_bytes: int) -> Column:
    return F.greatest(F.ceil(F.octet_length("body") / F.lit(block_bytes)), F.lit(1)).cast("long")


def _keys(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("k1"), F.xxhash64(block, F.lit(2 * seed + 1)).alias("k2"))


def _in_order(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Integer names that follow the sort order of ``keys``; written down, so that they never change."""
    return staged(distinct.orderBy(*keys).withColumn("name", F.monotonically_increasing_id()), "names")


def _named_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, text_sha256, n, blocks) and the names of the blocks."""
    bodies = _bodies(docs, id_col, text_col)
    cut = bodies.select("body", F.explode(F.sequence(F.lit(0).cast("long"), _n_blocks(block_bytes) - 1)).alias("pos"))
    block = F.substring(F.col("body"), (F.col("pos") * block_bytes + 1).cast("int"), F.lit(block_bytes))
    seed = 0
    while True:
        texts = cut.select(block.alias("block")).select(_keys(F.col("block"), seed).alias("k"), "block")
        texts = texts.groupBy("k.k1", "k.k2", "block").agg(F.count("*").alias("rows"))
        keys = staged(texts.groupBy("k1", "k2").agg(F.count("*").alias("texts")), "blocks")
        if keys.where("texts > 1").isEmpty():
            break
        seed += 1
    rows = bodies.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2("body", 256).alias("text_sha256"),
        _n_blocks(block_bytes).alias("n"),
        F.transform(
            F.sequence(F.lit(0).cast("long"), _n_blocks(block_bytes) - 1),
            lambda i: _keys(F.substring(F.col("body"), (i * block_bytes + 1).cast("int"), F.lit(block_bytes)), seed),
        ).alias("blocks"),
    )
    return staged(rows, "rows"), _in_order(keys.select("k1", "k2"), ["k1", "k2"])


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: row, doc_id, text_sha256, n (blocks) and name; (n, name) is the same for equal texts only."""
    rows, names = _named_blocks(docs, id_col, text_col, block_bytes)
    level = rows.select("row", "n", F.posexplode("blocks").alias("pos", "k"))
    level = level.select("row", "n", "pos", "k.k1", "k.k2").join(names, ["k1", "k2"]).select("row", "n", "pos", "name")
    most = rows.agg(F.max("n")).first()[0] or 1
    level, done = staged(level, "level"), []
    for step in range(math.ceil(math.log2(most)) + 1):
        left = F.ceil(F.col("n") / F.lit(float(2**step)))
        done.append(level.where(left == 1).select("row", "name"))
        if 2**step >= most:
            break
        pairs = (
            level.where(left > 1)
            .groupBy("row", "n", F.floor(F.col("pos") / 2).alias("half"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left_name"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1).cast("long")).alias("right_name"),
            )
        )
        pairs = staged(pairs, "pairs")
        named = _in_order(pairs.select("left_name", "right_name").distinct(), ["left_name", "right_name"])
        level = pairs.join(named, ["left_name", "right_name"]).select("row", "n", F.col("half").alias("pos"), "name")
        level = staged(level, "level")
    last = done[0]
    for more in done[1:]:
        last = last.unionByName(more)
    return rows.select("row", "doc_id", "text_sha256", "n").join(last, "row")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    named = staged(identities(docs, id_col, text_col, block_bytes), "named")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    groups = named.groupBy(F.col("n").alias("g_n"), F.col("name").alias("g_name")).agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    groups = staged(groups, "groups")  # else the count and the join share a stage, in which a large group cannot be split
    same = (F.col("n") == F.col("g_n")) & (F.col("name") == F.col("g_name"))
    return named.join(groups, same).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact duplicates, all columns kept."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept")
    keyed = docs.withColumn("__text_key", F.sha2(F.encode(normalised(F.col(text_col)), "UTF-8"), 256))
    return rows_of(keyed, "__text_key", kept.select(F.col("doc_id").alias(id_col), F.col("text_sha256").alias("__text_key")), id_col, text_col)
