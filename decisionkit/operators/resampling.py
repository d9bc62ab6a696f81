"""Bootstrap by Poisson(1) weights taken from a hash: no resampled copies, repeatable anywhere."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.hashing import hash_long
from ..functions.scalars import r6

PER_DIGEST = 8  # an md5 holds eight 16-bit draws
md5 = functools.partial(hashlib.md5, usedforsecurity=False)
PRIME = (1 << 31) - 1
DRAW_SHIFT = 15  # a draw below PRIME has 16 leading bits above this
POISSON_CUTS = [round(65536 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(8)]
ROWS_AT_ONCE = 512


def lines(replicates: int, seed: int | str) -> tuple[np.ndarray, np.ndarray]:
    """Slope and intercept of each replicate: a key with hash h draws (slope h + intercept) mod PRIME there."""
    digit = lambda kind, r: int(hashlib.md5(f"{seed}|{kind}|{r}".encode()).hexdigest()[:15], 16)
    slopes = [1 + digit("slope", r) % (PRIME - 1) for r in range(replicates)]
    return np.array(slopes, np.int64), np.array([digit("intercept", r) % PRIME for r in range(replicates)], np.int64)


def poisson_weights(hashes: np.ndarray, slopes: np.ndarray, intercepts: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
    """Weights (rows x replicates); products stay below 2**62 and are exact."""
    draws = hashes[:, None] * slopes[None, :] + intercepts[None, :]
    draws = (draws & PRIME) + (draws >> 31)  # mod a Mersenne prime: fold twice
    draws = (draws & PRIME) + (draws >> 31)
    draws[draws == PRIME] = 0
    return weight_of[draws >> DRAW_SHIFT]


def digest_draws(seed: int | str, replicates: int) -> Callable[[list[str | None]], np.ndarray]:
    """16-bit draws (keys x replicates), eight from each digest of seed, block of replicates and key: independent of each other."""
    blocks = [f"{seed}|{b}".encode() for b in range(-(-replicates // PER_DIGEST))]

    def draws(keys: list[str | None]) -> np.ndarray:
        tails = [b"" if k is None else b"|" + k.encode() for k in keys]
        digests = b"".join([md5(block + tail).digest() for tail in tails for block in blocks])
        return np.frombuffer(digests, ">u2").reshape(len(keys), -1)[:, :replicates]

    return draws


def _drawn_totals(replicates: int, seed: int | str, groups: list[str], names: list[str], schema: pa.Schema):
    """Weighted totals of a task's rows as in ``_partial_totals``, with weights from ``digest_draws``. Rows of one key draw once in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight_of = np.searchsorted(POISSON_CUTS, np.arange(65536), side="right").astype(np.float64)
        draws, sums = digest_draws(seed, replicates), {}
        for batch in batches:
            coded = batch.column("_key").dictionary_encode()
            keys = coded.dictionary.to_pylist() + [None]
            key = coded.indices.fill_null(len(keys) - 1).to_numpy(zero_copy_only=False)
            values = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in names], axis=1)
            group = list(zip(*[batch.column(g).to_pylist() for g in groups])) if groups else [()] * len(key)
            place: dict[tuple, int] = {}
            member = np.fromiter((place.setdefault(g, len(place)) for g in group), np.int64, len(group))
            order = np.lexsort((member, key // ROWS_AT_ONCE))
            for rows in np.split(order, np.flatnonzero(np.diff(key[order] // ROWS_AT_ONCE)) + 1):
                if len(rows):
                    first = key[rows[0]] // ROWS_AT_ONCE * ROWS_AT_ONCE
                    weights = weight_of[draws(keys[first : first + ROWS_AT_ONCE])]
                    for own in np.split(rows, np.flatnonzero(np.diff(member[rows])) + 1):
                        g = group[own[0]]
                        for at in range(0, len(own), ROWS_AT_ONCE):
                            part = own[at : at + ROWS_AT_ONCE]
                            total = weights[key[part] - first].T @ values[part]
                            sums[g] = sums[g] + total if g in sums else total
        yield from _total_batches(sums, replicates, names, schema)

    return run


def _total_batches(sums: dict[tuple, np.ndarray], replicates: int, names: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for g, total in sums.items():
        columns = [pa.array([x] * replicates, t.type) for x, t in zip(g, schema)]
        columns.append(pa.array(np.arange(replicates, dtype=np.int32)))
        columns += [pa.array(total[:, k].round().astype(np.int64)) for k in range(len(names))]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _partial_totals(replicates: int, seed: int | str, groups: list[str], names: list[str], schema: pa.Schema):
    """Weighted totals of a task's rows: one row per group and replicate leaves the task, however many rows it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight_of = np.searchsorted(POISSON_CUTS, np.arange(65536), side="right").astype(np.float64)
        (slopes, intercepts), sums = lines(replicates, seed), {}
        for batch in batches:
            hashes = batch.column("_hash").to_numpy()
            values = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in names], axis=1)
            group = list(zip(*[batch.column(g).to_pylist() for g in groups])) if groups else [()] * len(hashes)
            place: dict[tuple, int] = {}
            member = np.fromiter((place.setdefault(g, len(place)) for g in group), np.int64, len(group))
            order = np.argsort(member, kind="stable")
            for g, own in zip(place, np.split(order, np.searchsorted(member[order], np.arange(1, len(place))))):
                for at in range(0, len(own), ROWS_AT_ONCE):
                    rows = own[at : at + ROWS_AT_ONCE]
                    total = poisson_weights(hashes[rows], slopes, intercepts, weight_of).T @ values[rows]
                    sums[g] = sums[g] + total if g in sums else total
        yield from _total_batches(sums, replicates, names, schema)

    return run


def bootstrap_totals(
    df: DataFrame, key: str, replicates: int, totals: Mapping[str, Column], seed: int | str = "boot", by: Sequence[str] = (), linear: bool = False
) -> DataFrame:
    """Weighted totals per replicate (and per group of ``by``, of which there should be few).

    Weights are drawn and summed inside the tasks, a block of keys at a time; rows are never copied. Every key and replicate has a draw of its own.
    With ``linear`` the JVM hashes each key once and the weights of all replicates follow from that hash by one linear function each: quicker, but the
    weights of a replicate are then only pairwise independent, and keys with equal 31-bit hashes share theirs.
    """
    name, drawn = ("_hash", (hash_long(seed, key) % F.lit(PRIME)).cast("bigint")) if linear else ("_key", F.col(key).cast("string"))
    work = df.select(*by, drawn.alias(name), *[F.coalesce(e.cast("bigint"), F.lit(0)).alias(n) for n, e in totals.items()])
    spark_schema = T.StructType([work.schema[g] for g in by]).add("replicate", "integer")
    for n in totals:
        spark_schema = spark_schema.add(n, "long")
    partial = _partial_totals if linear else _drawn_totals
    rows = work.mapInArrow(partial(replicates, seed, list(by), list(totals), to_arrow_schema(spark_schema)), spark_schema)
    return rows.groupBy(*by, "replicate").agg(*[F.sum(n).alias(n) for n in totals])


def cluster_totals(df: DataFrame, entity: str, replicates: int, totals: Mapping[str, Column], seed: int | str = "boot") -> DataFrame:
    """The same with whole entities drawn: rows collapse to entities before they are copied."""
    entities = df.groupBy(entity).agg(*[F.sum(e.cast("bigint")).alias(n) for n, e in totals.items()])
    return bootstrap_totals(entities, entity, replicates, {n: F.col(n) for n in totals}, seed)


def percentile_interval(samples: DataFrame, columns: Sequence[str], level: float = 0.95) -> DataFrame:
    """(metric, low, mean, high) over the replicate table."""
    tail = (1 - level) / 2
    tidy = samples.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "metric", "value")
    return tidy.groupBy("metric").agg(
        F.count("value").alias("replicates"),
        r6(F.percentile("value", F.lit(tail))).alias("low"),
        r6(F.avg("value")).alias("mean"),
        r6(F.percentile("value", F.lit(1 - tail))).alias("high"),
    )
