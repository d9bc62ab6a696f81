"""Deterministic pseudo-random order and draws that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32


def _text(seed: int | str, keys: tuple[str | Column, ...]) -> Column:
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])


def hex_digest(seed: int | str, *keys: str | Column) -> Column:
    return F.md5(_text(seed, keys))


def hex_slice(digest: Column, start: int, digits: int) -> Column:
    """``digits`` hex digits of a digest (1-based start) as BIGINT."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def hash_order(seed: int | str, *keys: str | Column) -> Column:
    """A 32-bit hash as BIGINT: the order used for splits, samples and permutations."""
    return hex_slice(hex_digest(seed, *keys), 1, 8)


def hash_long(seed: int | str, *keys: str | Column) -> Column:
    """A 60-bit hash as BIGINT, for draws among more than 2^32 ranks."""
    return hex_slice(hex_digest(seed, *keys), 1, 15)


def hash_fraction(seed: int | str, *keys: str | Column) -> Column:
    """A uniform draw in [0, 1) with all 52 bits a double holds."""
    return hex_slice(hex_digest(seed, *keys), 1, 13) / F.lit(float(2**52))


def hash_unit(seed: int | str, *keys: str | Column) -> Column:
    """A uniform draw in [0, 1) from the same hash."""
    return hash_order(seed, *keys) / F.lit(float(2**HASH_BITS))


def hash_bucket(h: Column, bits: int = 16) -> Column:
    """The leading ``bits`` of a 32-bit hash: a monotone bucket of the hash order."""
    return F.shiftright(h, HASH_BITS - bits)
