"""What the operators of this subpackage share: reading, row keys, safe column names, staged tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionkit.session import scratch_path, staged

__all__ = ["ascii_lower", "filled", "read", "row_key", "rows_of", "scratch_path", "sliced", "small_batches", "staged", "target_partitions"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def filled(text: Column) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def row_key(text: Column) -> Column:
    """A second key beside the id: rows that share an id but not the text stay apart, repeated rows fall together."""
    return F.sha2(F.encode(filled(text), "UTF-8"), 256)


def rows_of(docs: DataFrame, key: str, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, ``key``) stands in ``kept``, each distinct row once, with all its columns.

    ``key`` names a column of ``docs`` and of ``kept``. Ids compare null-safe.
    """
    # one column that is never null, so that the join's partitioning also serves the removal of repeated rows
    one = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(key))
    ids = kept.select(one.alias("__keep")).distinct()
    rows = docs.withColumn("__row", one)
    return rows.join(ids, rows["__row"] == ids["__keep"], "left_semi").dropDuplicates(["__row"]).drop(key, "__row")


def sliced(batch: pa.RecordBatch, column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A record batch in slices of about ``most`` bytes of ``column``, so that what a task builds from it and passes on stays small."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype("int64")
    part = sizes.cumsum() // most
    at = 0
    while at < batch.num_rows:
        end = int(part.searchsorted(part[at], side="right"))
        yield batch.slice(at, end - at)
        at = end


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Tables written inside pass their rows to Python by ``rows`` at most, so that neither side holds large buffers of texts. Only the number of
    rows at a time changes."""
    before, given = spark.conf.get(BATCH_ROWS, None), int(spark.conf.get(BATCH_ROWS, "0"))
    spark.conf.set(BATCH_ROWS, str(min(given, rows) if given > 0 else rows))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_ROWS) if before is None else spark.conf.set(BATCH_ROWS, before)


def target_partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
