"""CSV and JSON sources and sinks, versioned prediction tables, and the scratch folder they use."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import encode_target, prepare_precontact

CONTACT_CSV_SCHEMA = T.StructType(
    [
        T.StructField("contact_id", T.LongType()),
        T.StructField("age", T.LongType()),
        T.StructField("job", T.StringType()),
        T.StructField("balance", T.DoubleType()),
        T.StructField("contact", T.StringType()),
        T.StructField("day", T.LongType()),
        T.StructField("month", T.LongType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("campaign", T.LongType()),
        T.StructField("pdays", T.LongType()),
        T.StructField("previous", T.LongType()),
        T.StructField("poutcome", T.StringType()),
        T.StructField("y", T.StringType()),
    ]
)


def read_contacts_csv(spark: SparkSession, path: str, include_duration: bool = False, schema: T.StructType = CONTACT_CSV_SCHEMA) -> DataFrame:
    """Semicolon-separated contacts with a declared schema; leakage columns are dropped unless asked for."""
    raw = spark.read.schema(schema).option("sep", ";").option("header", True).option("mode", "FAILFAST").csv(path)
    raw = raw.withColumn("y", encode_target("y"))
    return raw if include_duration else prepare_precontact(raw)


def write_contacts_csv(df: DataFrame, path: str) -> None:
    columns = CONTACT_CSV_SCHEMA.fieldNames()
    text = df.withColumn("y", F.when(F.col("y") == 1, "yes").otherwise("no"))
    text.select(*columns).write.option("sep", ";").option("header", True).csv(path)


CHUNK = 8 << 20  # bytes a leaf covers
FAN = 1024  # children of a node: 64 kB of hex digests


def _leaves(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Digests of byte ranges, read in slices of at most 1 MB: memory does not depend on the chunk or the file."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, last, source = [], None, None
            for path, chunk in zip(batch.column("path").to_pylist(), batch.column("chunk").to_pylist()):
                if path != last:  # chunks of a file come together
                    if source:
                        source.close()
                    system, name = pafs.FileSystem.from_uri(quote(path, safe="/:@=,"))  # Spark gives paths as they are
                    last, source = path, system.open_input_file(name)
                leaf, at = hashlib.sha256(), chunk * size
                end = min(at + size, source.size())
                while at < end:
                    part = source.read_at(min(end - at, 1 << 20), at)
                    if not part:
                        raise OSError(f"{path} became shorter while it was read")
                    leaf.update(part)
                    at += len(part)
                found.append(leaf.hexdigest())
            if source:
                source.close()
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("chunk"), pa.array(found, pa.string())], names=["path", "chunk", "digest"])

    return digest


def file_digests(spark: SparkSession, path: str, chunk: int = CHUNK, fan: int = FAN, tasks: int | None = None) -> DataFrame:
    """(path, bytes, chunks, root): a hash tree over the chunks of each file below a path, so a file of any size is read by many tasks.

    A leaf is the SHA-256 of a chunk's bytes, a node that of "node" and its children's hex digests, ``fan`` consecutive ones; levels follow until one is left,
    which is the root. Spark lists no empty files, so these have no row. The root depends on the bytes, ``chunk`` and ``fan`` only, not on ``tasks`` (by default
    one for each 128 MB). Files are listed without their content, and their ranges opened by the executors, so the path needs a file system
    that Arrow can read in place (a shared folder, HDFS, S3, GCS). A level keeps one row per node; none if there are no files.
    """
    if chunk < 1 or fan < 2:
        raise ValueError("a chunk needs a byte and a node two children")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"))
    files = files.withColumn("chunks", F.greatest(F.ceil(F.col("bytes") / chunk), F.lit(1)).cast("bigint"))
    size = files.agg(F.sum("bytes").alias("bytes"), F.max("chunks").alias("chunks")).first()
    tasks = tasks or max(1, -(-(size["bytes"] or 0) // (128 << 20)))
    ranges = files.select("path", F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("bigint"))).alias("chunk"))
    ranges = ranges.repartitionByRange(tasks, "path", "chunk").sortWithinPartitions("path", "chunk")
    nodes = ranges.mapInArrow(_leaves(chunk), "path string, chunk bigint, digest string")
    left = size["chunks"] or 1
    while left > 1:  # a file's single node passes the further levels unchanged
        up = F.floor(F.col("chunk") / fan).alias("chunk")
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "digest"))), lambda x: x["digest"])  # at most fan
        alone = F.col("chunks") == 1
        level = nodes.join(files.select("path", "chunks"), "path") if "chunks" not in nodes.columns else nodes
        nodes = level.groupBy("path", up, "chunks").agg(ordered.alias("below")).select(
            "path", "chunk", F.ceil(F.col("chunks") / fan).alias("chunks"),
            F.when(alone, F.col("below")[0]).otherwise(F.sha2(F.concat(F.lit("node"), F.array_join("below", "")), 256)).alias("digest"),
        )
        left = -(-left // fan)
    return files.join(nodes.select("path", F.col("digest").alias("root")), "path")


def row_text(columns: list[Column]) -> Column:
    return F.concat_ws("␟", *[F.coalesce(c.cast("string"), F.lit("∅")) for c in columns])


def table_fingerprint(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Row count and an order-independent sum of row digests: equal tables give equal rows."""
    digest = F.sha2(row_text(columns), 256)
    prefix = F.conv(F.substring(digest, 1, 13), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(prefix).cast("string").alias("fingerprint"))


def write_report(df: DataFrame, path: str) -> None:
    """Run metadata as JSON lines with sorted keys."""
    df.select(*sorted(df.columns)).write.json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """Append scored rows by model version and score date; a version's files are never rewritten.

    Rows are first gathered by partition value and hash, so a day becomes a bounded number of files.
    """
    spread = df.repartition("model_version", "score_date", F.pmod(F.hash("prediction_id"), F.lit(16)))
    spread.write.mode("append").partitionBy("model_version", "score_date").parquet(path)
