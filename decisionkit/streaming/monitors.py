"""Structured Streaming monitors. Each one takes a streaming frame and works on any source.

Event time must be TIMESTAMP; outputs carry plain dates or TIMESTAMP_NTZ so that batch twins compare equal.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalars import r6, ratio
from ..operators.contracts import Rule, quarantine
from ..operators.drift import FLOOR, psi_of, status
from ..operators.quantiles import bin_left_closed
from ..session import staged
from ..sources.versions import VersionedTable


def event_stream(spark: SparkSession, path: str, schema, time: str = "ts", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn(time, F.col(time).cast("timestamp"))


def drain(query_writer, checkpoint: str) -> None:
    """Run a streaming query over everything that is there and stop."""
    running = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()


ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # counting the rows costs a look-up per write, and only progress reports show the count
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB on local disk, not on the heap, and checkpoint only what changed. A stream
    reads these settings once, when it starts; a checkpoint begun with them must go on with them."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_rows(spark: SparkSession, checkpoint: str, **options: str) -> DataFrame:
    """What a stopped stream holds in its state, read from its checkpoint."""
    return spark.read.format("statestore").options(**options).load(checkpoint)


def to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append-mode file sink: exactly once, and readable as a table."""
    drain(stream.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint)


def gate(stream: DataFrame, rules: Sequence[Rule], accepted: str, rejected: str, checkpoint: str) -> None:
    """Contract gate per micro-batch. A repeated batch overwrites its own folder, so rows appear once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = quarantine(batch, rules)
        good.write.mode("overwrite").parquet(f"{accepted}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")

    drain(stream.writeStream.foreachBatch(write), checkpoint)


def volume_monitor(stream: DataFrame, time: str, by: Sequence[str], decision: Column, missing: Column, delay: str, window: str = "1 day") -> DataFrame:
    """Volume, decision rate and missing rate per tumbling window."""
    n = F.count(F.lit(1))
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, window), *by)
        .agg(n.alias("volume"), r6(ratio(F.count_if(decision), n)).alias("decision_rate"), r6(ratio(F.count_if(missing), n)).alias("missing_rate"))
        .select(F.col("window.start").cast("date").alias("window_start"), *by, "volume", "decision_rate", "missing_rate")
    )


def bin_counts(stream: DataFrame, time: str, value: str, edges: Sequence[float], delay: str, window: str, slide: str) -> DataFrame:
    """Counts per sliding window and reference bin: the state of a drift signal. Partial counts merge, so a window costs one row per bin."""
    cuts = F.array(*[F.lit(float(e)) for e in edges])
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, window, slide), bin_left_closed(F.col(value), cuts).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").cast("date").alias("window_start"), "bin", "n")
    )


def window_drift(counts: DataFrame, reference: DataFrame) -> DataFrame:
    """(window_start, volume, psi, status) of counts (window_start, bin, n) against reference shares (bin, p); a bin without rows counts as empty."""
    bins = counts.groupBy("window_start").agg(F.sum("n").alias("volume"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("per_bin"))  # at most one entry a bin
    shares = reference.agg(F.map_from_entries(F.collect_list(F.struct("bin", "p"))).alias("p")).scalar()
    rows = bins.withColumn("p", shares).select("window_start", "volume", "per_bin", F.explode("p").alias("bin", "p"))
    q = F.greatest(F.coalesce(F.try_element_at("per_bin", F.col("bin")), F.lit(0)) / F.col("volume"), F.lit(FLOOR))
    table = rows.withColumn("q", q).groupBy("window_start").agg(F.max("volume").alias("volume"), r6(psi_of(F.col("p"), F.col("q"))).alias("psi"))
    return table.withColumn("status", status(F.col("psi")))


def drift_monitor(stream: DataFrame, reference: DataFrame, time: str, value: str, edges: Sequence[float], delay: str, window: str, slide: str, path: str, checkpoint: str) -> None:
    """Writes the drift status of each sliding window when the watermark closes it, from inside the stream. All bins of a window close in
    one micro-batch; a repeated batch overwrites its own folder. ``edges`` that repeat count once. ``reference`` holds the reference values."""
    cuts = sorted(set(edges))
    known = F.array(*[F.lit(float(e)) for e in cuts])
    per_bin = reference.groupBy(bin_left_closed(F.col(value), known).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = reference.sparkSession.range(len(cuts) - 1).select(F.col("id").cast("int").alias("bin")).join(per_bin.withColumn("bin", F.col("bin").cast("int")), "bin", "left")
    total = per_bin.agg(F.sum("n")).scalar()
    shares = staged(every.select("bin", F.greatest(F.coalesce("n", F.lit(0)) / total, F.lit(FLOOR)).alias("p")), "reference")

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            window_drift(batch.withColumn("bin", F.col("bin").cast("int")), shares).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    drain(bin_counts(stream, time, value, cuts, delay, window, slide).writeStream.outputMode("append").foreachBatch(write), checkpoint)


def delayed_labels(predictions: DataFrame, labels: DataFrame, key: str, delay: str, horizon: str) -> DataFrame:
    """Predictions with the labels that arrive within the horizon; unmatched ones follow once it has passed."""
    left = predictions.withWatermark("predicted_at", delay)
    right = labels.withColumnRenamed(key, "_label_key").withWatermark("labelled_at", delay)
    on = (F.col(key) == F.col("_label_key")) & F.expr(
        f"labelled_at >= predicted_at AND labelled_at <= predicted_at + INTERVAL {horizon}"
    )
    return left.join(right, on, "leftOuter").drop("_label_key")


def label_log(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append every label, late or not, with the batch that brought it; nothing is dropped by a watermark."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("arrival", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    drain(stream.writeStream.foreachBatch(write), checkpoint)


def upsert_stream(stream: DataFrame, table: VersionedTable, checkpoint: str) -> None:
    """Each micro-batch is one load, named by its checkpoint and number: a batch that is run again after a failure is taken in once."""
    drain(stream.writeStream.foreachBatch(lambda batch, batch_id: table.upsert(batch, f"{checkpoint}#{batch_id}")), checkpoint)


def latest_labels(log: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The newest version of each label: a backfill only adds rows, so readers never see a half-made rewrite."""
    newest = F.max(F.struct("arrival", *columns))
    return log.groupBy(key).agg(newest.alias("_n")).select(key, *[F.col(f"_n.{c}").alias(c) for c in columns])


def deduplicated(stream: DataFrame, time: str, keys: Sequence[str], delay: str) -> DataFrame:
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


class BreachRuns(StatefulProcessor):
    """Runs of consecutive breaches of one signal. A step waits in map state until the watermark passes it, so steps may arrive in any order; a timer
    per step closes it, and an idle timer empties the state of a signal that sends nothing more."""

    def __init__(self, signal: str, step: str, breach: str, idle_ms: int):
        self.signal, self.step, self.breach, self.idle_ms = signal, step, breach, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "at bigint", "breach boolean")
        self.run = handle.getValueState("run", "length bigint, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            at = batch[self.step].astype("datetime64[ms]").astype("int64")
            for t, hit in zip(at, batch[self.breach]):
                if not self.pending.containsKey((int(t),)):
                    self.handle.registerTimer(int(t))
                self.pending.updateValue((int(t),), (bool(hit),))
        return iter(())  # steps are answered when their timer fires

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        length, last = self.run.get() if self.run.exists() else (0, None)
        closed, runs = sorted((at, hit) for (at,), (hit,) in self.pending.iterator() if at <= now), []
        for at, hit in closed:
            length, last = (length + 1 if hit else 0), at
            runs.append(length)
            self.pending.removeKey((at,))
        if closed:
            self.run.update((length, last))
            self.handle.registerTimer(last + self.idle_ms)
        elif last is not None and now >= last + self.idle_ms:
            self.run.clear()
        if not closed:
            return iter(())
        steps = pd.to_datetime([at for at, _ in closed], unit="ms")
        return iter([pd.DataFrame({self.signal: [key[0]] * len(closed), self.step: steps, "run_length": runs})])


def sustained_alerts(stream: DataFrame, signal: str, step: str, breach: str, delay: str, idle: timedelta = timedelta(days=90)) -> DataFrame:
    """(signal, step, run_length): consecutive breaches per signal in event-time order, for the steps that the watermark has passed.

    ``step`` is a timestamp; steps may come ``delay`` late and in any order. A signal without steps for ``idle`` leaves the state, and starts anew. Runs on
    RocksDB state: start it inside ``rocksdb_state``.
    """
    rows = stream.withWatermark(step, delay).groupBy(signal)
    processor = BreachRuns(signal, step, breach, int(idle.total_seconds() * 1000))
    return rows.transformWithStateInPandas(processor, f"{signal} string, {step} timestamp, run_length bigint", "Append", "EventTime")


def session_pressure(stream: DataFrame, time: str, by: str, gap: str, delay: str) -> DataFrame:
    """Contacts per session of an entity, and how densely they follow each other."""
    minutes = (F.unix_micros(F.col("last")) - F.unix_micros(F.col("first"))) / 60e6
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.session_window(time, gap), by)
        .agg(F.count(F.lit(1)).alias("contacts"), F.min(time).alias("first"), F.max(time).alias("last"))
        .select(
            by, "contacts", F.col("first").cast("timestamp_ntz").alias("first_contact"),
            r6(F.col("contacts") / (1.0 + minutes)).alias("pressure"),
        )
    )
