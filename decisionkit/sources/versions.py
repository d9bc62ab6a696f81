"""Versioned upserts of a keyed table: loads add files, a manifest names the files of each version, compaction switches in one step.

``<root>/files/<folder>`` holds rows, written before any manifest names them; ``<root>/versions/<n>`` is a small JSON manifest that lists the
folders of version n, oldest first, each with the load that brought it and its place in the order of arrival. A manifest is written aside and renamed to its name, which fails if the name is taken, so
a version is there whole or not at all, a job that dies leaves the old version readable, and of two writers one gets the number; the other starts again from
the newer version. Renames are one step on HDFS and shared folders; object stores need a committer that gives the same promise.

A version is read as the newest row of each key: the folders are a log, and a reader merges them. Compaction writes that merge
as one folder; what earlier versions name stays until ``expire``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARRIVAL = "_arrival"


@dataclass(frozen=True)
class Part:
    folder: str
    load: str  # "" after compaction
    rows: int
    digest: str  # of the rows, in any order


class Conflict(Exception):
    """Another writer took the version number."""


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, key: str, columns: Sequence[str]):
        self.spark, self.root, self.key, self.columns = spark, root.rstrip("/"), key, list(columns)
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, version: int) -> tuple[list[Part], list[str]]:
        """The parts of a version and the loads that any version up to it has taken in; version 0 is empty."""
        if version == 0:
            return [], []
        stream = self._fs.open(self._path(f"{self.root}/versions/{version}"))
        try:
            text = stream.readAllBytes().decode()
        finally:
            stream.close()
        found = json.loads(text)
        return [Part(**p) for p in found["parts"]], found["loads"]

    def latest(self) -> int:
        return max(self.versions(), default=0)

    def _switch(self, version: int, parts: list[Part], loads: list[str]) -> int:
        aside = self._path(f"{self.root}/versions/_{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps({"parts": [asdict(p) for p in parts], "loads": loads}, sort_keys=True).encode()))
        finally:
            out.close()
        try:
            self._files.rename(aside, self._path(f"{self.root}/versions/{version}"), self._no_options)
        except Py4JJavaError as e:
            self._fs.delete(aside, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise Conflict(f"version {version} is taken") from e
            raise
        return version

    def _write(self, rows: DataFrame, load: str) -> Part:
        folder = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/files/{folder}")
        n, digest = _contents(self._read([folder], rows), [self.key, *self.columns])
        return Part(folder, load, n, digest)

    def _read(self, folders: Sequence[str], like: DataFrame | None = None) -> DataFrame:
        reader = self.spark.read.schema(like.schema) if like is not None else self.spark.read
        return reader.parquet(*[f"{self.root}/files/{f}" for f in folders])

    def upsert(self, rows: DataFrame, load: str, attempts: int = 5) -> int:
        """Take in a load and return the version that holds it. A load that is known is not taken in again: the same rows give the version
        there is, other rows are refused. Rows of one load that share a key are ordered by their columns, and the largest stays."""
        rows = rows.select(self.key, *self.columns)
        part: Part | None = None
        for _ in range(attempts):
            now = self.latest()
            parts, loads = self.manifest(now)
            if load in {known.rsplit(":", 2)[0] for known in loads}:
                n, digest = (part.rows, part.digest) if part else _contents(rows, [self.key, *self.columns])
                if f"{load}:{n}:{digest}" not in loads:
                    raise PermissionError(f"load {load} was taken in with other rows")
                return now
            part = part or self._write(rows, load)
            try:
                return self._switch(now + 1, [*parts, part], [*loads, f"{load}:{part.rows}:{part.digest}"])
            except Conflict:
                continue
        raise Conflict(f"load {load}: {attempts} versions were taken by others")

    def read(self, version: int | None = None) -> DataFrame | None:
        """Newest row of each key; None where there is no version yet. One aggregate, combined before the shuffle, so a key of many rows is no burden."""
        version = self.latest() if version is None else version
        parts, _ = self.manifest(version)
        if not parts:
            return None
        place = F.element_at(F.split(F.input_file_name(), "/"), -2)
        order = F.element_at(F.create_map(*[x for i, p in enumerate(parts) for x in (F.lit(p.folder), F.lit(i))]), place)
        log = self._read([p.folder for p in parts]).withColumn(ARRIVAL, order)
        newest = F.max(F.struct(ARRIVAL, *self.columns)).alias("newest")
        return log.groupBy(self.key).agg(newest).select(self.key, *[F.col(f"newest.`{c}`").alias(c) for c in self.columns])

    def compact(self) -> int:
        """A version with the same rows in one folder. If loads arrive meanwhile, they stay behind it in the log."""
        base = self.latest()
        parts, _ = self.manifest(base)
        if len(parts) < 2:
            return base
        merged = self._write(self.read(base), "")
        while True:
            now = self.latest()
            newer, loads = self.manifest(now)
            if newer[: len(parts)] != parts:  # someone else compacted
                return now
            try:
                return self._switch(now + 1, [merged, *newer[len(parts) :]], loads)
            except Conflict:
                continue

    def expire(self, keep: int) -> list[int]:
        """Forget all but the newest ``keep`` versions and the folders only they name. Folders of writers that are still at work are named
        by no version, and are left alone."""
        if keep < 1:
            raise ValueError("one version must stay")
        known = self.versions()
        old, kept = known[:-keep], known[-keep:]
        alive = {p.folder for v in kept for p in self.manifest(v)[0]}
        gone = {p.folder for v in old for p in self.manifest(v)[0]} - alive
        for v in old:
            self._fs.delete(self._path(f"{self.root}/versions/{v}"), False)
        for folder in gone:
            self._fs.delete(self._path(f"{self.root}/files/{folder}"), True)
        return old


def _contents(rows: DataFrame, columns: Sequence[str]) -> tuple[int, str]:
    """Row count and an order-independent sum of row digests."""
    parts = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns]).cast("decimal(20,0)")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(parts), F.lit(0)).cast("string")).first()
    return n, total
