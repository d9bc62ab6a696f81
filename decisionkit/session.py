"""Session helpers for local runs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_FOLDERS: dict[str, str] = {}  # application id -> temporary folder, local runs only


def local_session(cpus: int | str = 8, app: str = "decisionkit", **extra: str) -> SparkSession:
    """A local session; on a cluster the submitter's own settings are used instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus if str(cpus).isdigit() else 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``; only a local run may go without it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="decisionkit-")
        root = _LOCAL_FOLDERS[app]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a narrow intermediate table once and read it back.

    For operators that pass over the same rows several times: later passes scan columns of a finished
    table, the plan stays small, and a lost executor costs at most its own tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
