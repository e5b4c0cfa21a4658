"""Session helpers: a configured local session for tests and benches, and the
checkpoint directory that dense keys need."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


def build_session(master: str | None = "local[*]", partitions: int = 8, app: str = "rosterlens") -> SparkSession:
    """A session with the settings this project relies on (UTC, ANSI, AQE).

    ``master=None`` keeps the master given by spark-submit (falling back to
    local mode only when none is set). On a cluster, size ``partitions`` to
    the data (about 128-256 MB per shuffle partition).
    """
    builder = SparkSession.builder
    if master or not SparkConf().contains("spark.master"):
        builder = builder.master(master or "local[*]")
    builder = (
        builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.ansi.enabled", "true")
        # Checkpoint files whose DataFrame is gone are removed by Spark's cleaner.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("ROSTERLENS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Timestamps in this project are UTC (the reference parses with utc=True)."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory.

    Order: the directory already set on the SparkContext, then the session's
    ``spark.checkpoint.dir``. Only a local-mode session with neither gets a
    fresh folder of its own; a cluster session without one is an error, since a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rosterlens-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


@contextmanager
def sized(spark: SparkSession, rows: int | None, task_rows: int):
    """What is planned and run within exchanges its rows to one partition for each
    ``task_rows`` of ``rows``, which are not merged again: what a task sorts or
    hashes does not grow with the input. Without ``rows``, as the session has it."""
    if rows is None:
        yield
        return
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows // task_rows))
    conf = {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the checkpoint directory and read
    back: later passes read only their columns, and a lost executor costs only
    the tasks it was running."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kept-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
