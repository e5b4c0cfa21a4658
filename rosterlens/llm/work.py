"""Shared folder, code shipping, task memory and materialised tables for the operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()
KEPT: dict = {}  # objects that a worker process keeps from task to task
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def release() -> None:
    """Give the memory that this worker has freed back to the system: allocators
    hold it else, and a worker lives through the tasks of many operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def forget() -> None:
    """Drop what this worker keeps (by name: a function shipped by value has globals of its own)."""
    KEPT.clear()


def lean(run, keeps: bool = False):
    """``run`` for mapInArrow, its memory released when the task ends. What other
    operators' tasks left in the worker goes before, unless ``run`` ``keeps`` it for its own."""
    def task(batches):
        if not keeps:
            forget()
        try:
            yield from run(batches)
        finally:
            release()
    return task


def lean_group(run):
    """``run`` for applyInArrow, its memory released after each group."""
    def task(table: pa.Table) -> pa.Table:
        forget()
        try:
            return run(table)
        finally:
            release()
    return task


def ship_code(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application,
    and bound the bytes of an Arrow batch where the session does not: rows of
    long texts would else make batches of tens of megabytes, held several times
    by the executor and its workers."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(8 << 20))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="rosterlens-code-"), "rosterlens_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage
    ends there, and lost executors only cost the tasks they were running. The
    shuffle files of the write go with its end, not when the driver happens to
    collect its garbage."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_path = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``keep`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.kept_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def carried(docs: DataFrame, **columns) -> DataFrame:
    """The rows of ``docs`` as one column ``row``, beside ``columns``: whatever
    the input's columns are called, none clashes with a helper column. The way
    back is ``select("row.*")``."""
    return docs.select(F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias("row"),
                       *(c.alias(name) for name, c in columns.items()))
