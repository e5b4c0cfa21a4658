"""Incremental landing of a CSV drop folder with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rosterlens.sources.csv_landing import BATCH, STATUS, read_profile_csv


def land_csv_stream(spark: SparkSession, src_dir: str, out: str, checkpoint: str, columns: Sequence[str],
                    key: str = "char_id", max_files_per_trigger: int | None = None) -> int:
    """Land every CSV file in ``src_dir`` not landed before, then stop.

    Runs as ``trigger(availableNow=True)``: all files present at the start,
    in micro-batches (file log + commit log in ``checkpoint``, which must be on
    shared storage). Each batch is flagged like the batch landing and written
    to a folder of its own under ``out``; a batch that runs again after a crash
    overwrites that folder, so its rows are there once. ``src_ord`` is (batch,
    file, row), so later versions land after earlier ones. Files go by their own
    headers: a column of ``columns`` that a file lacks is null there. Returns the
    number of batches run.
    """
    # the stream only names the files (no content is read); each batch is then
    # scanned like a batch landing, every file by its own header
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    source = stream.load(src_dir).select("path")

    ran: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.orderBy("path").toLocalIterator()]
        rows = read_profile_csv(batch.sparkSession, paths, columns, key, batch_id)
        rows.write.mode("overwrite").partitionBy(STATUS).parquet(f"{out.rstrip('/')}/{BATCH}={batch_id}")
        ran.append(batch_id)

    query = (
        source.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(ran)
