"""Incremental, restartable conversion of daily CSV files into the lake.

New yearly / daily files dropped into the archive folder are picked up
by a file-stream source; each micro-batch is written by the lake's own
writer (same schema, clustering and file sizes) as a batch of its own.
The checkpoint (in the shared folder) records which files were read.  A
batch that is run again after a failure replaces its own partitions, so
no file is skipped or doubled.  ``availableNow`` processes everything
present, in bounded micro-batches, then stops: the same code serves a
nightly batch and a live stream.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from stratus.layouts import DAILY_DATE_FORMAT, DAILY_SCHEMA
from stratus.sources.lake import write_observation_lake
from stratus.streaming.rollup import add_delivery


def batch_name(checkpoint_dir: str, batch_id: int) -> str:
    """A batch's name: streams with checkpoints of their own have batches of their own."""
    return f"{hashlib.sha256(checkpoint_dir.rstrip('/').encode()).hexdigest()[:12]}-{batch_id}"


def ingest_batch(rows: DataFrame, lake_dir: str, batch: str, rollup_dir: str | None = None) -> None:
    """Write one batch to the lake, and its country-year states to the rollup; the same batch again replaces both."""
    write_observation_lake(rows, lake_dir, batch=batch)
    if rollup_dir:
        add_delivery(rows, rollup_dir, batch)


def ingest_daily_stream(
    spark: SparkSession,
    source_dir: str,
    lake_dir: str,
    checkpoint_dir: str,
    max_files_per_trigger: int = 64,
    wait: bool = True,
    rollup_dir: str | None = None,
):
    """Stream ``source_dir`` (gzip CSV, archive format) into ``lake_dir``.

    Batches are named after the checkpoint folder, so streams with
    checkpoints of their own can feed one lake.  With ``rollup_dir`` each
    batch also leaves its country-year states there (``streaming.rollup``);
    a batch that runs again replaces both.
    """
    stream = (
        spark.readStream.schema(DAILY_SCHEMA)
        .option("header", "false")
        .option("dateFormat", DAILY_DATE_FORMAT)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(source_dir)
    )

    def write(rows: DataFrame, batch_id: int) -> None:
        ingest_batch(rows, lake_dir, batch_name(checkpoint_dir, batch_id), rollup_dir)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
