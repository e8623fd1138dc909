"""Incremental ingest of newly arrived CSV files as a Structured Stream.

The file source remembers which files it has processed (its checkpoint is
the new-file ledger), ``trigger(availableNow=True)`` drains everything that
has arrived and stops - the hourly micro-batch - and ``foreachBatch`` runs
the same set-based load as the batch path on every micro-batch.  There is no
watermark: late records are accepted without bound and the incremental
rollup refresh recomputes every month they touch.

The stream carries text lines, so every micro-batch goes through the same
structural checks and by-name columns as the batch path: a file is the unit of
a file stream, and all its lines are in one micro-batch.  Invalid files go to
the ledger with their reason and are not loaded.

Each micro-batch is loaded exactly once: its epoch is part of the warehouse's
commit, under the name of the stream (its checkpoint).  A stream that stops
between the commit and its own checkpoint runs the epoch again, and the load is
skipped.  Files that the ledger has as loaded, by a batch for instance, are left out.

Disk holds one micro-batch's work: its staged rows, caches and shuffles go before
the next begins, and on request the folders that a later commit has replaced.
"""

from __future__ import annotations

import gc

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.warehouse import Warehouse
from ..sources.csv_drop import LINE_COLUMNS, _headers, file_checks, file_path, parse_width, records, text_lines


def line_stream(spark: SparkSession, raw_glob: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Arriving CSV files as lines: value, _path, _block."""
    reader = spark.readStream.option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(raw_glob).select(
        "value", file_path().alias("_path"), F.col("_metadata.file_block_start").alias("_block"))


def ingest(spark: SparkSession, root: str, raw_glob: str, wh: Warehouse, checkpoint: str,
           max_files_per_trigger: int | None = None, keep_commits: int | None = None) -> list[int]:
    """Drain all arrived files into ``wh``; returns the micro-batch ids run.
    ``keep_commits``: how many of the last commits can be read after each
    micro-batch; folders that only earlier ones name are deleted.  Default: all."""
    epochs: list[int] = []

    def load(batch: DataFrame, epoch_id: int) -> None:
        load_batch(batch, epoch_id)
        # what was cached has shuffles of its own, which the cleaner drops once a collection finds them unused
        gc.collect()
        spark._jvm.System.gc()
        epochs.append(epoch_id)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        # row ids are fixed here, inside the batch, where a non-streaming plan allows them
        lines = text_lines(batch, root).select(*LINE_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
        headers = _headers(lines).checkpoint(eager=True)  # these two have one row per file
        width = parse_width(headers)
        checks = file_checks(lines, width=width, headers=headers).checkpoint(eager=True)
        report = wh.load(records(lines, checks, width), refresh="incremental", invalid=checks.filter(F.col("status") == "invalid"),
                         only_new=True, stream=(checkpoint, epoch_id))
        if report:
            report.release()
        lines.unpersist()
        if report and keep_commits:
            wh.vacuum(keep_commits, superseded=True)

    q = (line_stream(spark, raw_glob, max_files_per_trigger).writeStream
         .foreachBatch(load).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return epochs
