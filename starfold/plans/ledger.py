"""Ledger-driven operations: what was loaded, what to archive, what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.listing import with_state
from .warehouse import Warehouse

RAW_PREFIX, ARCHIVE_PREFIX = "raw/", "archive/"


def successful_files(wh: Warehouse) -> DataFrame:
    return wh.table("pipeline_runs").filter(F.col("status") == "success").select("source_file").distinct()


def unprocessed_files(listing: DataFrame, wh: Warehouse) -> DataFrame:
    """Files in a listing with no successful load in the ledger (the
    documented new-file rule); failed files stay eligible for retry."""
    return listing.select("source_file").distinct().join(successful_files(wh), "source_file", "left_anti")


def file_states(listing: DataFrame, wh: Warehouse) -> DataFrame:
    """The listing with ``state``: new (no successful load in the ledger), known, or
    changed (loaded, with another length or time of modification then)."""
    latest = F.max_by(F.struct("length", "modified"), "run_date")
    loaded = wh.table("loaded_files").groupBy("source_file").agg(latest.alias("_at"))
    return with_state(listing, loaded.select("source_file", "_at.length", "_at.modified"), successful_files(wh))


def archive_plan(verdicts: DataFrame) -> DataFrame:
    """Where each successfully loaded file goes: every ``raw/`` in the key
    becomes ``archive/``.  Only successes move; failures stay for retry."""
    ok = verdicts.filter(F.col("status") == "success")
    return ok.select("source_file",
                     F.replace(F.col("source_file"), F.lit(RAW_PREFIX), F.lit(ARCHIVE_PREFIX)).alias("archive_key"),
                     F.col("n_records").alias("rows"))


def archive_lines(lines: DataFrame) -> DataFrame:
    """Raw lines under their file's archive key."""
    key = F.replace(F.col("source_file"), F.lit(RAW_PREFIX), F.lit(ARCHIVE_PREFIX))
    return lines.select("source_file", key.alias("archive_key"), "block", "row", "line")


def refresh_needed(runs: DataFrame) -> DataFrame:
    return runs.agg(F.coalesce(F.bool_or(F.col("status") == "success"), F.lit(False)).alias("refresh_needed"))


def runs_success_count(wh: Warehouse) -> DataFrame:
    return wh.table("pipeline_runs").filter(F.col("status") == "success").agg(
        F.count(F.lit(1)).alias("success_runs"))


def pipeline_runs_log(wh: Warehouse) -> DataFrame:
    return wh.table("pipeline_runs").select("source_file", "rows_loaded", "status")


def surrogate_keys(wh: Warehouse) -> DataFrame:
    """Ids are dense and one per natural key: per table, rows, distinct ids,
    distinct natural keys, smallest and largest id."""
    def stats(name, id_col, key_col):
        t = wh.table(name)
        return t.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                     F.countDistinct(id_col).alias("n_ids"), F.countDistinct(key_col).alias("n_keys"),
                     F.min(id_col).cast("long").alias("min_id"), F.max(id_col).cast("long").alias("max_id"))
    return (stats("dim_customers", "customer_id", "email")
            .unionByName(stats("fact_sales", "sale_id", "order_id"))
            .unionByName(stats("pipeline_runs", "run_id", "source_file")))
