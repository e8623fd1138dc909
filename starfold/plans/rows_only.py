"""Registered keys over CSV files, streams and table versions.  Each reads
the driver tables through a CSV drop that Spark writes from the derived
sales drop.  The CSV scans, the round trip and the structural checks (per
drop folder: file names carry writer ids) also have a SQL statement; arrival
order, run history and the stream are rows-only and covered by tests;
staleness has SQL too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path
from ..sources import csv_drop
from ..sources.sales_drop import REQUIRED_COLUMNS
from ..streaming import file_stream
from . import reports
from .context import Run
from .registry import _on
from .warehouse import Warehouse, monthly_rollup


def _memo(r: Run, name: str, make):
    with r._lock:
        if not hasattr(r, name):
            setattr(r, name, make())
        return getattr(r, name)


def _clean_root(r: Run) -> str:
    def make():
        root = fresh_path(r.spark, "csv-clean")
        csv_drop.write_drop(r.drop_once, root, slices=r.slices)
        return root
    return _memo(r, "_clean_root", make)


def _messy_root(r: Run) -> str:
    def make():
        root = fresh_path(r.spark, "csv-messy")
        csv_drop.write_messy_drop(r.drop_once, root, slices=r.slices)
        return root
    return _memo(r, "_messy_root", make)


def _messy(r: Run):
    return _memo(r, "_messy_scan", lambda: csv_drop.read_drop(r.spark, _messy_root(r)))


def _as_read(recs: DataFrame) -> DataFrame:
    """The 13 text columns as a CSV reader sees them (empty text is NULL)."""
    return recs.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in REQUIRED_COLUMNS])


def csv_scan(r: Run) -> DataFrame:
    """Every record of the clean CSV drop, read back by header name."""
    recs, _ = csv_drop.read_drop(r.spark, _clean_root(r))
    return _as_read(recs)


def csv_union_by_name(r: Run) -> DataFrame:
    """Records of the valid files of the messy drop: files of every layout
    (including reordered columns plus an extra one) unioned by name."""
    recs, _ = _messy(r)
    return _as_read(recs)


def _folder() -> F.Column:
    return F.regexp_extract("source_file", r"^(.*)/[^/]+$", 1).alias("folder")


def validate_required_columns(r: Run) -> DataFrame:
    """Per drop folder: the required columns its files lack."""
    _, checks = _messy(r)
    return checks.select(_folder(), F.array_join("missing_columns", ",").alias("missing_columns"),
                         (F.size("missing_columns") == 0).alias("has_required_columns")).distinct()


def validate_non_empty(r: Run) -> DataFrame:
    """Per drop folder: records below the headers, and whether every file has some."""
    _, checks = _messy(r)
    return checks.groupBy(_folder()).agg(F.sum("n_records").alias("n_records"),
                                         F.bool_and(F.col("n_records") > 0).alias("non_empty"))


def validate_ragged(r: Run) -> DataFrame:
    """Per drop folder: whether any file has a record wider than its header."""
    _, checks = _messy(r)
    return checks.groupBy(_folder()).agg(F.bool_or("ragged").alias("ragged"))


def arrival_order(r: Run) -> DataFrame:
    """Per CSV file: first and last record by arrival, and the record count."""
    recs, _ = csv_drop.read_drop(r.spark, _clean_root(r))
    return recs.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min_by("order_id", "_arrival").alias("first_order_id"),
        F.max_by("order_id", "_arrival").alias("last_order_id"))


def csv_roundtrip(r: Run) -> DataFrame:
    """Written drop versus the drop read back (text missing either way is
    NULL on both sides, as a CSV reader sees it): counts of rows only on one
    side must be zero."""
    written = r.drop  # stored before the writing, which then reads it too
    recs, _ = csv_drop.read_drop(r.spark, _clean_root(r))
    return compared(_as_read(written), _as_read(recs))


def compared(written: DataFrame, read: DataFrame) -> DataFrame:
    """Two multisets of text rows: their sizes, and how many rows each has more of than the other (as ``exceptAll``
    counts them).  Each side is read once, and one shuffle moves 32 bytes a row: the SHA-256 of its values, each with
    its length before it, so that different rows have different texts."""
    def signed(df: DataFrame, side: str) -> DataFrame:
        values = [F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.length(c), F.lit(":"), F.col(c))) for c in df.columns]
        return df.select(F.unhex(F.sha2(F.concat(*values), 256)).alias("_row"), F.lit(int(side == "written")).alias("_w"), F.lit(int(side == "read")).alias("_r"))
    each = signed(written, "written").unionByName(signed(read, "read")).groupBy("_row").agg(F.sum("_w").alias("_w"), F.sum("_r").alias("_r"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    more = lambda a, b: F.greatest(F.col(a) - F.col(b), F.lit(0))
    return each.agg(total("_w").alias("written"), total("_r").alias("read"),
                    total(more("_w", "_r")).alias("only_written"), total(more("_r", "_w")).alias("only_read"))


def dash_run_history(r: Run) -> DataFrame:
    return reports.dash_run_history(r.wh)


def mv_staleness(r: Run) -> DataFrame:
    """The rollup as stored after the first of two runs, against the live
    rollup after both: months whose stored numbers are stale."""
    wh, _ = r.two
    stored = wh.as_of(1).table("mv_monthly_sales").groupBy("month").agg(
        F.sum("total_revenue").cast("double").alias("stored_revenue"))
    live = monthly_rollup(wh.table("fact_sales"), wh.table("dim_products")).groupBy("month").agg(
        F.sum("total_revenue").cast("double").alias("live_revenue"))
    j = stored.join(live, "month", "full_outer")
    return j.withColumn("stale", ~F.col("stored_revenue").eqNullSafe(F.col("live_revenue")))


def stream_ingest(r: Run) -> DataFrame:
    """The clean CSV drop ingested as a file stream (several micro-batches,
    each a set-based load) into a fresh warehouse; returns its fact rows."""
    def make():
        root = _clean_root(r)
        wh = Warehouse.create(r.spark)
        file_stream.ingest(r.spark, root, f"{root}/raw/*/*.csv", wh,
                           checkpoint=fresh_path(r.spark, "stream-ckpt"), max_files_per_trigger=20, keep_commits=2)
        return wh
    wh = _memo(r, "_stream_wh", make)
    return wh.table("fact_sales").select("order_id", "sale_date", "product_id", "quantity",
                                         F.col("total_amount").cast("double").alias("total_amount"),
                                         "region", "channel", "source_file")


# keys with a SQL statement as well (see ``oracle.FINAL``)
CSV_WITH_SQL = {
    "csv_scan": _on(csv_scan),
    "csv_union_by_name": _on(csv_union_by_name),
    "csv_roundtrip": _on(lambda r: csv_roundtrip(r)),
    "validate_required_columns": _on(validate_required_columns),
    "validate_non_empty": _on(validate_non_empty),
    "validate_ragged": _on(validate_ragged),
    "mv_staleness": _on(mv_staleness),
}

ROWS_ONLY = {
    **CSV_WITH_SQL,
    "arrival_order": _on(arrival_order),
    "dash_run_history": _on(dash_run_history),
    "stream_ingest": _on(stream_ingest),
}
