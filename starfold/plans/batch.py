"""One scheduled batch over a CSV drop folder: list, validate, load, archive,
log, refresh - the whole hourly job as one Spark application."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.csv_drop import raw_lines, scan_drop
from ..sources.listing import list_files, plain
from . import ledger
from .warehouse import BatchReport, Warehouse


@dataclass
class CsvBatch:
    checks: DataFrame              # structural verdict per scanned file
    report: BatchReport | None     # None when no valid new file was found
    files: DataFrame | None = None  # the listing: what is new, known, or changed since it was loaded


def run_csv_batch(wh: Warehouse, root: str, refresh: str = "incremental",
                  use_ledger: bool = True, archive_root: str | None = None, multi_line: bool = False,
                  reload_changed: bool = False) -> CsvBatch:
    """Load every valid CSV file under ``root`` not yet loaded successfully.

    The folder is listed without opening a file, the listing compared with the
    ledger, and only new files are scanned.  A loaded file whose length or time
    has changed is in ``files`` as ``changed``; it is loaded again only with
    ``reload_changed`` (orders that are there are ignored as ever).

    Invalid files (missing columns, empty, ragged) are reported in ``checks``
    and left in place, like the validation step that skips them; where others
    are loaded, they get a ledger row with status ``invalid``.  With
    ``archive_root`` the lines of successful files, header and all, are put
    below it byte for byte, under their archive key (``raw/`` -> ``archive/``; a last
    line gets a line feed if it has none).  The load's commit names them, so a
    job that stops before they are in place leaves that to the next one.
    """
    spark = wh.spark
    wh.finish_archives()
    # one row per file; cut from the ledger, which this batch appends to
    files = ledger.file_states(list_files(spark, root), wh).checkpoint(eager=True)
    wanted = ["new", "changed"] if reload_changed else ["new"]
    todo = files.where(F.col("state").isin(wanted)) if use_ledger else files
    # as many paths as the scan's own file index holds
    paths = [plain(r["path"]) for r in todo.select("path").orderBy("path").toLocalIterator()]
    lines, drop, checks = scan_drop(spark, root, multi_line, paths)
    valid = checks.filter(F.col("status") == "valid").select("source_file")
    if valid.limit(1).count() == 0:
        checks = checks.checkpoint(eager=True)
        lines.unpersist()
        return CsvBatch(checks=checks, report=None, files=files)
    archive = (ledger.archive_lines(raw_lines(spark, root, paths)), archive_root) if archive_root else None
    report = wh.load(drop, refresh=refresh, invalid=checks.filter(F.col("status") == "invalid"), archive=archive,
                     listing=todo.select("source_file", "length", "modified"), only_new=use_ledger and not reload_changed)
    wh.finish_archives()
    checks = checks.checkpoint(eager=True)  # one row per file; keep it, drop the lines
    report.release()
    lines.unpersist()
    return CsvBatch(checks=checks, report=report, files=files)
