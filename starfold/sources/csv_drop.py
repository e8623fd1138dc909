"""CSV drops: write them, list and validate them, read them by header name.

Reading is one distributed text scan of ``<root>/**/*.csv``:

* per file, the header is the first non-blank line (smallest ``(block start, row id)``)
  and the line count comes from the same grouped aggregate - no driver loop
  over files and no second read for validation;
* each record line is parsed with the built-in ``from_csv`` into positional
  fields and every required column is picked *by name* through the file's
  own header, so column order may differ between files and extra columns are
  ignored (Spark's CSV reader would bind a given schema by position);
* arrival order is ``(source_file, block start, row id)`` taken on the scan,
  which reproduces listing order followed by record order.

Structural checks mirror the validation step: a file missing a required
column, a header-only file, or a file with a record wider than its header is
``invalid`` and is not loaded.
"""

from __future__ import annotations

import os
import re

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cleaning import NA_TOKENS, date_format_of
from ..session import checkpoint_root, fix_splits
from .sales_drop import REQUIRED_COLUMNS

# what is kept of a scanned line
LINE_COLUMNS = ("value", "source_file", "_block", "_row")
# quotes doubled inside quoted fields; values kept byte for byte (Spark's
# writer would otherwise trim leading and trailing blanks)
_CSV_OPTS = {"escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}


def _uri_path(root: str) -> str:
    """The path part of a root as it appears in ``_metadata.file_path``."""
    m = re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?(/.*)$", root)
    if m:  # a URI: scheme, optional authority, path
        return m.group(2).rstrip("/")
    return os.path.abspath(root).rstrip("/")


def relative_path(path: F.Column, root: str) -> F.Column:
    """A file's path below ``root``."""
    prefix = re.escape(_uri_path(root)).lstrip("/")
    return F.regexp_extract(path, f"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]*)?)?/*{prefix}/(.*)$", 1)


def file_path() -> F.Column:
    """The path of the file that a row was read from.  The metadata column has it encoded as a URI (in which a plus
    sign stands for itself)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def with_fields(df: DataFrame, col: str, width: int, out: str = "_f") -> DataFrame:
    """Add ``out``: the CSV line in ``col`` as an array of ``width`` string
    fields (NULL past its end).  The line is parsed once into a struct
    column; the array then only reads that struct's fields."""
    ddl = ", ".join(f"f{i} STRING" for i in range(width))
    parsed = df.withColumn("_parsed", F.from_csv(F.col(col), ddl, _CSV_OPTS))
    return parsed.withColumn(out, F.array(*[F.col(f"_parsed.f{i}") for i in range(width)])).drop("_parsed")


def field_count(line: str) -> F.Column:
    """Fields of a CSV line, empty ones included: separators outside quotes plus one."""
    bare = F.when(F.contains(F.col(line), F.lit('"')), F.regexp_replace(line, '"[^"]*"', "")).otherwise(F.col(line))
    return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _first_of(rows: DataFrame, *more: F.Column) -> DataFrame:
    """(source_file, _first, more): the place of each file's first row.  Taken by block and then by file, as numbers
    that fit a hash aggregate: the least of a struct would sort all lines."""
    blocks = rows.groupBy("source_file", "_block").agg(F.min("_row").alias("_row"), *more)
    names = [c for c in blocks.columns if c not in ("source_file", "_block", "_row")]
    return blocks.groupBy("source_file").agg(F.min(F.struct("_block", "_row")).alias("_first"), *[F.sum(c).alias(c) for c in names])


def _at(lines: DataFrame, places: DataFrame) -> DataFrame:
    """The lines in these places (source_file, _first and more), one of each file at most.  The files are those that the
    driver has listed, which bounds the broadcast."""
    key = places.withColumnRenamed("source_file", "_file")
    here = ((F.col("source_file") == F.col("_file")) & (F.col("_block") == F.col("_first._block")) & (F.col("_row") == F.col("_first._row")))
    return lines.join(F.broadcast(key), here).drop("_file")


def _headers(lines: DataFrame) -> DataFrame:
    found = _at(lines, _first_of(lines, F.count(F.lit(1)).alias("_lines")))
    return found.select("source_file", F.col("value").alias("header"), "_first", "_lines")


def _below_header(lines: DataFrame, about: DataFrame) -> DataFrame:
    """The lines that are not their file's header, with what is known of the file."""
    rows = lines.join(F.broadcast(about), "source_file")
    return rows.filter((F.col("_block") != F.col("_first._block")) | (F.col("_row") != F.col("_first._row")))


def _small(per_file: DataFrame) -> DataFrame:
    """A table of one row per file, made once."""
    checkpoint_root(per_file.sparkSession)
    return per_file.checkpoint(eager=True)


def parse_width(headers: DataFrame) -> int:
    """Fields to parse per line: as many as the widest header has.  One
    number from a one-row-per-file table; no fixed cap."""
    widest = headers.agg(F.max(field_count("header"))).first()[0]
    return max(1, int(widest or 0))


def text_lines(text: DataFrame, root: str) -> DataFrame:
    """The non-blank lines of a text scan (batch or micro-batch) with lineage
    and order.  ``text``: value, _path, _block."""
    rel = relative_path(F.col("_path"), root)
    row = F.col("_id") if "_id" in text.columns else F.monotonically_increasing_id()
    lines = text.withColumn("_row", row).withColumn("source_file", rel).drop("_id")
    lines = lines.withColumn("_pos", F.struct("_block", "_row"))
    return lines.filter(~F.col("value").isin("", "\r"))


def scan_lines(spark: SparkSession, root: str, multi_line: bool = False, paths: list[str] | None = None) -> DataFrame:
    """Every non-blank line of every ``*.csv`` below ``root`` with lineage and order; of the files ``paths`` alone where they are given.

    ``multi_line``: records may hold line breaks inside quotes (``quoted_records``)."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    if paths is not None and not paths:
        text = spark.createDataFrame([], "value string, _path string, _block long")
    else:
        # a record may hold a carriage return of its own: only line feeds cut lines then
        text = (reader.option("lineSep", "\n") if multi_line else reader).text(paths if paths is not None else root).select(
            "value", file_path().alias("_path"), F.col("_metadata.file_block_start").alias("_block"))
    return text_lines(quoted_records(text) if multi_line else text, root)


def raw_lines(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """(source_file, block, row, line) of every line of the files, carriage returns and blank lines included."""
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
    return text.select(relative_path(file_path(), root).alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"))


def quoted_records(text: DataFrame, run: int = 4096) -> DataFrame:
    """Records in place of lines (value, _path, _block) where quoted fields hold line breaks.

    A line feed ends a record if an even number of quotes is before it in its file.  That is a prefix sum over lines, taken in two
    steps so that no file is gathered: lines are numbered within the block that a task read and cut into runs, each run sums its quotes,
    and a window over the runs of a file (one row for each ``run`` lines) gives the number before each.  A record then is known by
    the line that it begins at, and only lines that don't end a record are gathered with those that go on with it: the lines of one
    record, however many the file has.
    """
    low = F.lit((1 << 33) - 1)
    n_quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    lines = text.withColumn("_id", F.monotonically_increasing_id()).withColumn("_quotes", n_quotes).withColumn("_part", F.shiftrightunsigned("_id", 33))
    lines = lines.withColumn("_run", F.floor(F.col("_id").bitwiseAND(low) / run)).persist(StorageLevel.MEMORY_AND_DISK)  # ids are fixed here
    sums = lines.groupBy("_path", "_block", "_part", "_run").agg(F.sum("_quotes").alias("_sum"))
    earlier = Window.partitionBy("_path").orderBy("_block", "_part", "_run").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    # within a run: at most ``run`` lines to a window, so a file of any size is cut in parallel
    own = Window.partitionBy("_path", "_block", "_part", "_run").orderBy("_id")
    upto = F.col("_before") + F.sum("_quotes").over(own.rowsBetween(Window.unboundedPreceding, 0))
    at = lines.join(before, ["_path", "_block", "_part", "_run"]).withColumn("_upto", upto)
    begins = (F.col("_upto") - F.col("_quotes")) % 2 == 0
    whole = at.where(begins & (F.col("_upto") % 2 == 0))
    broken = at.where(~begins | (F.col("_upto") % 2 == 1)).withColumn("_odd", F.when(begins, F.struct("_block", "_id")))
    # lines of broken records follow their first line; the same two steps give each of them the place of that line
    heads = broken.groupBy("_path", "_block", "_part", "_run").agg(F.max("_odd").alias("_last"))
    ahead = Window.partitionBy("_path").orderBy("_block", "_part", "_run").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("_head", F.last("_last", ignorenulls=True).over(ahead)).drop("_last")
    within = F.last("_odd", ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, 0))
    placed = broken.join(heads, ["_path", "_block", "_part", "_run"]).withColumn("_first", F.coalesce(within, F.col("_head")))
    joined = placed.groupBy("_path", "_first").agg(F.array_sort(F.collect_list(F.struct("_block", "_id", "value"))).alias("_lines"))
    joined = joined.select(F.array_join(F.col("_lines.value"), "\n").alias("value"), "_path", F.col("_first._block").alias("_block"), F.col("_first._id").alias("_id"))
    out = whole.select("value", "_path", "_block", "_id").unionByName(joined)
    # a carriage return before the line feed belongs to it
    return out.withColumn("value", F.regexp_replace("value", "\r$", ""))


def file_checks(lines: DataFrame, required=REQUIRED_COLUMNS, width: int | None = None, headers: DataFrame | None = None) -> DataFrame:
    """One row per file: header, records, missing columns, ragged, verdict,
    and the date format that the file's first date shows.  ``columns`` keeps
    the position of every header field, an unnamed one as NULL."""
    per_file = headers if headers is not None else _small(_headers(lines))  # joined twice below
    width = width or parse_width(per_file)
    per_file = per_file.checkpoint(eager=True)  # one row per file, read by both joins below
    req = F.array(*[F.lit(c) for c in required])
    named = with_fields(per_file, "header", width, "_h").withColumn("columns", F.slice("_h", 1, field_count("header")))
    checks = named.select(
        "source_file", "header", "_first", "columns",
        (F.col("_lines") - 1).alias("n_records"),
        F.array_sort(F.array_except(req, "columns")).alias("missing_columns"))
    # records wider than their header, a surplus empty field included
    about = checks.select("source_file", "_first", F.size("columns").alias("_width"),
                          F.array_position("columns", "sale_date").cast("int").alias("_date_at"))
    recs = with_fields(_below_header(lines, about), "value", width)
    date = F.get("_f", F.col("_date_at") - 1)
    dated = F.when(date.isNotNull() & ~date.isin(*NA_TOKENS), F.col("_row"))
    blocks = recs.select("source_file", "_block", dated.alias("_dated"), (field_count("value") > F.col("_width")).cast("int").alias("_wide"))
    blocks = blocks.groupBy("source_file", "_block").agg(F.max("_wide").alias("_wide"), F.min("_dated").alias("_row"))
    found = blocks.groupBy("source_file").agg(F.max("_wide").alias("_wide"), F.min(F.when(F.col("_row").isNotNull(), F.struct("_block", "_row"))).alias("_dated"))
    found = _small(found)
    # the first dated record of each file once more, for its date
    places = found.where(F.col("_dated").isNotNull()).select("source_file", F.col("_dated").alias("_first"))
    first = _at(lines, places.join(about.select("source_file", "_date_at"), "source_file"))
    dates = with_fields(first, "value", width).select("source_file", date.alias("_date"))
    found = found.select("source_file", (F.col("_wide") == 1).alias("ragged")).join(dates, "source_file", "left")
    out = checks.join(found, "source_file", "left").fillna(False, subset=["ragged"])
    reason = (F.when(F.size("missing_columns") > 0,
                     F.concat(F.lit("missing columns: "), F.array_join("missing_columns", ", ")))
              .when(F.col("n_records") == 0, F.lit("file is empty"))
              .when(F.col("ragged"), F.lit("record wider than header")))
    return out.select("source_file", "header", "_first", "columns", "n_records", "missing_columns", "ragged",
                      F.when(reason.isNull(), F.lit("valid")).otherwise(F.lit("invalid")).alias("status"),
                      reason.alias("reason"), date_format_of(F.col("_date")).alias("date_format"))


def records(lines: DataFrame, checks: DataFrame, width: int, required=REQUIRED_COLUMNS,
            only_valid: bool = True) -> DataFrame:
    """The drop: required columns picked by header name, plus lineage and the
    file's date format."""
    hdr = checks
    if only_valid:
        hdr = hdr.filter(F.col("status") == "valid")
    # where a file has its columns is told once for the file
    places = [(F.array_position("columns", c).cast("int") - 1).alias(f"_at_{c}") for c in required]
    rows = with_fields(_below_header(lines, hdr.select("source_file", "_first", *places, "date_format")), "value", width)
    picked = [F.get(F.col("_f"), F.col(f"_at_{c}")).alias(c) for c in required]
    return rows.select(*picked, "source_file",
                       F.struct(F.col("source_file").alias("file"), "_block", "_row").alias("_arrival"),
                       F.col("date_format").alias("_date_format"))


def _checked(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(drop of valid files, per-file checks) of scanned lines.  Headers and checks have one row per file and are made once."""
    headers = _small(_headers(lines))
    width = parse_width(headers)
    checks = _small(file_checks(lines, width=width, headers=headers))
    return records(lines, checks, width), checks


def scan_drop(spark: SparkSession, root: str, multi_line: bool = False, paths: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lines, drop of valid files, per-file checks) for the CSV files under
    root.  The scanned lines are persisted: the header table, the checks and
    the records all read them, and the row ids that order records are fixed
    once; ``lines.unpersist()`` releases them after the load."""
    lines = scan_lines(spark, root, multi_line, paths).select(*LINE_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    return lines, *_checked(lines)


def read_drop(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(drop of valid files, per-file checks) for the CSV files under root,
    which must stay as they are: nobody would release a copy of all lines, so
    each step reads the files again.  One listing and splits of one size give
    a line the same row id each time."""
    fix_splits(spark)
    return _checked(scan_lines(spark, root).select(*LINE_COLUMNS))


# ---- writing drops -----------------------------------------------------------

def _month_part(df: DataFrame) -> DataFrame:
    return df.withColumn("part", F.regexp_extract("source_file", r"sales_([0-9]{4}_[0-9]{2})", 1))


def _sliced(df: DataFrame, slices: int) -> list[DataFrame]:
    """The rows by hash of their month.  Each slice is written by a job of its own, of whose input only these months are
    shuffled, and whose shuffles are gone before the next; a month is in one slice, so its files are the same."""
    if slices == 1:
        return [df]
    return [df.filter(F.pmod(F.xxhash64("part"), F.lit(slices)) == i) for i in range(slices)]


def write_drop(drop: DataFrame, root: str, columns=REQUIRED_COLUMNS, slices: int = 1) -> str:
    """One folder of CSV files per ship month under ``<root>/raw``; each file
    carries its own header.  Rebalancing keeps the file count per month low
    and lets AQE split a hot month across tasks."""
    out = f"{root.rstrip('/')}/raw"
    for i, rows in enumerate(_sliced(_month_part(drop), slices)):
        (rows.select(*columns, "part").hint("rebalance", "part")
         .write.mode("append" if i else "error").partitionBy("part").options(header=True, **_CSV_OPTS).csv(out))
    return out


def _write_lines(lines: DataFrame, header: str, path: str, slices: int = 1) -> None:
    """Write pre-formatted CSV lines (column ``line``) under ``path`` with a
    literal header.  The lines are already CSV, so the writer gets a
    separator and quote that never occur and leaves the text untouched."""
    for rows in _sliced(lines, slices):
        (rows.select(F.col("line").alias(header), "part").hint("rebalance", "part")
         .write.mode("append").partitionBy("part").option("header", True)
         .option("sep", "\u0001").option("quote", "\u0000").option("escapeQuotes", False)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))


def write_messy_drop(drop: DataFrame, root: str, slices: int = 1) -> str:
    """A drop whose files exercise every structural rule, derived from the
    data itself (month number m of the ship month):

    * m in (1, 6, 11)  written without the ``channel`` column  -> invalid
    * m = 12           reversed column order plus a ``note`` column -> valid
    * m = 7            records of line number 1 carry one surplus field -> invalid
    * ``raw/empty/``   one header-only file                     -> invalid
    * every other month is a normal file                        -> valid

    Each kind is written by a job of its own, that of the normal files in ``slices``.
    """
    out = f"{root.rstrip('/')}/raw"
    d = _month_part(drop).withColumn("_m", F.substring("part", 6, 2).cast("int"))
    cols = list(REQUIRED_COLUMNS)
    line = lambda cs: F.to_csv(F.struct(*[F.col(c) for c in cs]), _CSV_OPTS)

    normal = d.filter(~F.col("_m").isin(1, 6, 7, 11, 12))
    _write_lines(normal.select(line(cols).alias("line"), "part"), ",".join(cols), out, slices)

    no_channel = [c for c in cols if c != "channel"]
    _write_lines(d.filter(F.col("_m").isin(1, 6, 11)).select(line(no_channel).alias("line"), "part"),
                 ",".join(no_channel), out)

    wide = list(reversed(cols)) + ["note"]
    reordered = d.filter(F.col("_m") == 12).withColumn("note", F.concat(F.lit("batch "), F.col("part")))
    _write_lines(reordered.select(line(wide).alias("line"), "part"), ",".join(wide), out)

    surplus = F.when(F.col("_arrival.linenumber") == 1, F.lit(",surplus")).otherwise(F.lit(""))
    ragged = d.filter(F.col("_m") == 7).select(F.concat(line(cols), surplus).alias("line"), "part")
    _write_lines(ragged, ",".join(cols), out)

    empty = drop.sparkSession.createDataFrame([], ", ".join(f"`{c}` string" for c in cols))
    empty.coalesce(1).write.mode("error").options(header=True, **_CSV_OPTS).csv(f"{out}/empty")
    return out
