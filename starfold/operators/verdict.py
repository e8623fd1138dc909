"""File-atomic acceptance: one verdict per source file.

A file is loaded whole or not at all.  The verdict is a grouped aggregate by
file (partial aggregation makes a huge file cheap to judge) and the rows of
accepted files are then selected with a semi join against the verdict table
(one row per file, and the files are those that the driver has listed, so the
broadcast is bounded by that listing).  A window over the file would instead put
every row of a file in one task, and so would a shuffle of the rows by file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_verdicts(annotated: DataFrame) -> DataFrame:
    """(source_file, status, error, n_records, n_candidates) per file."""
    # flags and counts fit a hash aggregate, the first message does not: only rows with one are sorted for it
    errors = annotated.where(F.col("_err").isNotNull()).groupBy("source_file").agg(F.min_by("_err", "_arrival").alias("_first_err"))
    agg = annotated.groupBy("source_file").agg(
        F.bool_or(F.col("_c4") & F.col("_qty_inf")).alias("_qty_inf"),
        F.bool_and("_region_untyped").alias("_region_untyped"),
        F.bool_and("_channel_untyped").alias("_channel_untyped"),
        F.bool_or("_pid_text").alias("_pid_text"),
        F.bool_or(F.col("_c5") & F.col("_pid_fraction")).alias("_pid_fraction"),
        F.count(F.lit(1)).alias("n_records"),
        F.count_if("_c5").alias("n_candidates"),
    )
    # both sides have a row per file; a file without a name is one as well
    agg = agg.join(errors.withColumnRenamed("source_file", "_file"), F.col("source_file").eqNullSafe(F.col("_file")), "left")
    error = (F.when(F.col("_qty_inf"), F.lit("quantity is not finite"))
             .when(F.col("_region_untyped"), F.lit("region column is not text"))
             .when(F.col("_channel_untyped"), F.lit("channel column is not text"))
             .when(F.col("_pid_text") & F.col("_pid_fraction"), F.lit("product_id is not an integer"))
             .otherwise(F.col("_first_err")))
    return agg.select(
        "source_file",
        F.when(error.isNull(), F.lit("success")).otherwise(F.lit("error")).alias("status"),
        error.alias("error"),
        "n_records", "n_candidates")


def accepted_rows(annotated: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Loadable rows (survived both drops) of files whose verdict is success."""
    ok = verdicts.filter(F.col("status") == "success").select("source_file")
    return annotated.filter(F.col("_c5")).join(F.broadcast(ok), "source_file", "left_semi")
