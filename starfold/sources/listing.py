"""What lies in a drop folder, without opening a file.

The binary file source gives path, length and time of modification; its content column is pruned, so files are listed and never
read. A load compares the listing with the ledger and scans only the files that are new.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .csv_drop import relative_path


def list_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(source_file, path, length, modified) of the files below ``root`` whose names match the pattern."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", pattern).load(root))
    return found.select(relative_path(F.col("path"), root).alias("source_file"), "path",
                        "length", F.col("modificationTime").alias("modified"))


def plain(path: str) -> str:
    """A path that a reader takes as it is, not as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def with_state(listing: DataFrame, loaded: DataFrame, successful: DataFrame) -> DataFrame:
    """The listing with ``state``: ``new``, ``known``, or ``changed`` where a loaded file has another length or time now.

    loaded: (source_file, length, modified) as of the latest load of each file; successful: (source_file) by the ledger, which also
    names files that were loaded without a listing."""
    ledger = successful.select("source_file", F.lit(True).alias("_done"))
    last = loaded.select("source_file", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    both = listing.join(ledger, "source_file", "left").join(last, "source_file", "left")
    same = F.col("_length").isNull() | ((F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified")))
    state = F.when(F.col("_done").isNull(), "new").when(same, "known").otherwise("changed")
    return both.select(*listing.columns, state.alias("state"))
