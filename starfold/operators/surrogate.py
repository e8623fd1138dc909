"""Dense surrogate keys without a global single-partition window.

New rows get ``base + 1 .. base + n``.  Rows are tagged with their partition
id and in-partition position (``monotonically_increasing_id`` encodes both)
and the tagged rows are persisted, so the counting pass and the numbering
pass read the same partitions.  Only the per-partition counts - one row per
partition - reach the driver to turn into offsets.  If an executor is lost,
a recomputed partition holds the same rows (perhaps in another order), so
its ids stay inside its own offset range: still unique and dense.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_LOW_BITS = (1 << 33) - 1


def max_id(df: DataFrame, id_col: str) -> int:
    """Largest existing id (a one-row aggregate), 0 for an empty table."""
    v = df.agg(F.max(id_col)).first()[0]
    return int(v or 0)


def assign_ids(df: DataFrame, id_col: str, base: int, order: str | None = None,
               cached: list | None = None, cut_lineage: bool = False,
               counted: list | None = None) -> DataFrame:
    """Append ``id_col`` = base + dense 1..n.  With ``order``, ids follow that
    column (range-partitioned sort, so no single-task global order).  The
    persisted tagged rows are appended to ``cached`` for the caller to
    release once the result has been written; the number of new ids is
    appended to ``counted``.

    ``cut_lineage`` checkpoints the tagged rows to the shared checkpoint
    folder instead of persisting them.  Use it when ``df`` reads the table
    the result will be written to: Spark re-caches plans that read a path
    after writing to it, and a recomputed anti join would see the new rows.
    """
    spark = df.sparkSession
    if order is not None:
        df = df.repartitionByRange(order).sortWithinPartitions(order)
    tagged = (df.withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    if cut_lineage:
        tagged = tagged.checkpoint(eager=True)
    else:
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        if cached is not None:
            cached.append(tagged)
    counts = sorted((r["_pid"], r["n"]) for r in
                    tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, acc = [], 0
    for pid, n in counts:
        offsets.append((pid, acc))
        acc += n
    if counted is not None:
        counted.append(acc)
    schema = T.StructType([T.StructField("_pid", T.IntegerType()), T.StructField("_off", T.LongType())])
    # One row per partition: a proven bound, so the broadcast is safe.
    off = F.broadcast(spark.createDataFrame(offsets, schema))
    local = F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))
    return (tagged.join(off, "_pid")
            .withColumn(id_col, F.lit(base) + F.col("_off") + local + F.lit(1))
            .drop("_pid", "_mid", "_off"))
