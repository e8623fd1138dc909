"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Equal texts are one group. Packing is done in two rounds so that no task and no driver holds all groups:

1. The groups are hashed to tasks; each task takes its groups by falling size and puts each into the open bin with
   the least room that still holds it, found in a balanced tree of the bins by room. A bin's capacity is a fixed
   part of all bytes (``1 / BINS``); a larger group is a bin of its own. So there are at most 2 * BINS bins and one open bin
   per task, however many groups there are.
2. The bins (a bounded table) go to the driver, which packs them in the same way and looks for the least shard
   capacity at which best fit needs no more than the wanted number of shards (bisection over the capacity).

The law is ``bytes``: shards differ by no more than a bin, unless one group alone is larger than an equal part.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.text import hash_pair, put, whole
from starfold.session import checkpoint_root

#: The smallest part of all bytes that a first-round bin may have.
BINS = 2048
#: Rows of a shard that are numbered together, about.
RUN = 2_000


class Rooms:
    """Open bins by room: a two-level balanced tree (sorted leaves of bounded size) of (room, bin)."""

    LEAF = 256

    def __init__(self):
        self.leaves: list[list[tuple[int, int]]] = [[]]

    def _leaf(self, key: tuple[int, int]) -> int:
        lo, hi = 0, len(self.leaves) - 1
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if self.leaves[mid][-1] < key else (lo, mid)
        return lo

    def add(self, room: int, number: int) -> None:
        i = self._leaf((room, number))
        insort(self.leaves[i], (room, number))
        if len(self.leaves[i]) > self.LEAF:
            self.leaves[i : i + 1] = [self.leaves[i][: self.LEAF // 2], self.leaves[i][self.LEAF // 2 :]]

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least room of at least ``size``."""
        i = self._leaf((size, -1))
        j = bisect_left(self.leaves[i], (size, -1))
        if j == len(self.leaves[i]):
            return None
        got = self.leaves[i].pop(j)
        if not self.leaves[i] and len(self.leaves) > 1:
            del self.leaves[i]
        return got


class BestFit:
    """Best fit over bins of one capacity; a larger thing gets a bin of its own."""

    def __init__(self, capacity: int):
        self.capacity, self.rooms, self.bins = capacity, Rooms(), 0

    def put(self, size: int) -> int:
        room, number = self.rooms.take(size) or (max(self.capacity, size), self.bins)
        self.bins = max(self.bins, number + 1)
        if room > size:
            self.rooms.add(room - size, number)
        return number


def pack(sizes: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """name -> shard for things given as (size, name): a thing as large as an equal part of what is left gets a shard of its
    own, the rest goes by best fit by falling size at the least capacity, found by bisection, that needs at most the
    shards left."""
    order = sorted(sizes, key=lambda x: (-x[0], str(x[1])))
    total, alone = sum(s for s, _ in order), 0
    while alone < min(shards - 1, len(order)) and order[alone][0] * (shards - alone) >= total:
        total -= order[alone][0]
        alone += 1
    rest, left = order[alone:], shards - alone
    low, high = max(-(-total // left), rest[0][0] if rest else 1), max(total, 1)

    def fitted(capacity: int) -> list[int] | None:
        fit, out = BestFit(capacity), []
        for size, _ in rest:
            out.append(fit.put(size))
            if fit.bins > left:
                return None
        return out

    best = fitted(high) or []
    while low < high:
        mid = (low + high) // 2
        if (got := fitted(mid)) is None:
            low = mid + 1
        else:
            best, high = got, mid
    return {name: i for i, (_, name) in enumerate(order[:alone])} | {name: alone + shard for (_, name), shard in zip(rest, best, strict=True)}


def shard_documents(docs: DataFrame, shards: int = 8, text: str = "text", doc_id: str = "doc_id", bins: int = BINS) -> DataFrame:
    """The documents with size (UTF-8 bytes of the text plus 1), shard (0 to shards - 1) and slot (0, 1, ... in the
    shard, without gaps). Equal texts share a shard; a null text counts as empty.

    Defined cases: an empty table gives an empty one; a row without doc_id is placed like others and comes first among
    its neighbours; repeated rows are different rows with slots of their own; if a group is larger than
    an equal part of the bytes, its shard is as large as the group and the others share the rest. Columns named like the new
    ones are replaced.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    h1, h2 = hash_pair(whole(F.col("row")[text]))
    src = docs.select(F.struct("*").alias("row")).select("row", h1.alias("h1"), h2.alias("h2"), (F.octet_length(whole(F.col("row")[text])) + 1).cast("long").alias("size"))
    groups = src.groupBy("h1", "h2").agg(F.sum("size").alias("group_size"))
    totals = src.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n"), F.count("*").alias("rows")).first()
    capacity = max(1, -(-totals["n"] // bins))

    def first_round(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, fit = TaskContext.get().partitionId(), BestFit(capacity)
        for frame in frames:
            yield frame.assign(task=task, bin=[fit.put(s) for s in frame["group_size"].tolist()])

    sorted_groups = groups.repartition("h1").sortWithinPartitions(F.desc("group_size"), "h1", "h2")
    # what reads the bins reads them from the shared folder: a lost executor can't renumber them
    placed = sorted_groups.mapInPandas(first_round, "h1 long, h2 long, group_size long, task int, bin int").checkpoint()
    sums = placed.groupBy("task", "bin").agg(F.sum("group_size").alias("n")).collect()  # at most 2 * bins, and one for each task
    where = pack([(r["n"], (r["task"], r["bin"])) for r in sums], shards)
    table = spark.createDataFrame([(t, b, s) for (t, b), s in where.items()], "task int, bin int, shard int")
    in_shard = placed.join(F.broadcast(table), ["task", "bin"]).select("h1", "h2", "shard")
    rows = src.join(in_shard, ["h1", "h2"])

    # slots: rows are counted in runs of about RUN rows, then numbered within their run
    runs = max(1, totals["rows"] // (RUN * shards))
    rows = rows.withColumn("run", F.pmod(F.xxhash64(F.col("row")[doc_id], F.lit(2)), F.lit(runs)))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "run").agg(F.count("*").alias("n")).select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "run").orderBy(F.col("row")[doc_id], "h1", "h2")) - 1
    out = rows.join(starts, ["shard", "run"]).withColumn("slot", F.col("before") + number)
    return out.select(*put(docs, "row", size=F.col("size"), shard=F.col("shard"), slot=F.col("slot")))
