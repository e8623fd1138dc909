"""The star schema, its batch load, the monthly rollup and the audit ledger.

Storage is plain Parquet below one root folder, in two kinds of tables:

* appended tables (facts, ledger, loaded files) get a new folder of rows per
  batch; a fact folder comes with its key range and a filter of its keys;
* tables in cells get a new folder for each cell that a batch touches, never
  over a folder that is being read.  Cells are hash buckets of the key
  (dimensions, the months of each product) or months (the cube and the rollup).

So a batch reads and writes the buckets and months that its own keys fall
into, and the fact folders that may hold one of its order ids.

A batch becomes visible at one point: the commit that names its folders
(``commits``).  ``Warehouse.open`` reads the latest commit, so a batch that
fails half way leaves nothing but folders that no commit names, and a process
that starts later goes on where the last one stopped.  A load that finds
another writer's commit in its place starts again from that one.
"""

from __future__ import annotations

import copy
import datetime as dt
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import StorageLevel, inheritable_thread_target

from ..functions.cleaning import CLEAN_COLUMNS, annotate
from ..operators import key_index
from ..operators.dedup import first_wins, last_wins
from ..operators.surrogate import assign_ids
from ..operators.upsert import _present, upsert
from ..operators.verdict import accepted_rows, file_verdicts
from ..session import fresh_path
from .commits import CommitLog, Files

# Fixed value: the job's name in the ledger.
DAG_ID = "sales_pipeline"
# per-row flags the file verdict needs besides the clean columns
FLAG_COLUMNS = ("_c4", "_c5", "_err", "_qty_inf", "_region_untyped", "_channel_untyped",
                "_pid_text", "_pid_fraction")

# what a fact takes from its record
SALE_COLUMNS = ("order_id", "sale_date", "product_id", "quantity", "unit_price", "discount", "total_amount", "region", "channel", "source_file")

SCHEMAS = {
    "dim_products": T.StructType([
        T.StructField("product_id", T.IntegerType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("created_at", T.TimestampType()),
    ]),
    "dim_customers": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]),
    "fact_sales": T.StructType([
        T.StructField("sale_id", T.LongType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("discount", T.DecimalType(5, 2)),
        T.StructField("total_amount", T.DecimalType(12, 2)),
        T.StructField("region", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("sale_month", T.DateType()),
    ]),
    "pipeline_runs": T.StructType([
        T.StructField("run_id", T.LongType()),
        T.StructField("dag_id", T.StringType()),
        T.StructField("run_date", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("rows_loaded", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]),
    "mv_monthly_sales": T.StructType([
        T.StructField("month", T.DateType()),
        T.StructField("region", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("total_orders", T.LongType()),
        T.StructField("total_units", T.LongType()),
        T.StructField("total_revenue", T.DecimalType(22, 2)),
        T.StructField("avg_order_value", T.DecimalType(16, 6)),
    ]),
    # sums by product, from which the rollup is made under the current categories
    "sales_cube": T.StructType([
        T.StructField("month", T.DateType()),
        T.StructField("region", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("units", T.LongType()),
        T.StructField("revenue", T.DecimalType(22, 2)),
        T.StructField("n_amount", T.LongType()),
    ]),
    # bitmaps of customer ids: exact distinct counts that merge over months, regions and batches
    "month_customers": T.StructType([
        T.StructField("month", T.DateType()),
        T.StructField("region", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bits", T.BinaryType()),
    ]),
    # the months in which a product was sold
    "product_months": T.StructType([
        T.StructField("product_id", T.IntegerType()),
        T.StructField("month", T.DateType()),
    ]),
    # what was loaded from where: tells a changed file from a known one
    "loaded_files": T.StructType([
        T.StructField("source_file", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("run_date", T.TimestampType()),
    ]),
    # lines of loaded files that are still to be put into their archive
    "archive": T.StructType([
        T.StructField("archive_key", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("line", T.StringType()),
    ]),
}
APPENDED = ("fact_sales", "pipeline_runs", "loaded_files", "archive")
#: Tables in hash buckets, and the column that gives the bucket.
BUCKETED = {"dim_customers": "email", "dim_products": "product_id", "product_months": "product_id"}
#: Tables with a cell for each month.
MONTHLY = ("sales_cube", "month_customers", "mv_monthly_sales")

# The seeded product catalogue (ids follow insertion order).
SEED_PRODUCTS = (
    (1, "Laptop Pro 15", "Electronics", "1299.99"),
    (2, "Wireless Mouse", "Electronics", "29.99"),
    (3, "USB-C Hub", "Electronics", "49.99"),
    (4, "Mechanical Keyboard", "Electronics", "129.99"),
    (5, "4K Monitor", "Electronics", "399.99"),
    (6, "Office Chair", "Furniture", "299.99"),
    (7, "Standing Desk", "Furniture", "599.99"),
    (8, "Bookshelf", "Furniture", "149.99"),
    (9, "Notebook Set", "Stationery", "12.99"),
    (10, "Pen Pack (10)", "Stationery", "8.99"),
    (11, "Whiteboard", "Stationery", "79.99"),
    (12, "Coffee Maker", "Appliances", "129.99"),
    (13, "Water Purifier", "Appliances", "199.99"),
    (14, "Air Purifier", "Appliances", "249.99"),
)


def seed_frame(spark: SparkSession) -> DataFrame:
    rows = [(i, n, c, p) for i, n, c, p in SEED_PRODUCTS]
    df = spark.createDataFrame(rows, "product_id int, product_name string, category string, unit_price string")
    return df.select("product_id", "product_name", "category",
                     F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
                     F.current_timestamp().alias("created_at"))


CUBE_KEYS = ("month", "region", "channel", "product_id")


def cube_of(fact: DataFrame) -> DataFrame:
    """Additive sums of facts: one row per (month, region, channel, product).
    A partial aggregate, so no raw fact row is shuffled."""
    return (fact.groupBy(F.col("sale_month").alias("month"), "region", "channel", "product_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").cast("long").alias("units"),
                 F.sum("total_amount").cast("decimal(22,2)").alias("revenue"), F.count("total_amount").alias("n_amount")))


def customers_of(fact: DataFrame) -> DataFrame:
    """Bitmaps of the customers of facts by (month, region, bucket of 32,768 ids).
    Ids are made distinct first, in a partial aggregate, so a hot customer is one row
    per task, and a bitmap is built from at most as many rows as it has bits."""
    ids = fact.where(F.col("customer_id").isNotNull()).select(
        F.col("sale_month").alias("month"), "region", F.bitmap_bucket_number("customer_id").alias("bucket"),
        F.bitmap_bit_position("customer_id").alias("bit")).distinct()
    return (ids.repartition("month", "region", "bucket").groupBy("month", "region", "bucket")
            .agg(F.bitmap_construct_agg("bit").alias("bits")))


def merged_customers(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """The bitmaps by other keys: customers in several of the rows count once."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def rollup_of(cube: DataFrame, products: DataFrame) -> DataFrame:
    """mv_monthly_sales from the cube and the *current* product dimension.
    The average is carried as sum and count, never as an average of averages."""
    joined = cube.join(products.select("product_id", "category"), "product_id")
    agg = (joined.groupBy("month", "region", "channel", "category")
           .agg(F.sum("n").alias("total_orders"), F.sum("units").cast("long").alias("total_units"),
                F.sum("revenue").cast("decimal(22,2)").alias("total_revenue"), F.sum("n_amount").alias("_n_amount")))
    return agg.select("month", "region", "channel", "category", "total_orders", "total_units", "total_revenue",
                      (F.col("total_revenue") / F.col("_n_amount")).cast("decimal(16,6)").alias("avg_order_value"))


def monthly_rollup(fact: DataFrame, products: DataFrame) -> DataFrame:
    """mv_monthly_sales straight from the facts."""
    return rollup_of(cube_of(fact), products)


@dataclass
class BatchReport:
    verdicts: DataFrame          # one row per file: status, error, counts
    new_facts: DataFrame         # fact rows inserted by this batch
    runs: DataFrame              # ledger rows appended by this batch
    touched_months: list = field(default_factory=list)
    refreshed: bool = False
    annotated: DataFrame | None = None   # staged typed drop (all rows, flags)
    accepted: DataFrame | None = None    # staged loadable rows of good files
    discard: Callable[[], None] = lambda: None  # deletes what was staged

    def release(self) -> None:
        """Give back the staged batch once nothing reads ``annotated`` or
        ``accepted`` any more (a job that loads every hour must)."""
        if self.annotated is not None:
            self.discard()
            self.annotated = self.accepted = None


def together(spark: SparkSession, *steps: Callable) -> list:
    """Runs steps that don't need each other at the same time, so that the small jobs of one use the cores that another leaves.
    All have ended when this returns or raises."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


def folders_of(parts: dict[str, list[dict]], cells: dict[str, dict]) -> set[str]:
    """The folders that these entries of a state, or of what changed in it, name."""
    rows = {f for entries in parts.values() for p in entries for f in (p["path"], p.get("filter", ""))}
    return rows | {path.rpartition("/")[0] for own in cells.values() for path in own.values() if path}


class Warehouse:
    """The tables as of one commit; every change writes new folders, and a
    commit names those that count."""

    def __init__(self, spark: SparkSession, root: str | None = None, job_id: str = DAG_ID,
                 buckets: int = 16, most_parts: int = 64):
        self.spark = spark
        self.job_id = job_id
        self.root = (root or fresh_path(spark, "warehouse")).rstrip("/")
        self.log = CommitLog(spark, self.root)
        self.commits = 0
        self.most_parts = most_parts
        self._restore({"buckets": buckets})

    # -- state -----------------------------------------------------------
    def _state(self) -> dict:
        return copy.deepcopy({
            "parts": self.parts, "cells": self.cells, "sequences": self.sequences, "pending": self.pending,
            "streams": self.streams, "seeded": self.seeded, "buckets": self.buckets})

    def _restore(self, state: dict) -> None:
        state = copy.deepcopy(state)
        self.parts: dict[str, list[dict]] = {n: state.get("parts", {}).get(n, []) for n in APPENDED}
        self.cells: dict[str, dict[str, str]] = {n: state.get("cells", {}).get(n, {}) for n in (*BUCKETED, *MONTHLY)}
        self.sequences: dict[str, int] = state.get("sequences", {})  # last id handed out per table
        self.pending: list[str] = state.get("pending", [])           # months whose rollup is behind the cube
        self.streams: dict[str, int] = state.get("streams", {})      # last epoch loaded per stream
        self.seeded: str | None = state.get("seeded")                # when the catalogue was seeded
        self.buckets: int = state["buckets"]

    def _commit(self, before: dict) -> bool:
        """Put the next commit; False if another writer was first."""
        if not self.log.put(self.commits + 1, before if self.commits else {"parts": {}, "cells": {}}, self._state()):
            return False
        self.commits += 1
        return True

    def _catch_up(self) -> None:
        """Go on from the last commit."""
        found = self.log.state()
        if found:
            self.commits, state = found
            self._restore(state)

    @classmethod
    def create(cls, spark: SparkSession, seed: bool = True, root: str | None = None, job_id: str = DAG_ID,
               buckets: int = 16, most_parts: int = 64) -> "Warehouse":
        """A new, empty warehouse.  Nothing is written until the first load;
        the product dimension starts as the seed catalogue (an insert-ignore
        into an empty table).  Name a ``root`` to open it again later.
        ``buckets``: cells of each dimension, to be set by its final size;
        ``most_parts``: batch folders of an appended table before they are merged."""
        wh = cls(spark, root, job_id, buckets, most_parts)
        if seed:
            wh.seeded = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        return wh

    @classmethod
    def open(cls, spark: SparkSession, root: str, job_id: str = DAG_ID, commit: int | None = None, most_parts: int = 64) -> "Warehouse":
        """The warehouse below ``root`` as of a commit, the last by default."""
        wh = cls(spark, root, job_id, most_parts=most_parts)
        found = wh.log.state(commit)
        if found is None:
            raise ValueError(f"no such commit below {root}")
        wh.commits, state = found
        wh._restore(state)
        return wh

    def as_of(self, commit: int) -> "Warehouse":
        """The same warehouse at an earlier commit."""
        return Warehouse.open(self.spark, self.root, self.job_id, commit)

    # -- storage ---------------------------------------------------------
    def exists(self, name: str) -> bool:
        """Whether a commit names rows of the table."""
        return bool(self.parts.get(name) or self.cells.get(name))

    def _initial(self, name: str) -> DataFrame:
        """Rows of a table never written: the seed catalogue, or none."""
        if name == "dim_products" and self.seeded:
            return seed_frame(self.spark).withColumn("created_at", F.lit(self.seeded).cast("timestamp"))
        return self.spark.createDataFrame([], SCHEMAS[name])

    def table(self, name: str) -> DataFrame:
        """Current rows; a table never written yet reads as its initial
        rows without touching storage."""
        if self.parts.get(name):
            return self._read_parts(name, [p["path"] for p in self.parts[name]])
        if self.cells.get(name):
            return self._read_cells(name, self.cells[name])
        return self._initial(name)

    def _read_parts(self, name: str, paths: list[str]) -> DataFrame:
        reader = self.spark.read.schema(SCHEMAS[name]).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*[f"{self.root}/{p}" for p in paths]).select(*SCHEMAS[name].fieldNames())

    def _read_cells(self, name: str, cells: dict[str, str]) -> DataFrame:
        """The rows of these cells.  A version of which every cell is read is
        read as one folder; of the others, the cells' own folders."""
        if not cells:
            return self.spark.createDataFrame([], SCHEMAS[name])
        by_version: dict[str, list[str]] = {}
        for path in cells.values():
            by_version.setdefault(path.rpartition("/")[0], []).append(path)
        paths = [p for v, own in by_version.items() for p in ([v] if v.endswith(f"-{len(own)}") else own)]
        reader = self.spark.read.schema(SCHEMAS[name]).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*[f"{self.root}/{p}" for p in sorted(paths)]).select(*SCHEMAS[name].fieldNames())

    def _write_cells(self, name: str, df: DataFrame, cells: list[str], cell: Column) -> None:
        """A new version of some cells; the folder's name ends with their number.
        ``cells`` are all those that ``df`` has rows of."""
        path = f"{name}/v=v{uuid.uuid4().hex[:12]}-{len(cells)}"
        rows = df.select(*SCHEMAS[name].fieldNames()).withColumn("_cell", cell.cast("string"))
        rows.hint("rebalance", "_cell").write.mode("error").partitionBy("_cell").parquet(f"{self.root}/{path}")
        self.cells[name] = {**self.cells[name], **{c: f"{path}/_cell={c}" for c in cells}}

    def bucket_of(self, key: Column) -> Column:
        """The bucket of a key."""
        return F.pmod(F.xxhash64(key), F.lit(self.buckets))

    def _buckets_in(self, df: DataFrame, key: str) -> list[str]:
        """The buckets that the rows' keys fall into, as many as buckets at most."""
        return sorted(str(r[0]) for r in df.select(self.bucket_of(F.col(key))).distinct().collect())

    def _part(self, name: str, buckets: list[str]) -> DataFrame:
        """The rows of some buckets; of a table never written, its initial rows."""
        cells = self.cells[name]
        return self._read_cells(name, {b: cells[b] for b in buckets if b in cells}) if cells else self._initial(name)

    def _append(self, name: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        """Write the batch's rows as a folder of their own; returns them as stored."""
        path = f"{name}/batch=b{uuid.uuid4().hex[:12]}"
        w = df.select(*SCHEMAS[name].fieldNames()).write.mode("error")
        if partition:
            w = w.partitionBy(partition)
        w.parquet(f"{self.root}/{path}")
        self.parts[name] = [*self.parts[name], {"path": path}]
        return self._read_parts(name, [path])

    # -- facts by key ----------------------------------------------------
    def _index(self, rows: DataFrame, n: int, low: str | None, high: str | None) -> None:
        """Notes the key range of the newest fact folder and writes the filter of its n keys."""
        part = self.parts["fact_sales"][-1]
        name = part["path"].rpartition("=")[2]
        part |= {"rows": n, "low": low, "high": high, "level": key_index.level_for(n), "filter": f"fact_keys/{name}"}
        key_index.filter_of(rows.select("order_id"), "order_id", n).write.mode("error").parquet(f"{self.root}/{part['filter']}")

    def folders_with(self, keys: DataFrame, low: str | None, high: str | None) -> list[str]:
        """The fact folders that may hold one of the keys (order_id) of a batch
        from ``low`` to ``high``: their ranges overlap, and their filter knows one."""
        near = [p for p in self.parts["fact_sales"] if p.get("rows") != 0 and ("low" not in p or low is not None and p["low"] <= high and low <= p["high"])]
        asked = [p for p in near if "filter" in p]
        known = key_index.folders_with(self.spark, keys, "order_id", [(p["level"], f"{self.root}/{p['filter']}") for p in asked]) if asked else set()
        return [p["path"] for p in near if "filter" not in p or f"{self.root}/{p['filter']}" in known]

    def unknown_orders(self, firsts: DataFrame, low: str | None, high: str | None) -> DataFrame:
        """The rows whose order_id no fact has: an exact anti join with the folders that may hold one."""
        folders = self.folders_with(firsts.select("order_id"), low, high)
        if not folders:
            return firsts
        old = self._read_parts("fact_sales", folders).select("order_id")
        return firsts.join(_present(old, firsts, ["order_id"]), "order_id", "left_anti")

    # -- upkeep ----------------------------------------------------------
    def compact(self, name: str | None = None) -> None:
        """Merge batch folders of appended tables, and commit: all of them, or
        with ``name`` the smaller half of one table's, so that a row is
        rewritten about once for each doubling of its folder.  Tries again from the
        last commit if another writer was first."""
        while True:
            before = self._state()
            for table in [name] if name else APPENDED[:3]:
                parts = sorted(self.parts[table], key=lambda p: p.get("rows", 0))
                merged = parts[: (len(parts) + 1) // 2] if name else parts
                if len(merged) < 2:
                    continue
                rows = self._read_parts(table, [p["path"] for p in merged])
                gone = {p["path"] for p in merged}
                self.parts[table] = [p for p in self.parts[table] if p["path"] not in gone]
                partition = "sale_month" if table == "fact_sales" else None
                stored = self._append(table, rows.hint("rebalance", partition) if partition else rows.hint("rebalance"), partition)
                if table == "fact_sales":
                    lows, highs = [p["low"] for p in merged if p.get("low")], [p["high"] for p in merged if p.get("high")]
                    self._index(stored, sum(p.get("rows", 0) for p in merged), min(lows, default=None), max(highs, default=None))
            if self._state() == before or self._commit(before):
                return
            self._catch_up()

    def finish_archives(self) -> int:
        """Puts the lines that commits have named into their archives, and commits
        that it is done; returns for how many batches.  Whatever stops it, the next
        call does the open ones again, over what was written."""
        done = 0
        while self.parts["archive"]:
            before = self._state()
            for part in self.parts["archive"]:
                order = ["archive_key", "block", "row"]
                lines = self._read_parts("archive", [part["path"]]).repartitionByRange(*order).sortWithinPartitions(*order)
                (lines.select("archive_key", "line").write.mode("overwrite").partitionBy("archive_key")
                 .text(f"{part['to'].rstrip('/')}/{part['path'].rpartition('/')[2]}"))
            finished, self.parts["archive"] = len(self.parts["archive"]), []
            if self._commit(before):
                return done + finished
            self._catch_up()
        return done

    def vacuum(self, keep: int = 2, older_than: float = 24 * 3600, superseded: bool = False) -> list[str]:
        """Deletes folders that none of the last ``keep`` commits names and
        that were last written ``older_than`` seconds ago (a batch under way
        has named nothing yet).  ``superseded``: those that an earlier commit
        named instead, of any age, which no batch under way will name.  Returns
        what it deleted."""
        last, _ = self.log.state() or (0, {})
        first = max(1, last - keep + 1)
        named: set[str] = set()
        for n in range(first, last + 1):
            _, state = self.log.state(n)
            named |= folders_of(state["parts"], state["cells"])
        earlier = set().union(*(folders_of(p, c) for p, c in self.log.brought(first))) if superseded else set()
        files, gone, limit = self.log.files, [], time.time() - older_than
        for table in (*APPENDED, *BUCKETED, *MONTHLY, "fact_keys"):
            for folder, modified in files.entries(f"{self.root}/{table}"):
                name = f"{table}/{folder}"
                if name not in named and (name in earlier if superseded else modified <= limit):
                    files.delete(f"{self.root}/{name}")
                    gone.append(name)
        self.log.forget(first)
        return gone

    # -- the batch -------------------------------------------------------
    def load(self, raw: DataFrame, refresh: str = "incremental", valid_files: DataFrame | None = None,
             invalid: DataFrame | None = None, listing: DataFrame | None = None, only_new: bool = False,
             stream: tuple[str, int] | None = None, archive: tuple[DataFrame, str] | None = None) -> BatchReport | None:
        """Load a drop as one commit: if any step fails, the warehouse stays
        as it was (see ``_load`` for the arguments).  If another writer has
        committed meanwhile, the load starts again from that commit.

        ``stream``: (name, epoch) of a micro-batch; an epoch that a commit
        already names is not loaded again, and None is returned."""
        while True:
            if stream and self.streams.get(stream[0], -1) >= stream[1]:
                return None
            before, cached = self._state(), []
            staged = fresh_path(self.spark, "staged")
            try:
                report = self._load(raw, refresh, valid_files, invalid, listing, only_new, cached, archive, staged)
                if stream:
                    self.streams[stream[0]] = stream[1]
                landed = self._commit(before)
            except BaseException:
                self._restore(before)
                Files(self.spark, staged).delete(staged)
                raise
            finally:
                for df in cached:
                    df.unpersist()
            if landed:
                break
            report.release()
            self._catch_up()
        for name in APPENDED[:3]:
            if len(self.parts[name]) > self.most_parts:
                self.compact(name)
        return report

    def _upsert(self, name: str, latest: DataFrame, columns: list[str], now: Column, cached: list, id_col: str | None = None) -> tuple[DataFrame, list[str]]:
        """Writes the buckets that the reduced batch falls into anew; returns their rows as they were, and which they are."""
        key = BUCKETED[name]
        touched = self._buckets_in(latest, key)
        current = self._part(name, touched)
        if not touched:
            return current, touched
        counted: list[int] = []
        base = self.sequences.get(name, 0)
        rows = upsert(current, latest, keys=[key], update_cols=columns, id_col=id_col, now=now, id_base=base,
                      cached=cached, counted=counted, reduced=True)
        written = touched if self.cells[name] else sorted({*touched, *self._buckets_in(current, key)})
        self._write_cells(name, rows, written, self.bucket_of(F.col(key)))
        if id_col:
            self.sequences[name] = base + sum(counted)
        return current, touched

    def _load(self, raw: DataFrame, refresh: str, valid_files: DataFrame | None, invalid: DataFrame | None,
              listing: DataFrame | None, only_new: bool, cached: list, archive: tuple[DataFrame, str] | None, staged: str) -> BatchReport:
        """Clean, judge files, upsert dims, insert-ignore facts, log, refresh.

        ``raw``: a drop (13 string columns, source_file, _arrival).
        ``valid_files``: files that passed structural validation; default
        is every file present in ``raw``.
        ``refresh``: "incremental" (months behind the cube), "full", or "none"
        (the rollup stays behind until the next refresh).
        ``invalid``: (source_file, reason) of files that failed structural
        validation; they get a ledger row with status ``invalid``.
        ``listing``: (source_file, length, modified) of the drop's files, noted
        for those that are loaded.
        ``only_new``: leave out files that the ledger has as loaded.
        ``archive``: (source_file, archive_key, block, row, line) and the archive's
        folder; the lines of loaded files are stored with the batch and named by its
        commit, as work that ``finish_archives`` has to do.

        The drop must not read this warehouse's tables (cut its lineage
        first, as ``run_csv_batch`` does): Spark re-caches plans reading a
        path after writing to it, which would change the batch mid-load.
        """
        now = F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")

        def kept(df: DataFrame) -> DataFrame:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            cached.append(df)
            return df

        ann = annotate(raw)
        if valid_files is not None:
            ann = ann.join(valid_files.select("source_file"), "source_file", "left_semi")
        if only_new and self.parts["pipeline_runs"]:
            done = self.table("pipeline_runs").where(F.col("status") == "success").select("source_file")
            ann = ann.join(F.broadcast(done), "source_file", "left_anti")
            invalid = invalid.join(done, "source_file", "left_anti") if invalid is not None else None
        # One pass over the drop: the typed batch is stored, by column and compressed, and
        # the file verdicts and the accepted rows (which feed three writes) read the
        # columns that each needs.
        ann = ann.select(*CLEAN_COLUMNS, *FLAG_COLUMNS)
        ann.write.option("compression", "zstd").parquet(staged)
        ann = self.spark.read.schema(ann.schema).parquet(staged)
        verdicts = file_verdicts(ann).checkpoint(eager=True)  # one row per file
        good = accepted_rows(ann, verdicts).select(*CLEAN_COLUMNS)

        # each target's rows reduced to one per key, once
        people = kept(last_wins(good.select("email", "customer_name", "region", "_arrival"), ["email"]))
        goods = kept(last_wins(good.select("product_id", "product_name", "category", "unit_price", "_arrival"), ["product_id"]))
        firsts = first_wins(good.select(*SALE_COLUMNS, "email", "_arrival"), ["order_id"]).drop("_arrival")

        def unknown() -> tuple[DataFrame, str | None, str | None]:
            low, high = good.agg(F.min("order_id"), F.max("order_id")).first()
            # read again only where there are facts to compare with
            return self.unknown_orders(kept(firsts) if self.parts["fact_sales"] else firsts, low, high), low, high

        (_, houses), (old_products, shelves), (inserted, low, high) = together(
            self.spark, lambda: self._upsert("dim_customers", people, ["customer_name", "region"], now, cached, "customer_id"),
            lambda: self._upsert("dim_products", goods, ["product_name", "category", "unit_price"], now, cached),
            unknown)
        moved = (old_products.select("product_id", F.col("category").alias("_old")).join(goods.select("product_id", "category"), "product_id")
                 .where(~F.col("_old").eqNullSafe(F.col("category"))).select("product_id"))
        # Resolve customer ids through the batch's own e-mails only (one row
        # per e-mail, small enough for AQE to broadcast), so a hot e-mail on
        # the fact side never meets a shuffled dimension; AQE's skew-join
        # split covers the case where even this mapping is large.
        batch_ids = self._part("dim_customers", houses).select("email", "customer_id").join(people.select("email"), "email", "left_semi")
        inserted = (inserted.join(batch_ids, "email", "left")
                    .withColumn("processed_at", now)
                    .withColumn("sale_month", F.trunc("sale_date", "month")))
        base, counted = self.sequences.get("fact_sales", 0), []
        inserted = assign_ids(inserted.drop("email"), "sale_id", base, cached=cached, counted=counted)
        inserted = inserted.select(*SCHEMAS["fact_sales"].fieldNames())
        new_facts = self.spark.createDataFrame([], SCHEMAS["fact_sales"])
        if counted[0]:
            # Rebalance by month: few files per month, and AQE splits a hot month.
            new_facts = self._append("fact_sales", inserted.hint("rebalance", "sale_month"), partition="sale_month")
            self.sequences["fact_sales"] = base + counted[0]

        loaded = new_facts.groupBy("source_file").agg(F.count(F.lit(1)).cast("int").alias("rows_loaded"))
        runs = (verdicts.join(loaded, "source_file", "left")
                .select(F.lit(self.job_id).alias("dag_id"), now.alias("run_date"), "source_file",
                        F.when(F.col("status") == "success", F.coalesce("rows_loaded", F.lit(0)))
                        .otherwise(F.lit(0)).alias("rows_loaded"),
                        "status", F.col("error").alias("error_message"),
                        F.col("source_file").alias("_order")))
        if invalid is not None:
            runs = runs.unionByName(invalid.select(
                F.lit(self.job_id).alias("dag_id"), now.alias("run_date"), "source_file", F.lit(0).alias("rows_loaded"),
                F.lit("invalid").alias("status"), F.col("reason").alias("error_message"), F.col("source_file").alias("_order")))
        run_base = self.sequences.get("pipeline_runs", 0)
        n_runs: list[int] = []
        success = verdicts.where(F.col("status") == "success").select("source_file")
        # refresh only when at least one file loaded; "none" leaves the months pending
        refreshed = refresh != "none" and success.limit(1).count() > 0

        def note() -> DataFrame:
            stored = self._append("pipeline_runs", assign_ids(runs, "run_id", run_base, order="_order", cached=cached, counted=n_runs))
            self.parts["pipeline_runs"][-1]["rows"] = n_runs[0]
            self.sequences["pipeline_runs"] = run_base + n_runs[0]
            if listing is not None:
                self._append("loaded_files", listing.join(success, "source_file", "left_semi").withColumn("run_date", now).coalesce(1))
            if archive is not None:
                self._append("archive", archive[0].join(success, "source_file", "left_semi"))
                self.parts["archive"][-1]["to"] = archive[1]
            return stored

        def follow() -> list[str]:
            touched, pair = self._follow(new_facts, moved, shelves, rebuild=refreshed and refresh == "full")
            together(self.spark, pair, self.refresh_pending if refreshed else lambda: None)
            return touched

        def index() -> None:
            if counted[0]:
                self._index(new_facts, counted[0], low, high)

        stored_runs, touched, _ = together(self.spark, note, follow, index)
        return BatchReport(verdicts=verdicts, new_facts=new_facts, runs=stored_runs, annotated=ann, accepted=good,
                           refreshed=refreshed, touched_months=touched, discard=lambda: Files(self.spark, staged).delete(staged))

    # -- rollup ----------------------------------------------------------
    def _follow(self, new_facts: DataFrame, moved: DataFrame, shelves: list[str], rebuild: bool) -> tuple[list[str], Callable[[], None]]:
        """Adds new facts to the cube's months (``rebuild``: makes it anew from all facts).  Returns
        the months whose rollup rows can change - those, and every month of a product whose
        category changed - and the step that notes the months of the new facts' products.
        Months are bounded by the calendar."""
        known = self._part("product_months", shelves) if self.cells["product_months"] else None
        again = [] if known is None else known.join(moved, "product_id", "left_semi").select("month").distinct().collect()
        months = sorted(str(r[0]) for r in new_facts.select("sale_month").distinct().collect())
        if rebuild or (months and self.cells["sales_cube"] and not self.cells["month_customers"]):  # or no bitmaps from an older version
            self._rebuild_cube()
        elif months:
            cube, customers = cube_of(new_facts), customers_of(new_facts)
            held = {m: p for m, p in self.cells["sales_cube"].items() if m in set(months)}
            if held:
                sums = [F.sum(c).cast(SCHEMAS["sales_cube"][c].dataType).alias(c) for c in ("n", "units", "revenue", "n_amount")]
                cube = self._read_cells("sales_cube", held).unionByName(cube).groupBy(*CUBE_KEYS).agg(*sums)
                known_bits = {m: p for m, p in self.cells["month_customers"].items() if m in set(months)}
                customers = merged_customers(self._read_cells("month_customers", known_bits).unionByName(customers), "month", "region")
            self._write_cells("sales_cube", cube, months, F.col("month"))
            self._write_cells("month_customers", customers, months, F.col("month"))

        def pair() -> None:
            if not months:
                return
            pairs = self._read_cells("sales_cube", {m: self.cells["sales_cube"][m] for m in months}).select("product_id", "month").distinct()
            fresh = (pairs if known is None else pairs.join(known, ["product_id", "month"], "left_anti")).persist(StorageLevel.MEMORY_AND_DISK)
            buckets = self._buckets_in(fresh, "product_id")
            if buckets:
                rows = self._part("product_months", buckets).unionByName(fresh).distinct()
                self._write_cells("product_months", rows, buckets, self.bucket_of(F.col("product_id")))
            fresh.unpersist()

        touched = sorted({*months, *(str(r[0]) for r in again)})
        self.pending = sorted({*self.pending, *touched})
        return touched, pair

    def _rebuild_cube(self) -> None:
        """The cube and the bitmaps from all facts; every month's rollup is behind then."""
        facts = self.table("fact_sales")
        months = sorted(str(r[0]) for r in facts.select("sale_month").distinct().collect())
        self.cells["sales_cube"], self.cells["month_customers"], self.cells["mv_monthly_sales"], self.pending = {}, {}, {}, months
        if months:
            self._write_cells("sales_cube", cube_of(facts), months, F.col("month"))
            self._write_cells("month_customers", customers_of(facts), months, F.col("month"))

    def refresh_pending(self) -> None:
        """Makes the rollup of the months that are behind, from the cube's folders of these months alone."""
        if self.pending:
            cube = self._read_cells("sales_cube", {m: self.cells["sales_cube"][m] for m in self.pending})
            self._write_cells("mv_monthly_sales", rollup_of(cube, self.table("dim_products")), self.pending, F.col("month"))
        self.pending = []

    def refresh(self, full: bool = False) -> None:
        """Brings the rollup up to date and commits: the months that are behind, or all of them from the facts."""
        while True:
            before = self._state()
            if full:
                self._rebuild_cube()
            self.refresh_pending()
            if self._state() == before or self._commit(before):
                return
            self._catch_up()
