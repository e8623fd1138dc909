"""Session construction and the shared work folder.

All intermediate and warehouse tables live under the folder the cluster
names in ``spark.checkpoint.dir`` (a shared file system on a real cluster).
Only when that setting is absent *and* Spark runs in local mode do we create
a scratch folder ourselves, as tests do.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a production job wants regardless of scale.  Partition counts are
# left to the caller/cluster; AQE coalesces and splits at runtime.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.maxMetadataStringLength": "1000",
    # HotSpot compiles no method above 8,000 bytes of bytecode: a larger one, as the cleaning makes, would be interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # the files of a query's shuffles go with the query; else they stay until the driver's next full collection finds them unused
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "starfold", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Session-level SQL settings that can be changed on a running session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static or locked conf on a managed cluster
                pass


# Of compressed column files, what one task of a join or sort takes without spilling (some 250,000 line items)
BYTES_PER_PARTITION = 4 << 20
# What a scan's task reads at most, for the same reason: a compressed megabyte of columns is several in a sort
LARGEST_SCAN = 32 << 20
# Of the largest table's compressed files, what one job turns into text: its shuffles are on disk beside the text written so far
BYTES_PER_SLICE = 1536 << 20


def _bytes(text: str) -> int:
    """A size as Spark's settings have it: 134217728b, 64MB, 16m."""
    number = text.strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(number[-1:], 0)
    return int(number[:-1] if unit else number) << unit


def size_partitions(spark: SparkSession, table: str) -> int:
    """As many shuffle partitions to begin with as the size of the largest table asks for (AQE puts small ones together),
    and scan tasks of at most ``LARGEST_SCAN``.  Settings that are finer already stay.  Returns the table's bytes."""
    size = int(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table).agg({"length": "sum"}).first()[0] or 0)
    own = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BYTES_PER_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(own))
    if _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) > LARGEST_SCAN:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(LARGEST_SCAN))
    return size


def fix_splits(spark: SparkSession) -> None:
    """Scans of the same files are cut in the same way from here on, whatever executors come or go: the least number of
    tasks would else follow the cores of the moment."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created only for local sessions."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
    root = tempfile.mkdtemp(prefix="starfold-ckpt-", dir="/tmp")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return "/".join([checkpoint_root(spark), "starfold", *parts])


def fresh_path(spark: SparkSession, name: str) -> str:
    """A never-before-used folder for a new table version."""
    return work_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
