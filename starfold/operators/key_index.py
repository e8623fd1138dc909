"""Which folders may hold a key: a blocked Bloom filter for each folder of rows.

A key belongs to one block of a folder's filter, by its hash, and sets ``HASHES`` of the block's 32,768 bits. A folder of n keys
has 2 ** level blocks, the fewest that give each key ``BITS_PER_KEY`` bits, so a block is the same for all folders of a
level, and all their filters are asked with one join on it. The filters are built and asked with Spark's bitmap functions.

A filter never says no to a key that is there, so reading only the folders that may hold one of the keys is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BITS = 32_768  # of Spark's bitmap functions
BITS_PER_KEY, HASHES = 24, 8


def level_for(n: int) -> int:
    """The fewest halvings of the keys that leave room for all of them."""
    return max(0, (max(0, n * BITS_PER_KEY - 1) // BLOCK_BITS).bit_length())


def _block(key: Column, level: int) -> Column:
    return F.xxhash64(F.lit(0), key).bitwiseAND(F.lit((1 << level) - 1)).cast("int")


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(BLOCK_BITS)) for i in range(1, HASHES + 1)]


def filter_of(keys: DataFrame, key: str, n: int) -> DataFrame:
    """(block, bits) of a folder's n keys. The keys are dealt by block, and the bits are set where a block's keys are: a bitmap
    before the shuffle would be one of each block in each task, tasks times blocks of them."""
    level = level_for(n)
    dealt = keys.select(_block(F.col(key), level).alias("block"), F.col(key).alias("_key")).repartition("block")
    each = dealt.select("block", F.explode(F.array(*_bits(F.col("_key")))).alias("bit"))
    return each.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1


def folders_with(spark: SparkSession, keys: DataFrame, key: str, filters: Sequence[tuple[int, str]]) -> set[str]:
    """Of the filters (level, path; stored by ``filter_of``) the paths of those that may hold a key of ``keys``.

    A key meets the one block of each filter that could name it; only paths, one for each filter at most, reach the driver.
    """
    found: set[str] = set()
    for level in sorted({level for level, _ in filters}):
        paths = [path for own, path in filters if own == level]
        blocks = spark.read.schema("block int, bits binary").parquet(*paths)
        blocks = blocks.select("block", "bits", F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("folder"))
        hit = keys.select(_block(F.col(key), level).alias("block"), F.col(key).alias("_key")).join(blocks, "block")
        for bit in _bits(F.col("_key")):
            hit = hit.where(_set(F.col("bits"), bit))
        names = {r["folder"] for r in hit.select("folder").distinct().collect()}
        found |= {p for p in paths if p.rstrip("/").rpartition("/")[2] in names}
    return found
