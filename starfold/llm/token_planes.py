"""Token ids in files: chunks of whole documents, their ids in blocks turned into bit or byte planes, each plane
compressed with zstandard, and an index of the chunks.

One Parquet row is one chunk, so Spark's commit protocol guards the files, any store that Spark reads can hold them, and the
index columns (shard, chunk, first, n_ids) are read without the planes. A shard is one partition of the range of
doc_ids; chunks hold whole documents, so each is decoded alone and reading needs no shuffle.

A chunk's ids are padded with zeros to whole blocks of ``block`` ids. Byte planes: all lowest bytes of a block, then
all second bytes, and so on; plane p of a chunk is the p-th plane of its blocks, one after another. Bit planes
likewise with the 32 bits. High planes are nearly constant and shrink to almost nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starfold.llm.bpe import U4, coder
from starfold.llm.text import portions, strings, whole

BLOCK = 1024
CHUNK = 1 << 18


def to_planes(ids: np.ndarray, block: int = BLOCK, bits: bool = False) -> list[bytes]:
    """The planes of ids, 4 of bytes or 32 of bits, padded to whole blocks (a multiple of 8 ids)."""
    padded = np.zeros(-(-len(ids) // block) * block, U4)
    padded[: len(ids)] = ids
    cells = padded.view(np.uint8).reshape(-1, block, 4)
    if not bits:
        return [cells[:, :, p].tobytes() for p in range(4)]
    return [np.packbits((cells[:, :, p // 8] >> (p % 8)) & 1, axis=1).tobytes() for p in range(32)]


def from_planes(planes: list[bytes], n: int, block: int = BLOCK) -> np.ndarray:
    """The first n ids again."""
    if len(planes) == 4:
        cells = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        rows = [np.unpackbits(np.frombuffer(p, np.uint8)) for p in planes]
        cells = np.stack([sum(rows[8 * b + i] << i for i in range(8)) for b in range(4)], axis=1).astype(np.uint8)
    return np.ascontiguousarray(cells).view(U4).reshape(-1)[:n]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = 2, text: str = "text", doc_id: str = "doc_id",
                 chunk: int = CHUNK, block: int = BLOCK, bits: bool = False, level: int = 3, pattern: str | None = None) -> None:
    """Encodes the texts and writes them in ascending order of doc_id to ``path``.

    Defined cases: a null or empty text has only the end id; a null doc_id comes first; equal doc_ids are ordered by
    text, so the files are the same after a retry; a text longer than a chunk makes a chunk of its own; an empty
    table gives a folder without chunks. Other columns aren't stored.
    """
    src = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    src = src.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    kind = src.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("chunk", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("n_ids", T.LongType()),
                           T.StructField("block", T.IntegerType()), T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("planes", T.ArrayType(T.BinaryType()))])
    arrow = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("block", pa.int32()), ("doc_ids", pa.list_(to_arrow_type(kind))), ("sizes", pa.list_(pa.int64())), ("planes", pa.list_(pa.binary()))])
    end = b"" if end_id is None else np.array([end_id], U4).tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shard, coded, pack = TaskContext.get().partitionId(), coder(vocabulary, pattern), zstandard.ZstdCompressor(level=level)
        n_chunk = first = held = 0
        names, parts = [], []

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), U4)
            row = {"shard": shard, "chunk": n_chunk, "first": first, "n_ids": len(ids), "block": block, "doc_ids": names, "sizes": [len(p) // 4 for p in parts], "planes": [pack.compress(p) for p in to_planes(ids, block, bits)]}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in portions(batches, "text", 2_000_000):
            for name, ids in zip(batch.column("doc_id").to_pylist(), coded.encode(strings(batch.column("text"))), strict=True):
                names.append(name)
                parts.append(ids + end)
                held += len(parts[-1]) // 4
                if held >= chunk:
                    yield close()
                    n_chunk, first, held, names, parts = n_chunk + 1, first + held, 0, [], []
        if names:
            yield close()

    src.mapInArrow(run, schema).write.parquet(path)


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """(shard, chunk, start, n_ids): where each chunk begins among all ids. Reads no planes."""
    chunks = spark.read.parquet(path).select("shard", "chunk", "first", "n_ids")
    return chunks.join(F.broadcast(shard_starts(chunks)), "shard").select("shard", "chunk", (F.col("before") + F.col("first")).alias("start"), "n_ids")


def shard_starts(chunks: DataFrame) -> DataFrame:
    """(shard, before): ids of all shards before; a row for each partition that wrote, so it can be broadcast."""
    sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents from the files: doc_id, start (ids of all documents before), n_tokens, ids (binary)."""
    chunks = spark.read.parquet(path)
    placed = chunks.join(F.broadcast(shard_starts(chunks.select("shard", "n_ids"))), "shard")
    src = placed.select((F.col("before") + F.col("first")).alias("start"), "n_ids", "block", "doc_ids", "sizes", "planes")
    kind = chunks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = from_planes([unpack.decompress(p) for p in row["planes"]], row["n_ids"], row["block"])
                sizes = np.array(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                raw = ids.tobytes()
                own = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type), pa.array(row["start"] + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(own, pa.binary())], names=schema.names)

    return src.mapInArrow(run, schema)
