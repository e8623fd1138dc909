"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The library's byte-level models spell bytes as printable characters (the byte table). A file of ranks has bytes, so
its tokens are spelled by that table and its merges are found from the ranks: every way to cut a token into two
tokens is a merge, and merges go by the rank of what they make, which is the order in which tiktoken merges.
Decoding reverses the table. Tokens may hold a part of a character: its bytes come together when the whole text is
decoded, and in offsets each of those tokens gets the whole character.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.llm.chunks import ChunkCoder
from starfold.llm.text import portions, put, strings, whole

U4 = np.dtype("<u4")


def byte_table() -> list[str]:
    """The character that spells each byte: itself if it is printable and no space, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in shown else next(other)) for b in range(256)]


def spell(token: bytes) -> str:
    table = byte_table()
    return "".join(table[b] for b in token)


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from lines of base64 and a number."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def from_ranks(path: str, pattern: str):
    """A tokenizer that encodes each match of the pattern by the ranks."""
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    table = byte_table()
    by = sorted(ranks(path).items(), key=lambda x: x[1])
    name = {token: "".join(table[b] for b in token) for token, _ in by}
    merges = [(name[token[:i]], name[token[i:]]) for token, _ in by for i in range(1, len(token)) if token[:i] in name and token[i:] in name]
    made = Tokenizer(models.BPE(vocab={name[token]: rank for token, rank in by}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "removed", invert=True), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    made.decoder = decoders.ByteLevel()
    return made


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str | None):
    """A tokenizer from a file of the library, or from ranks where a pattern comes with them."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return from_ranks(path, pattern) if pattern else Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def coder(path: str, pattern: str | None) -> ChunkCoder:
    """One for each Python worker: the dictionary outlives a task."""
    library = tokenizer(path, pattern)

    def encode_many(texts):
        return [as_bytes(e.ids) for e in library.encode_batch_fast(list(texts), add_special_tokens=False)] if texts else []

    sizes = np.array([len(x) for x in token_bytes(path, pattern)], np.int64)
    return ChunkCoder(encode_many, [t.content for t in library.get_added_tokens_decoder().values()], sizes=sizes)


@lru_cache(maxsize=4)
def token_bytes(path: str, pattern: str | None) -> tuple[bytes, ...]:
    """The bytes of each id, by the reversed byte table; those of an added token are its text."""
    back = {c: b for b, c in enumerate(byte_table())}
    library = tokenizer(path, pattern)
    added = library.get_added_tokens_decoder()
    vocabulary = library.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        out[i] = token.encode() if i in added else bytes(back[c] for c in token)
    return tuple(out)


def decode_ids(ids: bytes, table: tuple[bytes, ...]) -> bytes:
    """The bytes of a text from the bytes of its ids."""
    return b"".join(map(table.__getitem__, np.frombuffer(ids, U4).tolist()))


def spans(ids: bytes, table: tuple[bytes, ...]) -> list[tuple[int, int]]:
    """First and last-but-one character of each token; a token that holds a part of a character gets all of it."""
    sizes = np.array([len(table[i]) for i in np.frombuffer(ids, U4).tolist()], dtype=np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(decode_ids(ids, table), np.uint8)
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters that begin before each byte
    starts = ends - sizes
    first = np.where(starts < len(raw), heads[np.minimum(starts + 1, len(raw))] - 1, heads[-1])
    return list(zip(np.maximum(first, 0).tolist(), heads[ends].tolist(), strict=True))


def encode(docs: DataFrame, path: str, pattern: str | None = None, text: str = "text", offsets: bool = False) -> DataFrame:
    """The documents with ids (binary: little-endian unsigned 32-bit integers) and n_tokens; with ``offsets`` also
    spans, an array of the characters [first, end) of each token.

    Defined cases: a null or empty text has no ids; texts of any length are encoded whole, a few megabytes of text at
    a time; each row is encoded on its own, so repeated rows repeat; columns named like the new ones are replaced.
    """
    kept = put(docs, "row", _text=whole(F.col("row")[text]))
    new = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    if offsets:
        pair = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())])
        new.append(T.StructField("spans", T.ArrayType(pair)))
    src = docs.select(F.struct("*").alias("row")).select(*kept)
    src = src.select("_text", *(F.col(f"`{c}`") for c in src.columns if c not in ("_text", *(f.name for f in new))))
    rest = [f for f in src.schema.fields if f.name != "_text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, table = coder(path, pattern), token_bytes(path, pattern)
        for batch in portions(batches, "_text"):
            ids = coded.encode(strings(batch.column("_text")))
            own = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if offsets:
                kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
                own.append(pa.array([[{"first": a, "end": b} for a, b in spans(x, table)] for x in ids], kind))
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in rest] + own, names=[f.name for f in (*rest, *new)])

    return src.mapInArrow(run, T.StructType([*rest, *new]))


def decode(coded: DataFrame, path: str, pattern: str | None = None, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the bytes of the text (binary; UTF-8 if the ids are those of a whole text).
    Null or no ids give no bytes. An id outside the vocabulary fails."""
    rest = [f for f in coded.schema.fields if f.name != "decoded"]
    src = coded.select(*(F.col(f"`{f.name}`") for f in rest))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path, pattern)
        for batch in portions(batches, ids):
            out = pa.array([decode_ids(x or b"", table) for x in batch.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*(f.name for f in rest), "decoded"])

    return src.mapInArrow(run, T.StructType([*rest, T.StructField("decoded", T.BinaryType())]))
