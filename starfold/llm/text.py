"""Column expressions and small Arrow helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The characters [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
#: Java pattern of what separates the words of a text: everything but 0-9, a-z and code points from 128 on.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def whole(text: str | Column) -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is (``lower`` alone also changes letters beyond ASCII)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: str | Column) -> Column:
    """Lower-cased words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a text, in order; null has none."""
    return F.array_remove(F.split(ascii_lower(whole(text)), NOT_WORD), "")


def hash_pair(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with unlike seeds: 128 bits name a text, a line or a window."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)


def put(docs: DataFrame, row: str, **new: Column) -> list[Column]:
    """The input's columns out of the struct ``row``, and the operator's own; on equal names the operator's win."""
    lower = {n.lower() for n in new}
    return [F.col(row)[c].alias(c) for c in docs.columns if c.lower() not in lower] + [v.alias(n) for n, v in new.items()]


def strings(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as the empty string."""
    return [x or "" for x in column.to_pylist()]


def portions(batches: Iterable[pa.RecordBatch], column: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each (one row at least), so that memory doesn't
    depend on how many rows Spark puts into a batch."""
    for batch in batches:
        start, held = 0, 0
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
