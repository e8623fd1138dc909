"""The caller's rows carried whole through an Arrow stage.

A row travels as one struct beside the operator's own columns, so no name of the caller's can clash with one of the
operator's on the way; on the way out names are compared as Spark does, without case, and on equal ones the operator's win.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PORTION = 1_000_000


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of rows with about ``most`` bytes (of lists: items) each, one row at least."""
    start = held = 0
    length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    for i, size in enumerate(pc.fill_null(length(column), 0).to_pylist()):
        if held and held + size > most:
            yield start, i - start
            start, held = i, 0
        held += size
    if start < len(column):
        yield start, len(column) - start


def carried(docs: DataFrame, new: Sequence[str], row: Column) -> list[Column]:
    """The caller's columns out of the struct, without those named like a new one."""
    taken = {n.lower() for n in new}
    return [row[c].alias(c) for c in docs.columns if c.lower() not in taken]


def map_column(docs: DataFrame, column: str, kind: T.DataType, new: Sequence[T.StructField], work: Callable[[pa.Array], Sequence[pa.Array]],
               keep: Sequence[str] | None = None, most: int = PORTION) -> DataFrame:
    """``docs`` with the new columns that ``work`` makes of one column (text or binary), about ``most`` bytes at a time.

    ``kind`` is what that column is cast to. ``keep`` names the caller's columns that come along (None: all).
    """
    kept = docs if keep is None else docs.select(*(F.col(f"`{c}`") for c in keep))
    src = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept.columns)).alias("row"), F.col(f"`{column}`").cast(kind).alias("own"))
    schema = T.StructType([src.schema["row"], *(T.StructField(f"new{i}", f.dataType) for i, f in enumerate(new))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, length in slices(batch.column(1), most):
                part = batch.slice(start, length)
                yield pa.RecordBatch.from_arrays([part.column(0), *work(part.column(1))], names=schema.names)

    out = src.mapInArrow(run, schema)
    names = [f.name for f in new]
    return out.select(*carried(kept, names, F.col("row")), *(F.col(f"new{i}").alias(n) for i, n in enumerate(names)))
