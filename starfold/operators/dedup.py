"""First- and last-arrival per key as aggregates, not windows.

The extreme of a struct that begins with the order is a declarative aggregate, so Spark runs it as a
partial (map-side) aggregate before the shuffle: a key that holds a third of
all rows collapses to one row per input partition before it is exchanged.
With a struct payload the aggregate is sort-based (a struct buffer does not
fit the hash aggregate's fixed-width buffer), which spills gracefully.
A ``row_number()`` window would instead exchange every row and hold every
row of the hot key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: str, last: bool,
          keep_first_seen: str | None) -> DataFrame:
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys and c != order]
    # the order comes first in the struct, so its extreme is the row, and the buffer holds the order once
    rec = F.struct(F.col(order).alias(order), *[F.col(c) for c in payload])
    pick = F.max(rec) if last else F.min(rec)
    aggs = [pick.alias("_w")]
    if keep_first_seen:
        aggs.append(F.min(order).alias(keep_first_seen))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [*keys, *[F.col(f"_w.{c}").alias(c) for c in payload], F.col(f"_w.{order}").alias(order)]
    if keep_first_seen:
        cols.append(keep_first_seen)
    return out.select(*cols)


def first_wins(df: DataFrame, keys: Sequence[str], order: str = "_arrival") -> DataFrame:
    """One row per key: the earliest by ``order`` (unique per row)."""
    return _pick(df, keys, order, last=False, keep_first_seen=None)


def last_wins(df: DataFrame, keys: Sequence[str], order: str = "_arrival",
              first_seen: str | None = None) -> DataFrame:
    """One row per key: the latest by ``order``; optionally also the
    earliest ``order`` value seen for the key (for id allocation)."""
    return _pick(df, keys, order, last=True, keep_first_seen=first_seen)
