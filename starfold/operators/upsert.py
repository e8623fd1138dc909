"""Set-based keyed writes with the warehouse's three conflict policies.

* ``upsert``        last write wins on ``update_cols``; id and created_at of an
                    existing key are kept; new keys get fresh ids.
* ``insert_ignore`` first write wins; keys already present are ignored, and
                    so are later duplicates inside the incoming batch.

Both reduce the incoming batch to one row per key with a partial aggregate
(``dedup``), so the joins against the current table are key-unique on both
sides: no skew can remain after the reduction.  The existing table is joined
with a left outer join (its untouched rows stream through; the reduced batch
is the build side, broadcast by AQE when it proves small) and new keys are
found by semi-joining the table's key column with the reduced batch (the
batch is the build side) and anti-joining the batch with that small result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import first_wins, last_wins
from .surrogate import assign_ids, max_id


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str], order: str = "_arrival",
           id_col: str | None = None, created_col: str | None = "created_at",
           now: Column | None = None, id_order: str | None = None,
           id_base: int | None = None, cached: list | None = None,
           counted: list | None = None, reduced: bool = False) -> DataFrame:
    """``reduced``: ``incoming`` has one row per key already, with ``_first_seen`` where ``id_order`` names it.  ``id_order="_first_seen"`` numbers new keys by first arrival (one
    extra range-partitioning pass); ids are otherwise dense but unordered."""
    keys, update_cols = list(keys), list(update_cols)
    now = now if now is not None else F.current_timestamp()
    latest = incoming if reduced else last_wins(incoming.select(*keys, *update_cols, order), keys, order,
                                                first_seen="_first_seen")
    hits = latest.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in update_cols],
                         F.lit(True).alias("_hit"))
    carried = [c for c in current.columns if c not in keys and c not in update_cols]
    kept = (current.join(hits, keys, "left")
            .select(*keys, *carried,
                    *[F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)
                      for c in update_cols]))
    fresh = latest.join(_present(current, latest, keys), keys, "left_anti")
    if created_col:
        fresh = fresh.withColumn(created_col, now)
    if id_col:
        base = max_id(current, id_col) if id_base is None else id_base
        fresh = assign_ids(fresh, id_col, base, order=id_order, cached=cached, counted=counted)
    fresh = fresh.select(*[F.col(c) for c in current.columns])
    return kept.select(*current.columns).unionByName(fresh)


def insert_ignore(current_keys: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order: str = "_arrival") -> DataFrame:
    """Rows of ``incoming`` that would be inserted: first arrival per key,
    and only keys absent from ``current_keys``."""
    keys = list(keys)
    firsts = first_wins(incoming, keys, order)
    return firsts.join(_present(current_keys, firsts, keys), keys, "left_anti")


def _present(current: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``batch`` that already exist in ``current``.

    The big table is the streamed side of a semi join whose build side is
    the (deduplicated, usually small) batch, so AQE can broadcast the batch
    and the table's key column is scanned without being shuffled; the batch
    is then anti-joined against this small result.  A direct
    ``batch LEFT ANTI current`` could only build on the big side."""
    return current.select(*keys).join(batch.select(*keys), keys, "left_semi")
