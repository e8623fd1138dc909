"""Intermediate tables in the shared folder, and joins with hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starfold.session import fresh_path


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: cut from its lineage, its size known to the planner."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def loose(grouped: DataFrame) -> DataFrame:
    """A grouped frame without its partitioning. A join that could use that partitioning would keep all rows of a hot key
    on the other side in one task; with a shuffle of its own on both sides, adaptive execution splits them."""
    return grouped.hint("rebalance")
