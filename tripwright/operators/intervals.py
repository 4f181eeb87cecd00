"""Half-open validity intervals: as-of join, overlap check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Interval tables up to this many rows are broadcast (a history has about fifteen thousand).
MAX_BROADCAST_ROWS = 500_000


def interval_join(rows: DataFrame, intervals: DataFrame, key: Column, at: Column, rows_known: int | None = None) -> DataFrame:
    """``rows`` with the interval of ``key`` that holds ``at``, NULLs where there is none.

    ``intervals`` has key, valid_from, valid_until (NULL: open) and does not overlap. It is
    broadcast if ``rows_known`` says that it is small; else Spark chooses, and the equi-key
    keeps either a hash or a merge join possible.
    """
    side = F.broadcast(intervals) if rows_known is not None and rows_known <= MAX_BROADCAST_ROWS else intervals
    inside = (at >= F.col("valid_from")) & (F.col("valid_until").isNull() | (at < F.col("valid_until")))
    return rows.join(side, (key == F.col("key")) & inside, "left")


def overlaps(intervals: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Intervals that begin before the one before them (by start) has ended."""
    w = Window.partitionBy(key).orderBy(start)
    marked = intervals.withColumns({"previous_until": F.lag(end).over(w), "nth": F.row_number().over(w)})
    bad = (F.col("nth") > 1) & (F.col("previous_until").isNull() | (F.col("previous_until") > F.col(start)))
    return marked.where(bad).drop("nth")
