"""Observed station states as intervals (gaps and islands over snapshots)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATE = ("station_name", "district", "address", "latitude", "longitude", "lcd_capacity", "qr_capacity", "operation_mode")
LISTS = {"observation_period": "observation_periods", "station_version_id": "station_version_ids", "source_version_id": "source_version_ids"}


def catalogue(snapshots: DataFrame) -> DataFrame:
    """Numbers snapshots (period, precision) by the day they apply from.

    A day's observation applies that day; a month's from the first day of the next month.
    Snapshots are a few dozen rows of control data, so one ordered window is enough.
    """
    day = F.to_date(F.col("observation_period"))
    month = F.add_months(F.to_date(F.concat("observation_period", F.lit("-01"))), 1)
    start = F.when(F.col("observation_precision") == "DAY", day).otherwise(month)
    dated = snapshots.withColumn("applicable_from", start)
    order = Window.orderBy("applicable_from", "observation_period")
    return dated.withColumn("snapshot_seq", F.row_number().over(order))


def islands(
    observations: DataFrame, snapshots: DataFrame, key: str = "station_no", state: tuple[str, ...] = STATE, lists: dict[str, str] = LISTS
) -> DataFrame:
    """One row per run of equal states over consecutive snapshots of a key.

    A run ends where a snapshot misses the key or any state column is distinct (NULLs equal
    each other). It applies until the snapshot after its last one, or for good.
    """
    w = Window.partitionBy(key).orderBy("snapshot_seq")
    lagged = {f"_was_{c}": F.lag(c).over(w) for c in ("snapshot_seq", *state)}
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in state])
    starts = F.col("_was_snapshot_seq").isNull() | (F.col("snapshot_seq") != F.col("_was_snapshot_seq") + 1) | differs
    run = F.sum(F.when(starts, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = observations.withColumns(lagged).withColumn("_run", run)
    in_order = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("snapshot_seq", c))), lambda x: x[c])
    collapsed = marked.groupBy(key, "_run").agg(
        F.max("snapshot_seq").alias("_last"),
        F.min("applicable_from").alias("applicable_from"),
        *[F.min_by(c, "snapshot_seq").alias(c) for c in state],
        *[in_order(c).alias(n) for c, n in lists.items()],
        F.count(F.lit(1)).cast("int").alias("observation_count"),
    )
    following = snapshots.select((F.col("snapshot_seq") - 1).alias("_last"), F.col("applicable_from").alias("applicable_until"))
    out = collapsed.join(F.broadcast(following), "_last", "left")  # one row per snapshot
    return out.select(key, "applicable_from", "applicable_until", *state, *lists.values(), "observation_count")
