"""Station-day mart: rentals by rental day and station, returns by return day and station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.plans.calendar import month_bounds

COUNTS = ("rental_count", "return_count", "completed_trip_count", "unique_bike_count", "valid_distance_trip_count", "missing_return_count", "station_history_match_count")
COLUMNS = (
    "service_date", "station_no", "rental_count", "return_count", "completed_trip_count", "unique_bike_count",
    "avg_usage_min", "median_usage_min", "valid_distance_trip_count", "missing_return_count", "station_history_match_count",
)


def station_day(rentals: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per (day, station) with a rental or a return.

    ``rentals`` is the service month's fact; ``returns`` holds completed trips of any fact
    month that came back in it. Each side is summed first, then one full outer join of the
    sums gives the union of keys.
    """
    rented = rentals.groupBy(F.to_date("rent_at").alias("service_date"), F.col("rent_station_no").alias("station_no")).agg(
        F.count(F.lit(1)).alias("rental_count"),
        F.count_if("is_completed_trip").alias("completed_trip_count"),
        F.countDistinct("bike_id").alias("unique_bike_count"),
        F.avg("usage_min").alias("avg_usage_min"),
        F.median("usage_min").alias("median_usage_min"),
        F.count_if("distance_metric_eligible").alias("valid_distance_trip_count"),
        F.count_if(~F.col("is_completed_trip")).alias("missing_return_count"),
        F.count_if("station_history_match").alias("station_history_match_count"),
    )
    returned = returns.groupBy(F.to_date("return_at").alias("service_date"), F.col("return_station_no").alias("station_no")).agg(
        F.count(F.lit(1)).alias("return_count")
    )
    joined = rented.join(returned, ["service_date", "station_no"], "full_outer")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in COUNTS}).select(*COLUMNS)


def returns_of(facts: DataFrame, month: str) -> DataFrame:
    """Completed trips that came back in ``month``; the bounds reach the Parquet scan."""
    start, end = (F.lit(x).cast("timestamp_ntz") for x in month_bounds(month))
    return facts.where(F.col("is_completed_trip") & (F.col("return_at") >= start) & (F.col("return_at") < end))


def material_months(facts: DataFrame, month: str) -> DataFrame:
    """Fact months with a return in ``month``: source_month, return_count."""
    return returns_of(facts, month).groupBy("source_month").agg(F.count(F.lit(1)).alias("return_count"))


def impact_months(old: DataFrame | None, new: DataFrame, own: str, first: str, last: str) -> DataFrame:
    """Service months that a changed fact month touches: its own and those of its returns, old or new."""
    both = new if old is None else new.unionByName(old)
    months = both.where("is_completed_trip").select(F.date_format("return_at", "yyyy-MM").alias("service_month"))
    own_row = new.sparkSession.range(1).select(F.lit(own).alias("service_month"))
    return months.unionByName(own_row).distinct().where(F.col("service_month").between(first, last))
