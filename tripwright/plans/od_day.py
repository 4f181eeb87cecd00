"""Origin-destination-day mart: completed trips by rental day and station pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def od_day(fact: DataFrame) -> DataFrame:
    """One row per (service_date, origin, destination) over completed trips.

    Usage metrics skip null usage; distance metrics cover eligible trips only and are
    NULL where a group has none.
    """
    eligible = F.when(F.col("distance_metric_eligible"), F.col("distance_m"))
    return (
        fact.where("is_completed_trip")
        .groupBy(
            F.to_date("rent_at").alias("service_date"),
            F.col("rent_station_no").alias("origin_station_no"),
            F.col("return_station_no").alias("destination_station_no"),
        )
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.countDistinct("bike_id").alias("unique_bike_count"),
            F.avg("usage_min").alias("avg_usage_min"),
            F.median("usage_min").alias("median_usage_min"),
            F.count_if("distance_metric_eligible").alias("valid_distance_trip_count"),
            F.avg(eligible).cast("double").alias("valid_distance_avg"),
            F.median(eligible.cast("double")).alias("valid_distance_median"),
        )
    )
