"""Marts and dimensions over the trip view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.plans.calendar import dim_date
from tripwright.plans.od_day import od_day
from tripwright.plans.station_day import impact_months, material_months, returns_of, station_day
from tripwright.queries.trips import TRIPS_SQL, trip_view

MONTH = "1997-03"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six digits: engines add in different orders."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    trips = trip_view(spark, sf)
    return trips.withColumns(
        {"source_month": F.date_format("rent_at", "yyyy-MM"), "station_history_match": F.col("rent_station_no").cast("int") % 3 != 0}
    )


def q_station_day(spark: SparkSession, sf: str) -> DataFrame:
    facts = _facts(spark, sf)
    out = station_day(facts, facts.where("is_completed_trip"))
    return rounded(out, "avg_usage_min")


def q_station_day_month(spark: SparkSession, sf: str) -> DataFrame:
    facts = _facts(spark, sf)
    out = station_day(facts.where(F.col("source_month") == MONTH), returns_of(facts.where(F.col("source_month") <= MONTH), MONTH))
    return rounded(out, "avg_usage_min")


def q_material(spark: SparkSession, sf: str) -> DataFrame:
    return material_months(_facts(spark, sf), MONTH)


def q_impact(spark: SparkSession, sf: str) -> DataFrame:
    facts = _facts(spark, sf).where(F.col("source_month") == MONTH)
    old = facts.where("usage_min < 25")
    new = facts.where("usage_min >= 20")
    return impact_months(old, new, MONTH, "1995-01", "1997-05")


def q_late_returns(spark: SparkSession, sf: str) -> DataFrame:
    """Completed trips by how many months after the rental month they came back."""
    first = lambda c: F.trunc(F.to_date(c), "MM")
    late = F.months_between(first("return_at"), first("rent_at")).cast("int")
    return _facts(spark, sf).where("is_completed_trip").groupBy("source_month", late.alias("months_late")).agg(
        F.count(F.lit(1)).alias("trip_count"), F.max(F.to_date("return_at")).alias("last_return")
    )


def q_verification(spark: SparkSession, sf: str) -> DataFrame:
    return _facts(spark, sf).groupBy("source_month").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("bike_id").alias("bike_count"),
        F.min("rent_at").cast("string").alias("first_rent_at"),
        F.max("rent_at").cast("string").alias("last_rent_at"),
        F.sum("usage_min").alias("usage_sum"),
        F.count_if(F.col("return_station_no").isNull()).alias("null_returns"),
    )


_STATION_DAY_SQL = """
, rented AS (
  SELECT CAST(rent_at AS DATE) AS service_date, rent_station_no AS station_no, COUNT(*) AS rental_count,
         COUNT(*) FILTER (WHERE is_completed_trip) AS completed_trip_count, COUNT(DISTINCT bike_id) AS unique_bike_count,
         ROUND(AVG(usage_min), 6) AS avg_usage_min, CAST(MEDIAN(usage_min) AS DOUBLE) AS median_usage_min,
         COUNT(*) FILTER (WHERE distance_metric_eligible) AS valid_distance_trip_count,
         COUNT(*) FILTER (WHERE NOT is_completed_trip) AS missing_return_count,
         COUNT(*) FILTER (WHERE CAST(rent_station_no AS INTEGER) % 3 <> 0) AS station_history_match_count
  FROM trips WHERE {rented} GROUP BY 1, 2),
returned AS (
  SELECT CAST(return_at AS DATE) AS service_date, return_station_no AS station_no, COUNT(*) AS return_count
  FROM trips WHERE is_completed_trip AND {returned} GROUP BY 1, 2),
keys AS (SELECT service_date, station_no FROM rented UNION SELECT service_date, station_no FROM returned)
SELECT service_date, station_no, COALESCE(rental_count, 0) AS rental_count, COALESCE(return_count, 0) AS return_count,
       COALESCE(completed_trip_count, 0) AS completed_trip_count, COALESCE(unique_bike_count, 0) AS unique_bike_count,
       avg_usage_min, median_usage_min, COALESCE(valid_distance_trip_count, 0) AS valid_distance_trip_count,
       COALESCE(missing_return_count, 0) AS missing_return_count,
       COALESCE(station_history_match_count, 0) AS station_history_match_count
FROM keys LEFT JOIN rented USING (service_date, station_no) LEFT JOIN returned USING (service_date, station_no)"""

QUERIES = {
    "od_day": lambda spark, sf: rounded(
        od_day(trip_view(spark, sf)), "avg_usage_min", "valid_distance_avg", "valid_distance_median"
    ),
    "station_day": q_station_day,
    "station_day_month": q_station_day_month,
    "dim_calendar": lambda spark, sf: dim_date(spark),
    "material_lineage_months": q_material,
    "revision_impact_months": q_impact,
    "return_late_months": q_late_returns,
    "verification_metrics": q_verification,
}

ORACLES = {
    "od_day": f"""WITH {TRIPS_SQL}
SELECT CAST(rent_at AS DATE) AS service_date, rent_station_no AS origin_station_no,
       return_station_no AS destination_station_no, CAST(COUNT(*) AS BIGINT) AS trip_count,
       CAST(COUNT(DISTINCT bike_id) AS BIGINT) AS unique_bike_count,
       ROUND(AVG(usage_min), 6) AS avg_usage_min,
       CAST(MEDIAN(usage_min) AS DOUBLE) AS median_usage_min,
       CAST(COUNT(*) FILTER (WHERE distance_metric_eligible) AS BIGINT) AS valid_distance_trip_count,
       ROUND(CAST(AVG(distance_m) FILTER (WHERE distance_metric_eligible) AS DOUBLE), 6) AS valid_distance_avg,
       ROUND(CAST(MEDIAN(distance_m) FILTER (WHERE distance_metric_eligible) AS DOUBLE), 6) AS valid_distance_median
FROM trips WHERE is_completed_trip GROUP BY 1, 2, 3""",
    "station_day": f"WITH {TRIPS_SQL}" + _STATION_DAY_SQL.format(rented="TRUE", returned="TRUE"),
    "station_day_month": f"WITH {TRIPS_SQL}"
    + _STATION_DAY_SQL.format(
        rented=f"strftime(rent_at, '%Y-%m') = '{MONTH}'",
        returned=f"strftime(rent_at, '%Y-%m') <= '{MONTH}' AND strftime(return_at, '%Y-%m') = '{MONTH}'",
    ),
    "dim_calendar": """SELECT CAST(d AS DATE) AS date, CAST(EXTRACT(YEAR FROM d) AS INTEGER) AS year,
       CAST(EXTRACT(MONTH FROM d) AS INTEGER) AS month, CAST(EXTRACT(DAY FROM d) AS INTEGER) AS day,
       CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) >= 6 AS weekend_flag
FROM generate_series(DATE '2020-01-01', DATE '2026-06-30', INTERVAL 1 DAY) AS s(d)""",
    "material_lineage_months": f"""WITH {TRIPS_SQL}
SELECT strftime(rent_at, '%Y-%m') AS source_month, COUNT(*) AS return_count FROM trips
WHERE is_completed_trip AND strftime(return_at, '%Y-%m') = '{MONTH}' GROUP BY 1""",
    "revision_impact_months": f"""WITH {TRIPS_SQL},
f AS (SELECT * FROM trips WHERE strftime(rent_at, '%Y-%m') = '{MONTH}'),
m AS (SELECT strftime(return_at, '%Y-%m') AS service_month FROM f WHERE is_completed_trip AND usage_min < 25
      UNION SELECT strftime(return_at, '%Y-%m') FROM f WHERE is_completed_trip AND usage_min >= 20
      UNION SELECT '{MONTH}')
SELECT service_month FROM m WHERE service_month BETWEEN '1995-01' AND '1997-05'""",
    "return_late_months": f"""WITH {TRIPS_SQL}
SELECT strftime(rent_at, '%Y-%m') AS source_month,
       CAST(date_diff('month', date_trunc('month', rent_at), date_trunc('month', return_at)) AS INTEGER) AS months_late,
       COUNT(*) AS trip_count, MAX(CAST(return_at AS DATE)) AS last_return
FROM trips WHERE is_completed_trip GROUP BY 1, 2""",
    "verification_metrics": f"""WITH {TRIPS_SQL}
SELECT strftime(rent_at, '%Y-%m') AS source_month, COUNT(*) AS row_count, COUNT(DISTINCT bike_id) AS bike_count,
       strftime(MIN(rent_at), '%Y-%m-%d %H:%M:%S') AS first_rent_at, strftime(MAX(rent_at), '%Y-%m-%d %H:%M:%S') AS last_rent_at,
       CAST(SUM(usage_min) AS BIGINT) AS usage_sum, COUNT(*) FILTER (WHERE return_station_no IS NULL) AS null_returns
FROM trips GROUP BY 1""",
}
