"""The trip view over the driver's tables that the catalogue's queries share.

A line item is a trip of bike ``l_partkey``: it leaves station ``o_custkey % 50`` at the
order date and arrives at ``l_suppkey % 50`` at the ship date. First line items that are
flagged ``N`` have no return station.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trip_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    no_return = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1)
    trips = items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("l_partkey").cast("string").alias("bike_id"),
        F.col("o_orderdate").alias("rent_at"),
        (F.col("o_custkey") % 50).cast("string").alias("rent_station_no"),
        F.col("l_shipdate").alias("return_at"),
        F.when(~no_return, (F.col("l_suppkey") % 50).cast("string")).alias("return_station_no"),
        F.col("l_quantity").cast("bigint").alias("usage_min"),
        F.col("l_extendedprice").cast("decimal(38,18)").alias("distance_m"),
    )
    completed = (F.col("return_at") >= F.col("rent_at")) & F.col("return_station_no").isNotNull()
    eligible = (F.col("distance_m") > 0) & (F.col("distance_m") <= 100000)
    return trips.withColumns(
        {
            "is_completed_trip": F.coalesce(completed, F.lit(False)),
            "distance_metric_eligible": F.coalesce(eligible, F.lit(False)),
        }
    )


#: The same view for DuckDB, as a common table expression named ``trips``.
TRIPS_SQL = """
trips AS (
  SELECT CAST(l_partkey AS VARCHAR) AS bike_id, o_orderdate AS rent_at,
         CAST(o_custkey % 50 AS VARCHAR) AS rent_station_no, l_shipdate AS return_at,
         CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN NULL
              ELSE CAST(l_suppkey % 50 AS VARCHAR) END AS return_station_no,
         CAST(l_quantity AS BIGINT) AS usage_min,
         CAST(l_extendedprice AS DECIMAL(38,18)) AS distance_m,
         COALESCE(l_shipdate >= o_orderdate
                  AND NOT (l_returnflag = 'N' AND l_linenumber = 1), FALSE) AS is_completed_trip,
         COALESCE(l_extendedprice > 0 AND l_extendedprice <= 100000, FALSE)
                  AS distance_metric_eligible
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
