"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_DAY, LAST_DAY = "2020-01-01", "2026-06-30"


def dim_date(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """A row per day; day_of_week counts from Monday = 1, weekend_flag is Saturday or Sunday."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    date = F.col("date")
    weekday = (F.weekday(date) + 1).cast("int")
    return spark.range(1).select(F.explode(days).alias("date")).select(
        "date", F.year(date).alias("year"), F.month(date).alias("month"), F.dayofmonth(date).alias("day"),
        weekday.alias("day_of_week"), (weekday >= 6).alias("weekend_flag"),
    )


def months_between(first: str, last: str) -> list[str]:
    """yyyy-MM of every month from first to last, both included."""
    (a, b), (c, d) = (map(int, m.split("-")) for m in (first, last))
    return [f"{k // 12:04d}-{k % 12 + 1:02d}" for k in range(a * 12 + b - 1, c * 12 + d)]


def month_bounds(month: str) -> tuple[str, str]:
    """First instants of the month and of the next."""
    following = months_between(month, "9999-12")[1]
    return f"{month}-01 00:00:00", f"{following}-01 00:00:00"
