"""Set and multiset comparison of tables, and joins that show what either side lacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` has not."""
    return left.subtract(right)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` less those of ``right``, as often as they are over."""
    return left.exceptAll(right)


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether both have the same rows, each as often."""
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def full_outer_changes(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys on one side only or with any of ``columns`` distinct; NULLs are equal to each other."""
    a = left.select(*keys, *[F.col(c).alias(f"left_{c}") for c in columns], F.lit(True).alias("in_left"))
    b = right.select(*keys, *[F.col(c).alias(f"right_{c}") for c in columns], F.lit(True).alias("in_right"))
    joined = a.join(b, keys, "full_outer")
    changed = reduce(lambda x, y: x | y, [~F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")) for c in columns])
    status = (
        F.when(F.col("in_left").isNull(), "ONLY_RIGHT").when(F.col("in_right").isNull(), "ONLY_LEFT").when(changed, "CHANGED")
    )
    return joined.withColumn("status", status).where("status is not null").drop("in_left", "in_right")


def present(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_semi")


def missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_anti")
