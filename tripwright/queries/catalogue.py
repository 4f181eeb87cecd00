"""Queries over the driver's tables, one per operator family, with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripwright.queries import marts, rules, sets, stations

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

for _module in (marts, rules, sets, stations):
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
