"""Trusted trips with the station interval that held at their rental date; the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.operators.intervals import interval_join
from tripwright.operators.issues import ISSUES, WARNING, issue, issue_list, warning_count
from tripwright.schemas import FACT_COLUMNS

UNMATCHED = "no applicable observed station-history interval exists at rental date; future observations are not used"


def enrich(clean: DataFrame, history: DataFrame, history_rows: int | None = None) -> DataFrame:
    """Trusted rows of ``clean`` with the matched interval, station_history_match and its warning."""
    intervals = history.select(
        F.col("station_no").alias("key"), F.col("applicable_from").alias("valid_from"), F.col("applicable_until").alias("valid_until")
    )
    trusted = clean.where("trusted_fact_eligible")
    joined = interval_join(trusted, intervals, F.col("rent_station_no"), F.to_date("rent_at"), history_rows)
    match = F.col("valid_from").isNotNull()
    more = issue_list(issue(~match, "station_history_unmatched", WARNING, "rent_station_no", UNMATCHED))
    out = joined.withColumns({"station_history_match": match, "dq_issues": F.concat("dq_issues", more).cast(ISSUES)})
    out = out.withColumn("dq_warning_count", warning_count(F.col("dq_issues")))
    return out.drop("key").withColumnsRenamed(
        {"valid_from": "matched_station_applicable_from", "valid_until": "matched_station_applicable_until"}
    )


def fact(enriched: DataFrame) -> DataFrame:
    """The fact table's columns, in order."""
    return enriched.select(*FACT_COLUMNS)
