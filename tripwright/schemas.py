"""Closed schemas of the durable tables, and the gate that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_ISSUES = "array<struct<rule_id:string,severity:string,field:string,reason:string>>"

CLEAN = (
    ("source_row_id", "string"), ("source_version_id", "string"), ("member_name", "string"), ("source_row_number", "bigint"),
    ("row_content_sha256", "string"), ("source_month", "string"), ("schema_version", "string"), ("bike_id", "string"),
    ("rent_at", "timestamp_ntz"), ("rent_station_no_raw", "string"), ("rent_station_no", "string"), ("rent_station_name", "string"),
    ("rent_dock_no", "bigint"), ("return_at", "timestamp_ntz"), ("return_station_no_raw", "string"), ("return_station_no", "string"),
    ("return_station_name", "string"), ("return_dock_no", "bigint"), ("usage_min", "bigint"), ("distance_m", "decimal(38,18)"),
    ("birth_year", "smallint"), ("sex_raw", "string"), ("sex_code", "string"), ("user_type", "string"),
    ("rent_station_internal_id", "string"), ("return_station_internal_id", "string"), ("bike_type", "string"),
    ("logical_trip_key", "string"), ("logical_trip_conflict", "boolean"), ("exact_duplicate_group", "boolean"),
    ("is_completed_trip", "boolean"), ("distance_metric_eligible", "boolean"), ("station_history_match", "boolean"),
    ("dq_issues", _ISSUES), ("dq_warning_count", "int"), ("row_quarantined", "boolean"), ("trusted_fact_eligible", "boolean"),
)
FACT = (*CLEAN, ("matched_station_applicable_from", "date"), ("matched_station_applicable_until", "date"))
CLEAN_COLUMNS = tuple(n for n, _ in CLEAN)
FACT_COLUMNS = tuple(n for n, _ in FACT)
QUARANTINE = tuple(
    (n, "string") for n in ("source_row_id", "source_version_id", "source_month", "logical_trip_key", "rule_id", "severity", "field", "reason")
)
OBSERVATIONS = (
    ("source_version_id", "string"), ("observation_period", "string"), ("observation_precision", "string"), ("station_no", "string"),
    ("station_name", "string"), ("district", "string"), ("address", "string"), ("latitude", "decimal(18,8)"), ("longitude", "decimal(18,8)"),
    ("lcd_capacity", "int"), ("qr_capacity", "int"), ("operation_mode", "string"), ("source_row_ids", "array<string>"),
    ("source_row_numbers", "array<bigint>"), ("source_row_count", "int"), ("exact_duplicate_count", "int"),
    ("installation_values", "array<string>"), ("dq_issues", _ISSUES), ("dq_warning_count", "int"),
)
STATION_QUARANTINE = (
    ("source_row_id", "string"), ("source_version_id", "string"), ("source_row_number", "bigint"), ("observation_period", "string"),
    ("station_no_raw", "string"), ("station_no", "string"), ("station_group_ref", "string"), ("rule_id", "string"),
    ("severity", "string"), ("field", "string"), ("reason", "string"),
)
HISTORY = (
    ("station_no", "string"), ("applicable_from", "date"), ("applicable_until", "date"), ("station_name", "string"), ("district", "string"),
    ("address", "string"), ("latitude", "decimal(18,8)"), ("longitude", "decimal(18,8)"), ("lcd_capacity", "int"), ("qr_capacity", "int"),
    ("operation_mode", "string"), ("observation_periods", "array<string>"), ("station_version_ids", "array<string>"),
    ("source_version_ids", "array<string>"), ("observation_count", "int"),
)


class SchemaMismatch(ValueError):
    """A table's columns are not the expected ones, by name, order and type."""


def struct(fields: tuple[tuple[str, str], ...]) -> T.StructType:
    return T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in fields))


def require_schema(df: DataFrame, fields: tuple[tuple[str, str], ...]) -> DataFrame:
    """``df`` if its ordered names and types are ``fields``; nullability doesn't count."""
    want = [(f.name, f.dataType.simpleString()) for f in struct(fields)]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    if want != have:
        raise SchemaMismatch(f"expected {want}, found {have}")
    return df


def to_schema(df: DataFrame, fields: tuple[tuple[str, str], ...]) -> DataFrame:
    """``df``'s columns in order, cast; a value that a type can't hold raises (ANSI)."""
    return df.select(*[df[n].cast(f.dataType).alias(n) for (n, _), f in zip(fields, struct(fields), strict=True)])
