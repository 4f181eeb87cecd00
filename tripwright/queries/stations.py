"""Station rows, observations and quarantine over the driver's tables.

A customer is a source row of a station file; five in a row are the rows of one station.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.operators.issues import ISSUES
from tripwright.operators.stations import by_number, consolidate, station_rows
from tripwright.queries.trips import table

#: The texts of the ten columns, in SQL that both engines read.
TEXTS = {
    "station_no": "CASE WHEN c_custkey % 11 = 0 THEN concat('ST-', n) WHEN c_custkey % 13 = 0 THEN ' ' ELSE concat('00', n) END",
    "station_name": "CASE WHEN c_custkey % 17 = 0 THEN '  ' ELSE concat(' ', c_name) END",
    "district": "c_mktsegment",
    "address": "CAST(c_nationkey AS VARCHAR(9))",
    "latitude": "CASE WHEN c_custkey % 7 = 0 THEN 'NaN' WHEN c_custkey % 7 = 1 THEN '' ELSE concat(CAST(c_custkey % 190 - 95 AS VARCHAR(9)), '.125') END",
    "longitude": "concat(CAST(c_custkey % 370 - 185 AS VARCHAR(9)), '.5')",
    "installation_value": "CAST(c_custkey % 50000 AS VARCHAR(9))",
    "lcd_capacity": "CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN concat(n, '.0') WHEN 2 THEN concat(n, '.5') WHEN 3 THEN concat('-', n) ELSE n END",
    "qr_capacity": "CASE WHEN c_custkey % 3 = 0 THEN n ELSE '' END",
    "operation_mode": "CASE c_custkey % 4 WHEN 0 THEN 'LCD' WHEN 1 THEN ' qr ' WHEN 2 THEN '' ELSE concat('x', n) END",
}


def q_station_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Typed readings of station texts and the fields of their issues, rule by rule."""
    texts = [F.expr(sql).alias(name) for name, sql in TEXTS.items()]
    rows = table(spark, sf, "customer").withColumn("n", F.expr("CAST(c_custkey AS VARCHAR(20))"))
    raw = rows.select(
        F.lit("sv1_x").alias("source_version_id"), F.lit("f").alias("published_filename"), F.col("c_custkey").alias("source_row_number"),
        F.when(F.col("c_custkey") % 2 == 0, "XLSX").otherwise("CSV").alias("source_format"), F.array(*texts).alias("fields"),
    )
    named = F.array_join(F.transform("dq_issues", lambda i: F.concat_ws(":", i["rule_id"], i["severity"], i["field"], i["reason"])), "|")
    return station_rows(raw).select(
        "source_row_number", "station_no", "station_name", F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"), "installation_value", "lcd_capacity", "qr_capacity", "operation_mode",
        named.alias("issues"),
    )


def _consolidated(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    no, key = F.floor(F.col("c_custkey") / 5).cast("string"), F.col("c_custkey")
    base = table(spark, sf, "customer").select(
        F.concat(F.lit("r"), key.cast("string")).alias("source_row_id"), key.alias("source_row_number"), no.alias("station_no"),
        F.concat(F.lit("s"), no, F.when(key % 97 == 0, "x").otherwise("")).alias("station_name"), F.when(key % 2 == 0, F.lit("d")).alias("district"),
        F.lit("a").alias("address"), F.lit(None).cast("decimal(18,8)").alias("latitude"), F.lit(None).cast("decimal(18,8)").alias("longitude"),
        F.when(key % 3 == 0, F.when(key % 31 == 0, 21).otherwise(20)).alias("lcd_capacity"), F.when(key % 7 == 1, F.when(key % 89 == 0, 6).otherwise(5)).alias("qr_capacity"),
        F.when(key % 10 == 4, "QR").alias("operation_mode"), F.when(key % 2 == 1, (key % 3).cast("string")).alias("installation_value"),
    )
    values = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in base.columns[2:]]
    odd = F.expr(f"CAST(IF(c % 4 = 1, array(struct('w', 'WARNING', 'f', 'odd')), array()) AS {ISSUES})")
    return consolidate(base.withColumns({"content": F.concat_ws("|", *values), "c": F.col("source_row_number")}).withColumn("dq_issues", odd))


def q_observations(spark: SparkSession, sf: str) -> DataFrame:
    seen, _ = _consolidated(spark, sf)
    rows = F.array_join(F.transform("source_row_numbers", lambda x: x.cast("string")), ",")
    return seen.select(
        "station_no", "station_name", "district", "lcd_capacity", "qr_capacity", "operation_mode", "source_row_count", "exact_duplicate_count",
        F.array_join("source_row_ids", ",").alias("source_row_ids"), rows.alias("source_row_numbers"), "dq_warning_count",
        F.array_join("installation_values", ",").alias("installation_values"),
        F.array_join(F.transform("dq_issues", lambda i: i["reason"]), "|").alias("reasons"),
    ).orderBy(*by_number())


def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return _consolidated(spark, sf)[1]


_SAID = {
    "station_no IS NULL": ("station_no_invalid:QUARANTINE:station_no", "station number is missing or is not ASCII decimal digits"),
    "station_name IS NULL": ("station_attribute_missing:WARNING:station_name", "station_name is missing"),
    "trim(t_latitude) = ''": ("station_coordinate_invalid:WARNING:latitude", "latitude is missing"),
    "trim(t_latitude) <> '' AND latitude IS NULL": ("station_coordinate_invalid:WARNING:latitude", "latitude is not a finite coordinate in [-90,90]"),
    "longitude IS NULL": ("station_coordinate_invalid:WARNING:longitude", "longitude is not a finite coordinate in [-180,180]"),
    "t_lcd_capacity <> '' AND lcd_capacity IS NULL": ("station_capacity_invalid:WARNING:lcd_capacity", "lcd_capacity must be a non-negative integer"),
    "trim(t_operation_mode) <> '' AND operation_mode IS NULL": ("station_operation_mode_invalid:WARNING:operation_mode", None),
    "operation_mode = 'LCD' AND qr_capacity IS NOT NULL": ("station_mode_capacity_mismatch:WARNING:operation_mode", "LCD row also contains QR capacity"),
    "operation_mode = 'QR' AND lcd_capacity IS NOT NULL": ("station_mode_capacity_mismatch:WARNING:operation_mode", "QR row also contains LCD capacity"),
}


def _said_sql() -> str:
    reason = lambda r: f"'{r}'" if r else "'unrecognized operation mode ''' || t_operation_mode || ''''"
    return ", ".join(f"CASE WHEN {when} THEN '{head}:' || {reason(r)} END" for when, (head, r) in _SAID.items())


_ROWS_SQL = f"""
WITH k AS (SELECT *, CAST(c_custkey AS VARCHAR) AS n FROM customer),
t AS (SELECT c_custkey, {", ".join(f"{sql} AS t_{name}" for name, sql in TEXTS.items())} FROM k),
v AS (SELECT *, CASE WHEN regexp_full_match(trim(t_station_no), '[0-9]+') THEN
    CASE WHEN ltrim(trim(t_station_no), '0') = '' THEN '0' ELSE ltrim(trim(t_station_no), '0') END END AS station_no,
  nullif(trim(t_station_name), '') AS station_name,
  CASE WHEN t_latitude NOT IN ('', 'NaN') THEN TRY_CAST(t_latitude AS DECIMAL(18,8)) END AS lat, TRY_CAST(t_longitude AS DECIMAL(18,8)) AS lon,
  CASE WHEN c_custkey % 2 = 0 AND CAST(t_installation_value AS INTEGER) >= 1
    THEN CAST(CAST(DATE '1899-12-30' + CAST(t_installation_value AS INTEGER) AS DATE) AS VARCHAR) ELSE t_installation_value END AS installation_value,
  TRY_CAST(t_lcd_capacity AS DECIMAL(38,18)) AS lcd, TRY_CAST(t_qr_capacity AS INTEGER) AS qr_capacity, upper(trim(t_operation_mode)) AS m FROM t),
r AS (SELECT *, CASE WHEN lat BETWEEN -90 AND 90 THEN CAST(lat AS DOUBLE) END AS latitude,
  CASE WHEN lon BETWEEN -180 AND 180 THEN CAST(lon AS DOUBLE) END AS longitude,
  CASE WHEN lcd >= 0 AND lcd = floor(lcd) THEN CAST(lcd AS INTEGER) END AS lcd_capacity,
  CASE WHEN m IN ('LCD', 'QR') THEN m END AS operation_mode FROM v)
SELECT c_custkey AS source_row_number, station_no, station_name, latitude, longitude, installation_value, lcd_capacity, qr_capacity,
  operation_mode, concat_ws('|', {_said_sql()}) AS issues FROM r"""

_CONSOLIDATED_SQL = """
WITH b AS (SELECT c_custkey AS n, CAST(c_custkey // 5 AS VARCHAR) AS station_no,
  's' || (c_custkey // 5) || CASE WHEN c_custkey % 97 = 0 THEN 'x' ELSE '' END AS station_name, CASE WHEN c_custkey % 2 = 0 THEN 'd' END AS district,
  CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 31 = 0 THEN 21 ELSE 20 END END AS lcd, CASE WHEN c_custkey % 7 = 1 THEN CASE WHEN c_custkey % 89 = 0 THEN 6 ELSE 5 END END AS qr,
  CASE WHEN c_custkey % 10 = 4 THEN 'QR' END AS mode, CASE WHEN c_custkey % 2 = 1 THEN CAST(c_custkey % 3 AS VARCHAR) END AS installed,
  c_custkey % 4 = 1 AS odd FROM customer),
d AS (SELECT *, row_number() OVER (PARTITION BY station_no, station_name, district, lcd, qr, mode, installed ORDER BY n) > 1 AS again FROM b),
g AS (SELECT station_no, concat_ws(',', CASE WHEN COUNT(DISTINCT station_name) > 1 THEN 'station_name' END,
    CASE WHEN COUNT(DISTINCT lcd) > 1 THEN 'lcd_capacity' END, CASE WHEN COUNT(DISTINCT qr) > 1 THEN 'qr_capacity' END) AS clash,
  COUNT(DISTINCT station_name) > 1 AS who, MIN(station_name) AS station_name, MIN(district) AS district, MIN(lcd) AS lcd_capacity, MIN(qr) AS qr_capacity,
  bool_or(lcd IS NOT NULL) AS has_lcd, bool_or(qr IS NOT NULL OR mode IS NOT NULL) AS has_qr, CAST(COUNT(*) AS INTEGER) AS source_row_count,
  CAST(COUNT(*) FILTER (WHERE again) AS INTEGER) AS repeats, string_agg('r' || n, ',' ORDER BY n) AS source_row_ids,
  string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) AS source_row_numbers, bool_or(odd) AS odd,
  COALESCE(string_agg(DISTINCT installed, ',' ORDER BY installed), '') AS installation_values FROM d GROUP BY 1)"""

QUERIES = {
    "station_row_rules": q_station_rows,
    "station_observations": q_observations,
    "station_quarantine": q_quarantine,
}

ORACLES = {
    "station_row_rules": _ROWS_SQL,
    "station_observations": f"""{_CONSOLIDATED_SQL}
SELECT station_no, station_name, district, lcd_capacity, qr_capacity,
  CASE WHEN has_lcd AND has_qr THEN 'LCD+QR' WHEN has_lcd THEN 'LCD' WHEN has_qr THEN 'QR' END AS operation_mode, source_row_count,
  repeats AS exact_duplicate_count, source_row_ids, source_row_numbers,
  CAST(repeats > 0 AS INTEGER) + CAST(odd AS INTEGER) AS dq_warning_count, installation_values,
  concat_ws('|', CASE WHEN repeats > 0 THEN repeats || ' exact duplicate source row(s) collapsed' END, CASE WHEN odd THEN 'odd' END) AS reasons
FROM g WHERE clash = ''""",
    "station_quarantine": f"""{_CONSOLIDATED_SQL},
q AS (SELECT n, station_no, odd_row, again, clash, who FROM (SELECT d.*, d.odd AS odd_row, g.clash, g.who FROM d JOIN g USING (station_no)) WHERE clash <> ''),
i AS (SELECT *, 'w' AS rule_id, 'WARNING' AS severity, 'f' AS field, 'odd' AS reason FROM q WHERE odd_row
UNION ALL SELECT *, CASE WHEN who THEN 'station_identity_conflict' ELSE 'station_capacity_conflict' END, 'QUARANTINE', clash,
  'same-snapshot station ' || station_no || ' has conflicting non-null values' FROM q
UNION ALL SELECT *, 'station_exact_duplicate', 'WARNING', 'source_row', 'exact duplicate source row occurs inside a conflicting station group' FROM q WHERE again)
SELECT 'r' || n AS source_row_id, n AS source_row_number, station_no, rule_id, severity, field, reason FROM i""",
}
