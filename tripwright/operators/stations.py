"""Station snapshots: source rows to typed rows, to one observation per station, or to quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwright.functions.identity import content_hash, row_id
from tripwright.functions.text import decimal_inexact, read_decimal, station_number, trimmed, utrim
from tripwright.operators.issues import ISSUES, QUARANTINE, WARNING, issue, issue_list
from tripwright.operators.row_rules import sealed

#: The ten source columns, by position.
FIELDS = (
    "station_no", "station_name", "district", "address", "latitude", "longitude", "installation_value", "lcd_capacity",
    "qr_capacity", "operation_mode",
)
IDENTITY = ("station_name", "district", "address", "latitude", "longitude")
CAPACITY = ("lcd_capacity", "qr_capacity")
SNAPSHOT = ("source_version_id", "observation_period", "observation_precision")
BOUNDS = {"latitude": 90, "longitude": 180}
#: Serial day 0 of spreadsheets, and the last serial day that is a date of four-digit years.
SERIAL_START, SERIAL_END = "1899-12-30", 2958465


def coordinate(c: Column, bound: int) -> Column:
    """A decimal within plus and minus ``bound`` of eight digits, halves to even; else NULL."""
    value = read_decimal(c)
    return F.bround(F.when(value.between(-bound, bound), value), 8).cast("decimal(18,8)")


def capacity(c: Column) -> Column:
    """A whole number from 0 on, ``15.0`` too; else NULL. One that no int holds raises (ANSI)."""
    value = read_decimal(c)
    return F.when((value >= 0) & (value == F.floor(value)) & ~decimal_inexact(c), value).cast("int")


def installation(c: Column, spreadsheet: Column) -> Column:
    """The trimmed text; in a spreadsheet a serial day is its ISO date."""
    text, serial = trimmed(c), read_decimal(c)
    late = F.when(serial > SERIAL_END, F.raise_error(F.concat(F.lit("no date has the serial day "), text)).cast("string"))
    day = F.date_add(F.lit(SERIAL_START).cast("date"), F.floor(F.least(serial, F.lit(SERIAL_END))).cast("int")).cast("string")
    return F.when(spreadsheet & (serial >= 1), F.coalesce(late, day)).otherwise(text)


def _quoted(c: Column) -> Column:
    """A text in quotes, as messages show it; of the control characters, tabs and line ends are escaped."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", r"\n"), ("\r", r"\r"), ("\t", r"\t")):
        out = F.replace(out, F.lit(raw), F.lit(shown))
    single, double = F.contains(c, F.lit("'")), F.contains(c, F.lit('"'))
    plain = F.concat(F.lit("'"), F.replace(out, F.lit("'"), F.lit(r"\'")), F.lit("'"))
    return F.when(single & ~double, F.concat(F.lit('"'), out, F.lit('"'))).otherwise(plain)


def station_rows(raw: DataFrame) -> DataFrame:
    """Typed rows with their issues.

    ``raw``: the columns of ``tripwright.sources.station``. A row without a station number is
    quarantined; all other trouble is a warning and the value NULL.
    """
    text = {name: F.get("fields", F.lit(k)) for k, name in enumerate(FIELDS)}
    given = {name: F.when(utrim(c) != "", c) for name, c in text.items()}
    mode = F.upper(trimmed(text["operation_mode"]))
    typed = {
        "source_row_id": row_id(F.col("source_version_id"), F.col("published_filename"), F.col("source_row_number")),
        "content": content_hash(F.col("fields")),
        "station_no_raw": given["station_no"],
        "station_no": station_number(text["station_no"]),
        **{name: trimmed(text[name]) for name in IDENTITY[:3]},
        **{name: coordinate(text[name], bound) for name, bound in BOUNDS.items()},
        "installation_value": installation(text["installation_value"], F.col("source_format") == "XLSX"),
        **{name: capacity(text[name]) for name in CAPACITY},
        "operation_mode": F.when(mode.isin("LCD", "QR"), mode),
        **{f"_{name}": given[name] for name in (*BOUNDS, *CAPACITY, "operation_mode")},
    }
    rows = sealed(raw.withColumns(typed))
    absent = lambda name: F.col(name).isNull()
    unread = lambda name: F.col(f"_{name}").isNotNull() & absent(name)
    issues = [issue(absent("station_no"), "station_no_invalid", QUARANTINE, "station_no", "station number is missing or is not ASCII decimal digits")]
    issues += [issue(absent(n), "station_attribute_missing", WARNING, n, f"{n} is missing") for n in IDENTITY[:3]]
    for n, bound in BOUNDS.items():
        reason = F.when(absent(f"_{n}"), f"{n} is missing").otherwise(f"{n} is not a finite coordinate in [-{bound},{bound}]")
        issues.append(issue(absent(n), "station_coordinate_invalid", WARNING, n, reason))
    issues += [issue(unread(n), "station_capacity_invalid", WARNING, n, f"{n} must be a non-negative integer") for n in CAPACITY]
    unknown = F.concat(F.lit("unrecognized operation mode "), _quoted(F.col("_operation_mode")))
    issues.append(issue(unread("operation_mode"), "station_operation_mode_invalid", WARNING, "operation_mode", unknown))
    for one, other in (("LCD", "QR"), ("QR", "LCD")):
        both = (F.col("operation_mode") == one) & F.col(f"{other.lower()}_capacity").isNotNull()
        issues.append(issue(both, "station_mode_capacity_mismatch", WARNING, "operation_mode", f"{one} row also contains {other} capacity"))
    return rows.withColumn("dq_issues", issue_list(*issues)).drop("fields", *[c for c in typed if c.startswith("_")])


def exact_duplicates(rows: DataFrame, group: str | list[str], content: str, order: str) -> DataFrame:
    """Adds is_repeat: an earlier row (by ``order``) of the group has the same content."""
    keys = [group] if isinstance(group, str) else group
    w = Window.partitionBy(*keys, content).orderBy(order)
    return rows.withColumn("is_repeat", F.row_number().over(w) > 1)


def conflicts(rows: DataFrame, group: str | list[str], fields: tuple[str, ...]) -> DataFrame:
    """Per group: n_rows, each field's agreed value, and the fields with differing values.

    NULLs agree with anything; a field conflicts if its smallest value isn't its largest.
    """
    sums = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.min(f).alias(f) for f in fields],
        *[F.max(f).alias(f"_max_{f}") for f in fields],
    )
    names = F.array_compact(F.array(*[F.when(F.col(f) != F.col(f"_max_{f}"), F.lit(f)) for f in fields]))
    return sums.withColumn("conflict_fields", names).drop(*[f"_max_{f}" for f in fields])


def consolidate(rows: DataFrame, snapshot: tuple[str, ...] = (), extra: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(observations, quarantine issues) of the rows with a station number.

    ``rows``: source_row_id, source_row_number, station_no, IDENTITY, CAPACITY,
    operation_mode, installation_value, content (hash of the row's values), dq_issues.
    Rows of a station meet within a snapshot, which the columns ``snapshot`` name; the
    quarantine has the columns ``extra`` of its rows, too.
    """
    group = [*snapshot, "station_no"]
    fields = IDENTITY + CAPACITY
    marked = exact_duplicates(rows, group, "content", "source_row_number")
    per_group = conflicts(marked, group, fields)
    ordered = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("source_row_number", c))), lambda x: x[c])
    lists = marked.groupBy(*group).agg(
        ordered("source_row_id").alias("source_row_ids"),
        F.sort_array(F.collect_list("source_row_number")).alias("source_row_numbers"),
        F.count(F.lit(1)).cast("int").alias("source_row_count"),
        F.count_if("is_repeat").cast("int").alias("exact_duplicate_count"),
        F.sort_array(F.collect_set("installation_value")).alias("installation_values"),
        F.flatten(F.collect_list("dq_issues")).alias("_issues"),
        F.collect_set("operation_mode").alias("_modes"),
    )
    collapsed = F.concat(F.col("exact_duplicate_count").cast("string"), F.lit(" exact duplicate source row(s) collapsed"))
    repeat = issue_list(issue(F.col("exact_duplicate_count") > 0, "station_exact_duplicate", WARNING, "source_row", collapsed))
    warnings = F.filter(F.concat("_issues", repeat), lambda i: i["severity"] == WARNING)
    has = lambda mode, c: F.array_contains("_modes", mode) | F.col(c).isNotNull()
    lcd, qr = has("LCD", "lcd_capacity"), has("QR", "qr_capacity")
    agreed = per_group.where(F.size("conflict_fields") == 0).drop("n_rows", "conflict_fields")
    observations = agreed.join(lists, group).withColumns(
        {
            "operation_mode": F.when(lcd & qr, "LCD+QR").when(lcd, "LCD").when(qr, "QR"),
            "dq_issues": F.sort_array(F.array_distinct(warnings)).cast(ISSUES),
        }
    )
    rules = F.array_distinct(F.transform("dq_issues", lambda i: i["rule_id"]))
    observations = observations.withColumn("dq_warning_count", F.size(rules)).drop("_modes", "_issues")

    only_capacity = F.size(F.array_except("conflict_fields", F.array(*map(F.lit, CAPACITY)))) == 0
    rule = F.when(only_capacity, "station_capacity_conflict").otherwise("station_identity_conflict")
    trouble = per_group.where(F.size("conflict_fields") > 0).select(*group, rule.alias("_rule"), F.concat_ws(",", "conflict_fields").alias("_fields"))
    differ = F.concat(F.lit("same-snapshot station "), F.col("station_no"), F.lit(" has conflicting non-null values"))
    conflict = F.struct(F.col("_rule").alias("rule_id"), F.lit(QUARANTINE).alias("severity"), F.col("_fields").alias("field"), differ.alias("reason"))
    again = issue(F.col("is_repeat"), "station_exact_duplicate", WARNING, "source_row", "exact duplicate source row occurs inside a conflicting station group")
    bad = marked.join(trouble, group).withColumn("dq_issues", F.concat("dq_issues", issue_list(conflict, again)).cast(ISSUES))
    head = dict.fromkeys(("source_row_id", "source_row_number", "station_no", *snapshot, *extra))
    return observations, _spread(bad, *head)


def _spread(rows: DataFrame, *head: str) -> DataFrame:
    return rows.select(*head, F.explode("dq_issues").alias("i")).select(*head, "i.rule_id", "i.severity", "i.field", "i.reason")


def observe(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations, quarantine) of typed rows of any number of snapshots."""
    extra = ("station_no_raw",)
    seen, bad = consolidate(rows.where("station_no is not null"), SNAPSHOT, extra)
    nameless = _spread(rows.where("station_no is null"), *bad.columns[: -len(("rule_id", "severity", "field", "reason"))])
    return seen, bad.unionByName(nameless).withColumn("station_group_ref", F.col("station_no"))


def by_number(station_no: str = "station_no") -> tuple[Column, Column]:
    """Sort keys that put digit texts in the order of their numbers."""
    return F.length(station_no), F.col(station_no)
