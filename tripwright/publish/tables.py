"""Publication of the engine's tables: clean month, history, fact, calendar and marts."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions.identity import content_hash, content_id, row_id, trip_key
from tripwright.operators.groups import classified
from tripwright.operators.intervals import overlaps
from tripwright.operators.issues import quarantine_rows
from tripwright.operators.reconcile import same_rows
from tripwright.operators.row_rules import FIELDS, canonical, month_of, sealed, typed
from tripwright.operators.stations import by_number, observe, station_rows
from tripwright.plans import enrichment
from tripwright.plans.calendar import dim_date, months_between
from tripwright.plans.month_quality import month_quality
from tripwright.plans.od_day import od_day
from tripwright.plans.station_day import material_months, returns_of, station_day
from tripwright.plans.station_history import catalogue, islands
from tripwright.publish.bundle import PublishError, Request, Scope, check, publish
from tripwright.schemas import CLEAN, FACT, HISTORY, OBSERVATIONS, QUARANTINE, STATION_QUARANTINE, require_schema, to_schema
from tripwright.sources.rental import SourceUnit, read_units
from tripwright.sources.station import Snapshot, period_of, read_snapshots

TRANSFORMATION = "1"
FIRST_MONTH, LAST_MONTH = "2020-01", "2026-06"
Hook = Callable[[str], None]


def _no_hook(step: str) -> None:
    return None


def save(df: DataFrame, path: Path, *order: str | Column) -> None:
    """Compressed Parquet, rows ordered within each file; readers must not rely on order."""
    (df.sortWithinPartitions(*order) if order else df).write.option("compression", "zstd").parquet(str(path))


def clean_rows(spark: SparkSession, units: list[SourceUnit], expected: list[str], month: str) -> DataFrame:
    """The clean rows of ``month`` from its source units, as one lazy plan."""
    raw = read_units(spark, units)
    names = [F.get("fields", F.lit(k)).alias(f) for k, f in enumerate(FIELDS)]
    head = raw.select(
        "source_version_id", "member_name", "source_row_number", "schema_version",
        row_id(F.col("source_version_id"), F.col("member_name"), F.col("source_row_number")).alias("source_row_id"),
        content_hash(F.col("fields")).alias("row_content_sha256"), *names,
    )
    rows = month_of(canonical(typed(head)), expected)
    keyed = sealed(rows.withColumn("logical_trip_key", trip_key(F.col("bike_id"), F.col("rent_at"))))
    return keyed.where((F.col("source_month") == month) | F.col("hard_error") | (F.col("month_status") == "MISMATCH"))


def gate(rows: DataFrame) -> int:
    """The row count; raises if a row is outside its months or holds a value that no type can."""
    got = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("hard_error").alias("hard"),
        F.count_if((F.col("month_status") == "MISMATCH") | F.col("source_month").isNull()).alias("outside"),
    ).first()
    if got["hard"] or got["outside"] or not got["n"]:
        raise PublishError(f"{got['n']} rows, {got['outside']} outside their months, {got['hard']} with values out of range")
    return got["n"]


def publish_clean(
    spark: SparkSession, root: Path, month: str, units: list[SourceUnit], expected: list[str] | None = None,
    recency: int | None = None, hook: Hook = _no_hook,
) -> tuple[str, str]:
    """Clean and quarantine tables of one month; the whole unit fails on a row of another month."""
    scope = Scope(root, "clean", month)

    def build(at: Path) -> dict:
        rows = clean_rows(spark, units, expected or [month], month)
        n = gate(rows)
        flagged = classified(rows).withColumn("station_history_match", F.lit(None).cast("boolean"))
        save(to_schema(flagged, CLEAN), at / "clean", "source_row_id")
        clean = spark.read.parquet(str(at / "clean"))
        keys = [c for c, _ in QUARANTINE[:4]]
        save(to_schema(quarantine_rows(clean, keys), QUARANTINE), at / "quarantine", "source_row_id")
        return {"source_row_count": n}

    def validate(at: Path) -> None:
        clean = require_schema(spark.read.parquet(str(at / "clean")), CLEAN)
        issues = require_schema(spark.read.parquet(str(at / "quarantine")), QUARANTINE)
        got = clean.agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("source_row_id").alias("ids"),
            F.count_if(F.col("trusted_fact_eligible") == F.col("row_quarantined")).alias("torn"),
            F.count_if(F.col("row_quarantined") != F.exists("dq_issues", lambda i: i["severity"] == "QUARANTINE")).alias("unsaid"),
            F.count_if(F.col("station_history_match").isNotNull()).alias("early"),
            F.sum(F.when(F.col("row_quarantined"), F.size("dq_issues")).otherwise(0)).alias("issues"),
        ).first()
        if got["n"] != got["ids"] or got["torn"] or got["unsaid"] or got["early"] or got["issues"] != issues.count():
            raise PublishError(f"clean {month}: {got.asDict()}")

    lineage = {"month": month, "transformation": TRANSFORMATION, "units": [[u.source_version_id, u.member_name] for u in units]}
    return publish(Request(scope, "cv1", lineage, build, validate, recency=recency, before_step=hook))


def publish_calendar(spark: SparkSession, root: Path) -> tuple[str, str]:
    def validate(at: Path) -> None:
        got = spark.read.parquet(str(at / "dim_date")).agg(F.count(F.lit(1)), F.count_distinct("date"), F.min("date"), F.max("date")).first()
        if got[0] != got[1] or got[0] != (got[3] - got[2]).days + 1:
            raise PublishError("the calendar has gaps")

    def build(at: Path) -> dict:
        save(dim_date(spark), at / "dim_date", "date")
        return {}

    return publish(Request(Scope(root, "date", "all"), "dv1", {"transformation": TRANSFORMATION}, build, validate))


def station_tables(spark: SparkSession, snapshot: Snapshot) -> tuple[DataFrame, DataFrame]:
    """(observations, quarantine) of one station file."""
    seen, bad = observe(station_rows(read_snapshots(spark, [snapshot])))
    return to_schema(seen, OBSERVATIONS), to_schema(bad, STATION_QUARANTINE)


def publish_station(spark: SparkSession, root: Path, snapshot: Snapshot, recency: int | None = None, hook: Hook = _no_hook) -> tuple[str, str]:
    """Observations and quarantine of one snapshot, whose period its published name tells."""
    period, precision = period_of(snapshot.name)

    def build(at: Path) -> dict:
        seen, bad = station_tables(spark, snapshot)
        # a snapshot is a few thousand rows: one file each, in order
        save(seen.coalesce(1), at / "observations", *by_number())
        save(bad.coalesce(1), at / "quarantine", "source_row_id", "rule_id", "severity", "field", "reason")
        return counts(at)

    def counts(at: Path) -> dict:
        """The counters of a bundle, from its two tables alone."""
        seen = spark.read.parquet(str(at / "observations")).agg(
            F.count(F.lit(1)).alias("observation_count"), F.coalesce(F.sum("source_row_count"), F.lit(0)).alias("kept"),
            F.coalesce(F.sum("exact_duplicate_count"), F.lit(0)).alias("repeats"), F.count_if(F.col("exact_duplicate_count") > 0).alias("repeated"),
        ).first()
        repeat = F.col("rule_id") == "station_exact_duplicate"
        clash = F.col("rule_id").isin("station_identity_conflict", "station_capacity_conflict")
        bad = spark.read.parquet(str(at / "quarantine")).agg(
            F.count_distinct("source_row_id").alias("rows"), F.count_if(repeat).alias("repeats"),
            F.count_distinct(F.when(repeat, F.col("station_group_ref"))).alias("repeated"),
            F.count_distinct(F.when(clash, F.col("station_group_ref"))).alias("clashes"),
        ).first()
        return {
            "source_row_count": seen["kept"] + bad["rows"], "observation_count": seen["observation_count"],
            "quarantined_source_row_count": bad["rows"], "conflict_group_count": bad["clashes"],
            "exact_duplicate_group_count": seen["repeated"] + bad["repeated"], "exact_duplicate_source_row_count": seen["repeats"] + bad["repeats"],
        }

    def validate(at: Path) -> None:
        seen = require_schema(spark.read.parquet(str(at / "observations")), OBSERVATIONS)
        bad = require_schema(spark.read.parquet(str(at / "quarantine")), STATION_QUARANTINE)
        again = station_tables(spark, snapshot)
        if not (same_rows(seen, again[0]) and same_rows(bad, again[1])):
            raise PublishError(f"station {period}: not what its source says")
        if seen.count() != seen.select("station_no").distinct().count():
            raise PublishError(f"station {period}: a station has two observations")
        if counts(at)["source_row_count"] != sum(1 for _ in snapshot.rows()):
            raise PublishError(f"station {period}: {counts(at)}")

    lineage = {"period": period, "precision": precision, "source_version_id": snapshot.source_version_id, "name": snapshot.name, "transformation": TRANSFORMATION}
    return publish(Request(Scope(root, "station", period), "stv1", lineage, build, validate, recency=recency, before_step=hook))


def captured(root: Path) -> list[tuple[Scope, dict]]:
    """The current station snapshots, whose bytes are as they were published, with their metadata."""
    found = []
    for pointer in sorted((root / "station").glob("*/current.json")):
        scope = Scope(root, "station", pointer.parent.name)
        meta = check(scope, scope.current())
        if meta["lineage"]["period"] != scope.name:
            raise PublishError(f"station {scope.name} points to a snapshot of {meta['lineage']['period']}")
        found.append((scope, meta))
    if not found:
        raise PublishError("no station snapshot is published")
    return found


def publish_station_history(spark: SparkSession, root: Path) -> tuple[str, str]:
    """The station history of all current snapshots, which must not change meanwhile."""
    found = captured(root)
    about = [(m["lineage"]["period"], m["lineage"]["precision"], m["version_id"], m["lineage"]["source_version_id"]) for _, m in found]
    snapshots = catalogue(spark.createDataFrame(about, "observation_period string, observation_precision string, station_version_id string, source string"))
    if not snapshots.groupBy("applicable_from").count().where("count > 1").isEmpty():
        raise PublishError("two station snapshots apply from the same day")
    seen = spark.read.parquet(*[scope.data("observations", m["version_id"]) for scope, m in found])
    numbered = snapshots.select("observation_period", "station_version_id", "snapshot_seq", "applicable_from")
    observations = seen.join(F.broadcast(numbered), "observation_period")  # a row per snapshot
    lineage = {"snapshots": [list(a) for a in sorted(about)]}
    return publish_history(spark, root, observations, snapshots, lineage, {scope: m["version_id"] for scope, m in found})


def publish_history(
    spark: SparkSession, root: Path, observations: DataFrame, snapshots: DataFrame, lineage: dict, inputs: dict[Scope, str] | None = None
) -> tuple[str, str]:
    """The station history of all snapshots; intervals of a station must not overlap."""

    def build(at: Path) -> dict:
        save(to_schema(islands(observations, snapshots), HISTORY), at / "history", *by_number(), "applicable_from")
        return {"intervals": spark.read.parquet(str(at / "history")).count()}

    def validate(at: Path) -> None:
        history = require_schema(spark.read.parquet(str(at / "history")), HISTORY)
        if not overlaps(history, "station_no", "applicable_from", "applicable_until").isEmpty():
            raise PublishError("intervals overlap")
        if (history.agg(F.sum("observation_count")).first()[0] or 0) != observations.count():
            raise PublishError("the history does not hold each observation once")

    return publish(Request(Scope(root, "history", "all"), "wh1", {"transformation": TRANSFORMATION, **lineage}, build, validate, inputs=inputs or {}))


def publish_fact(spark: SparkSession, root: Path, month: str, hook: Hook = _no_hook) -> tuple[str, str]:
    """The trusted trips of a month's clean table, enriched by the current history."""
    clean_at, history_at = Scope(root, "clean", month), Scope(root, "history", "all")
    inputs = {s: s.current() for s in (clean_at, history_at)}
    if None in inputs.values():
        raise PublishError(f"fact {month}: no current clean table or history")

    def source() -> tuple[DataFrame, DataFrame]:
        return spark.read.parquet(clean_at.data("clean", inputs[clean_at])), spark.read.parquet(history_at.data("history", inputs[history_at]))

    def build(at: Path) -> dict:
        clean, history = source()
        save(to_schema(enrichment.enrich(clean, history, history.count()), FACT), at / "fact", "source_row_id")
        return {}

    def validate(at: Path) -> None:
        fact = require_schema(spark.read.parquet(str(at / "fact")), FACT)
        clean, history = source()
        trusted = clean.where("trusted_fact_eligible")
        kept = ["source_row_id", "row_content_sha256", "bike_id", "rent_at"]
        # an independent look: matches counted through a semi join of keys, not the model's left join
        spans = history.select("station_no", "applicable_from", "applicable_until")
        inside = (F.col("rent_station_no") == F.col("station_no")) & (F.to_date("rent_at") >= F.col("applicable_from"))
        inside = inside & F.coalesce(F.to_date("rent_at") < F.col("applicable_until"), F.lit(True))
        matched = trusted.join(spans, inside, "left_semi").select("source_row_id")
        if not same_rows(fact.select(kept), trusted.select(kept)) or not same_rows(fact.where("station_history_match").select("source_row_id"), matched):
            raise PublishError(f"fact {month} is not its clean table's trusted rows")

    lineage = {"month": month, "clean": inputs[clean_at], "history": inputs[history_at], "transformation": TRANSFORMATION}
    return publish(Request(Scope(root, "fact", month), "fv1", lineage, build, validate, inputs, before_step=hook))


def _mart(spark: SparkSession, root: Path, kind: str, prefix: str, month: str, inputs: dict[Scope, str], make, check, hook: Hook, more: dict | None = None):
    def build(at: Path) -> dict:
        save(make(), at / "mart")
        return {}

    def validate(at: Path) -> None:
        check(spark.read.parquet(str(at / "mart")))

    lineage = {"month": month, "inputs": sorted([s.kind, s.name, v] for s, v in inputs.items()), "transformation": TRANSFORMATION, **(more or {})}
    return publish(Request(Scope(root, kind, month), prefix, lineage, build, validate, inputs, before_step=hook))


def _fact_scope(root: Path, month: str) -> tuple[Scope, str]:
    scope = Scope(root, "fact", month)
    version = scope.current()
    if version is None:
        raise PublishError(f"fact {month} has no current version")
    return scope, version


def publish_od_day(spark: SparkSession, root: Path, month: str, hook: Hook = _no_hook) -> tuple[str, str]:
    scope, version = _fact_scope(root, month)
    fact = spark.read.parquet(scope.data("fact", version))

    def check(mart: DataFrame) -> None:
        if (mart.agg(F.sum("trip_count")).first()[0] or 0) != fact.where("is_completed_trip").count():
            raise PublishError(f"od_day {month}: trips are not the completed trips")

    return _mart(spark, root, "od_day", "mod1", month, {scope: version}, lambda: od_day(fact), check, hook)


def publish_quality(spark: SparkSession, root: Path, month: str, hook: Hook = _no_hook) -> tuple[str, str]:
    scope, version = _fact_scope(root, month)
    clean_scope = Scope(root, "clean", month)
    clean_version = clean_scope.current()
    clean, fact = spark.read.parquet(clean_scope.data("clean", clean_version)), spark.read.parquet(scope.data("fact", version))

    def make() -> DataFrame:
        versions = F.array_sort(F.collect_set("schema_version"))
        mixed = F.when(F.size(versions) == 1, versions[0]).otherwise(F.concat(F.lit("mixed["), F.array_join(versions, ","), F.lit("]")))
        context = clean.agg(
            F.lit(month).alias("source_month"), F.count(F.lit(1)).alias("source_row_count"), mixed.alias("schema_version"),
            F.lit(clean_version).alias("clean_version_id"), F.lit(version).alias("fact_version_id"),
        )
        return month_quality(context, clean, fact)

    def check(mart: DataFrame) -> None:
        rows = mart.collect()
        if len(rows) != 1 or rows[0]["clean_row_count"] != rows[0]["trusted_fact_count"] + rows[0]["quarantine_count"]:
            raise PublishError(f"quality {month}: rows are not trusted plus quarantined")

    return _mart(spark, root, "quality", "msq1", month, {scope: version, clean_scope: clean_version}, make, check, hook)


def publish_station_day(spark: SparkSession, root: Path, month: str, hook: Hook = _no_hook) -> tuple[str, str]:
    """Needs every fact month up to ``month``; the version follows those with a return in it."""
    if month > LAST_MONTH:
        raise PublishError(f"{month} is beyond {LAST_MONTH}")
    first = min((p.name for p in (root / "fact").iterdir()), default=month) if (root / "fact").exists() else month
    scopes = dict(_fact_scope(root, m) for m in months_between(first, month))
    facts = spark.read.parquet(*[s.data("fact", v) for s, v in scopes.items()])
    own = spark.read.parquet(next(s.data("fact", v) for s, v in scopes.items() if s.name == month))
    material = {r["source_month"] for r in material_months(facts, month).collect()} | {month}  # months, not rows
    inputs = {s: v for s, v in scopes.items() if s.name in material}

    def check(mart: DataFrame) -> None:
        got = mart.agg(
            F.sum("rental_count"), F.sum("return_count"),
            F.count_if(F.col("completed_trip_count") + F.col("missing_return_count") != F.col("rental_count")),
        ).first()
        if (got[0] or 0, got[1] or 0, got[2]) != (own.count(), returns_of(facts, month).count(), 0):
            raise PublishError(f"station_day {month}: counts don't add up")

    return _mart(spark, root, "station_day", "msd1", month, inputs, lambda: station_day(own, returns_of(facts, month)), check, hook)


def source_version(dataset: str, period: str, filename: str, sha256: str) -> str:
    return content_id("sv1", {"dataset_id": dataset, "logical_period": period, "published_filename": filename, "sha256": sha256})


