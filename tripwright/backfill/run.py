"""Backfill of a range of months: plan, execute month by month, retry what failed."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from pathlib import Path

from pyspark.sql import SparkSession

from tripwright.functions.identity import content_id
from tripwright.plans.calendar import months_between
from tripwright.plans.station_day import impact_months
from tripwright.publish import tables
from tripwright.publish.bundle import PublishError, Scope, read_json
from tripwright.sources import registry
from tripwright.sources.months import months_of
from tripwright.sources.rental import SourceError, SourceUnit


@dataclass(frozen=True)
class Source:
    """A registered source of a month: ``yearly`` ones are members of a ZIP."""

    month: str
    unit: SourceUnit
    yearly: bool = False
    recency: int = 0
    #: The months that the rows of the unit may be of, if more than its own.
    expected: tuple[str, ...] = ()


@dataclass(frozen=True)
class MonthPlan:
    month: str
    status: str  # NEW, UNCHANGED, REVISED, REMOVED, MISSING
    units: tuple[SourceUnit, ...] = ()
    recency: int = 0
    #: The fact version that the plan replaces; a retry still compares with it.
    previous_fact: str | None = None
    expected: tuple[str, ...] = ()


@dataclass
class Result:
    status: str
    months: dict[str, dict] = field(default_factory=dict)
    station_days: list[str] = field(default_factory=list)

    def failed(self) -> list[str]:
        return [m for m, r in self.months.items() if r["status"] == "FAILED"]

    def to_json(self, plan_id: str) -> str:
        """Bound to its plan: a changed body or another plan is refused when read."""
        body = asdict(self) | {"plan_id": plan_id}
        return json.dumps({"body": body, "seal": content_id("bfr", body)}, ensure_ascii=False)

    @classmethod
    def from_json(cls, text: str, plan_id: str) -> Result:
        found = json.loads(text)
        body = found["body"]
        if content_id("bfr", body) != found["seal"] or body.pop("plan_id") != plan_id:
            raise PublishError("the result is not the plan's")
        return cls(**body)


def plan_id(plan: list[MonthPlan]) -> str:
    return content_id("bfp", [asdict(m) for m in plan])


def _published_units(root: Path, month: str) -> list[list[str | None]] | None:
    """[version, member] of each unit behind the current clean month."""
    scope = Scope(root, "clean", month)
    now = scope.current()
    return None if now is None else read_json(scope.version(now) / "metadata.json")["lineage"]["units"]


def plan_registered(root: Path, manifest: Path, raw_root: Path, first: str, last: str, dataset_id: str = "rental_history") -> list[MonthPlan]:
    """What each month needs, from the registered sources: the latest version of every period.

    A month whose files in a new ZIP are those of the version before, whatever their names, is
    UNCHANGED and keeps the version that it was read from; one that a ZIP no longer has is REMOVED.
    """
    records = [r for r in registry.load(manifest) if r.dataset_id == dataset_id]
    known = {r.source_version_id: r for r in records}
    sources, zipped = [], set()
    for n, record in enumerate(records):
        if any(r.logical_period == record.logical_period for r in records[n + 1 :]):
            continue
        held = registry.months_in(raw_root, record)
        for month, units in held.items():
            if record.zipped and month in zipped:
                raise PublishError(f"{month} is in two registered ZIP files")
            spans = {m for u in units for m in (months_of(u.member_name) if record.zipped else [month])}
            sources += [Source(month, u, record.zipped, n, tuple(sorted(spans))) for u in units]
        if record.zipped:
            zipped |= held.keys()
    out = []
    for m in plan_range(root, first, last, sources):
        before = _published_units(root, m.month)
        if before and m.status in ("REVISED", "MISSING"):
            if not {v for v, _ in before} <= known.keys():
                raise PublishError(f"{m.month} was published from a source that is not registered")
            old = [registry.unit(raw_root, known[v], name) for v, name in before]
            if m.status == "MISSING":
                gone = any(known[v].zipped for v, _ in before)
                m = replace(m, status="REMOVED" if gone else "MISSING")  # noqa: PLW2901
            elif m.units[0].member_name and old[0].member_name and registry.same_content(old, list(m.units)):
                m = replace(m, status="UNCHANGED", units=tuple(old), recency=records.index(known[before[0][0]]))  # noqa: PLW2901
        out.append(m)
    return out


def plan_range(root: Path, first: str, last: str, sources: list[Source]) -> list[MonthPlan]:
    """What each month needs; a monthly and a yearly source of one month is an error."""
    out = []
    for month in months_between(first, last):
        own = [s for s in sources if s.month == month]
        previous = Scope(root, "fact", month).current()
        if len({s.yearly for s in own}) > 1:
            raise PublishError(f"{month}: a monthly and a yearly source")
        if not own:
            out.append(MonthPlan(month, "MISSING", previous_fact=previous))
            continue
        newest = max(s.recency for s in own)
        units = tuple(s.unit for s in own if s.recency == newest)
        expected = tuple(sorted({m for s in own if s.recency == newest for m in s.expected}))
        before = _published_units(root, month)
        status = "NEW" if before is None else "UNCHANGED" if before == [[u.source_version_id, u.member_name] for u in units] else "REVISED"
        out.append(MonthPlan(month, status, units, newest, previous, expected))
    return out


def execute(
    spark: SparkSession, root: Path, plan: list[MonthPlan], only: list[str] | None = None, hook: Callable[[str, str], None] | None = None
) -> Result:
    """Clean, fact, quality and OD per month, then every station-day month that they touch.

    The returns of a month, old or new, may touch published months outside the plan too.
    A month's failure stays its own; a failed station-day month fails the months that asked
    for it. ``only`` restricts a retry to months of the same plan.
    """
    result, touched = Result("SUCCEEDED"), {}
    tables.publish_calendar(spark, root)
    chosen = [m for m in plan if only is None or m.month in only]
    planned = {m.month for m in plan}
    for m in chosen:
        step = lambda s, m=m: hook(m.month, s) if hook else None
        said = result.months[m.month] = {"status": "FAILED", "source": m.status, "steps": {}, "error": ""}
        if m.status in ("MISSING", "REMOVED"):
            said["error"] = "no source" if m.status == "MISSING" else "the source no longer has the month"
            continue
        fact = Scope(root, "fact", m.month)
        try:
            said["steps"]["clean"] = tables.publish_clean(spark, root, m.month, list(m.units), list(m.expected) or None, m.recency, step)[1]
            said["steps"]["fact"] = tables.publish_fact(spark, root, m.month, hook=step)[1]
        except (PublishError, SourceError) as e:
            said["error"] = str(e)
            continue
        errors = []
        for name, run in (("quality", tables.publish_quality), ("od_day", tables.publish_od_day)):
            try:
                said["steps"][name] = run(spark, root, m.month, hook=step)[1]
            except PublishError as e:
                errors.append(f"{name}: {e}")
        said["error"] = "; ".join(errors)
        said["status"] = "FAILED" if errors else "PUBLISHED"
        old = spark.read.parquet(fact.data("fact", m.previous_fact)) if m.previous_fact else None
        months = impact_months(old, spark.read.parquet(fact.data("fact")), m.month, tables.FIRST_MONTH, tables.LAST_MONTH)
        for row in months.collect():  # service months of one fact month
            service = row["service_month"]
            # a month outside the plan without a fact is built when its own turn comes
            if service in planned or Scope(root, "fact", service).current():
                touched.setdefault(service, []).append(m.month)
    for month in sorted(touched):
        try:
            status = tables.publish_station_day(spark, root, month, hook=lambda s, month=month: hook(month, s) if hook else None)[1]
            result.station_days.append(month)
            for origin in touched[month]:
                result.months[origin]["steps"][f"station_day {month}"] = status
        except PublishError as e:
            for origin in touched[month]:
                result.months[origin].update(status="FAILED", error=f"station_day {month}: {e}")
    for m in chosen:
        said = result.months[m.month]
        if said["status"] == "PUBLISHED" and m.status == "UNCHANGED" and set(said["steps"].values()) <= {"REUSED_CURRENT"}:
            said["status"] = "SKIPPED_UNCHANGED"
    failed = result.failed()
    result.status = "SUCCEEDED" if not failed else "FAILED" if len(failed) == len(chosen) else "PARTIAL_FAILURE"
    return result


def retry(spark: SparkSession, root: Path, plan: list[MonthPlan], result: Result, **options) -> Result:
    """Runs the failed months of the original plan again."""
    return execute(spark, root, plan, only=result.failed(), **options)
