"""Command line: inspect a source unit, publish tables, back a range of months up."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict
from pathlib import Path

from tripwright.publish import tables
from tripwright.publish.bundle import PublishError, Scope
from tripwright.sources import registry
from tripwright.sources.months import months_of
from tripwright.sources.rental import SourceError, SourceUnit, rows_of, sniff
from tripwright.sources.station import Snapshot, period_of


def _sources(path: str):
    """Registered sources: a JSON list of {month, path, version, member?, yearly?, recency?}."""
    from tripwright.backfill.run import Source

    return [
        Source(s["month"], SourceUnit(s["path"], s["version"], s.get("member")), s.get("yearly", False), s.get("recency", 0))
        for s in json.loads(Path(path).read_text())
    ]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tripwright")
    commands = parser.add_subparsers(dest="command", required=True)
    inspect = commands.add_parser("inspect-csv")
    inspect.add_argument("path")
    inspect.add_argument("--member")
    commands.add_parser("member-months").add_argument("name")
    for name in ("fact", "od-day", "quality", "station-day"):
        p = commands.add_parser(f"publish-{name}")
        p.add_argument("root", type=Path)
        p.add_argument("month")
    station = commands.add_parser("publish-station")
    station.add_argument("root", type=Path)
    station.add_argument("path")
    station.add_argument("version")
    station.add_argument("--name", help="what the file was published as, if its own name is another")
    station.add_argument("--recency", type=int)
    commands.add_parser("publish-history").add_argument("root", type=Path)
    inspect_station = commands.add_parser("inspect-station")
    inspect_station.add_argument("path")
    commands.add_parser("publish-calendar").add_argument("root", type=Path)
    current = commands.add_parser("current")
    current.add_argument("root", type=Path)
    current.add_argument("kind")
    current.add_argument("name")
    backfill = commands.add_parser("backfill-range")
    backfill.add_argument("root", type=Path)
    backfill.add_argument("first")
    backfill.add_argument("last")
    backfill.add_argument("sources")
    register = commands.add_parser("register-source")
    for name in ("artifact", "manifest", "raw_root"):
        register.add_argument(name, type=Path)
    for name in ("dataset-id", "logical-period", "published-filename", "source-url", "license"):
        register.add_argument(f"--{name}", required=True)
    register.add_argument("--source-modified-at")
    listed = commands.add_parser("inventory-zip")
    for name in ("manifest", "raw_root"):
        listed.add_argument(name, type=Path)
    listed.add_argument("version")
    for command in ("plan-registered", "backfill-registered"):
        p = commands.add_parser(command)
        for name in ("root", "manifest", "raw_root"):
            p.add_argument(name, type=Path)
        p.add_argument("first")
        p.add_argument("last")
    args = parser.parse_args(argv)
    try:
        if args.command == "inspect-csv":
            unit = SourceUnit(args.path, "inspection", args.member)
            encoding, version = sniff(unit)
            print(json.dumps({"encoding": encoding, "schema_version": version, "rows": sum(1 for _ in rows_of(unit))}))
            return 0
        if args.command == "inspect-station":
            snapshot = Snapshot(args.path, "inspection", Path(args.path).name)
            period, precision = period_of(snapshot.name)
            print(json.dumps({"period": period, "precision": precision, "format": snapshot.format, "rows": sum(1 for _ in snapshot.rows())}))
            return 0
        if args.command == "member-months":
            print(json.dumps(months_of(args.name)))
            return 0
        if args.command == "register-source":
            about = {k: v for k, v in vars(args).items() if k not in ("command", "artifact", "manifest", "raw_root")}
            status, record = registry.register(args.artifact, args.manifest, args.raw_root, **about)
            print(json.dumps({"status": status, "source_version_id": record.source_version_id}))
            return 0
        if args.command == "inventory-zip":
            record = next((r for r in registry.load(args.manifest) if r.source_version_id == args.version), None)
            if record is None:
                raise SourceError(f"{args.version} is not registered")
            print(json.dumps([asdict(m) for m in registry.inventory(args.raw_root, record)], ensure_ascii=False))
            return 0
        if args.command == "plan-registered":
            from tripwright.backfill.run import plan_registered

            plan = plan_registered(args.root, args.manifest, args.raw_root, args.first, args.last)
            print(json.dumps({m.month: m.status for m in plan}))
            return 0
        if args.command == "current":
            print(Scope(args.root, args.kind, args.name).current())
            return 0
        from tripwright.session import get_session

        spark = get_session()
        if args.command in ("backfill-range", "backfill-registered"):
            from tripwright.backfill.run import execute, plan_id, plan_range, plan_registered

            if args.command == "backfill-range":
                plan = plan_range(args.root, args.first, args.last, _sources(args.sources))
            else:
                plan = plan_registered(args.root, args.manifest, args.raw_root, args.first, args.last)
            result = execute(spark, args.root, plan)
            print(result.to_json(plan_id(plan)))
            return 0 if result.status == "SUCCEEDED" else 1
        if args.command == "publish-station":
            snapshot = Snapshot(args.path, args.version, args.name or Path(args.path).name)
            print(*tables.publish_station(spark, args.root, snapshot, args.recency))
            return 0
        if args.command == "publish-history":
            print(*tables.publish_station_history(spark, args.root))
            return 0
        if args.command == "publish-calendar":
            print(*tables.publish_calendar(spark, args.root))
            return 0
        run = {"fact": tables.publish_fact, "od-day": tables.publish_od_day, "quality": tables.publish_quality, "station-day": tables.publish_station_day}
        print(*run[args.command.removeprefix("publish-")](spark, args.root, args.month))
        return 0
    except (PublishError, SourceError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
