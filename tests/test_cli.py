"""The command line's control commands, and months that arrive as a stream."""

import json

from test_backfill import TRIPS, _csv
from test_stations import NAME, _row
from test_stations import _csv as station_csv

from tripwright.cli import main
from tripwright.schemas import CLEAN, struct
from tripwright.streaming.arrivals import follow_clean


def _said(capsys, *args):
    code = main([str(a) for a in args])
    out = capsys.readouterr()
    return code, json.loads(out.out) if not code else out.err


def test_register_plan_and_inspect(tmp_path, capsys):
    path, manifest, raw = tmp_path / "x.csv", tmp_path / "m.json", tmp_path / "raw"
    path.write_bytes(_csv(TRIPS[:2]))
    about = ["--dataset-id", "rental_history", "--logical-period", "2020-01", "--published-filename", "x_202001.csv", "--source-url", "u", "--license", "l"]
    code, said = _said(capsys, "register-source", path, manifest, raw, *about)
    assert code == 0 and said["status"] == "NEW"
    assert _said(capsys, "register-source", path, manifest, raw, *about)[1]["status"] == "KNOWN_UNCHANGED"
    assert _said(capsys, "plan-registered", tmp_path / "root", manifest, raw, "2020-01", "2020-02") == (0, {"2020-01": "NEW", "2020-02": "MISSING"})
    assert _said(capsys, "inventory-zip", manifest, raw, said["source_version_id"])[0] == 1
    assert _said(capsys, "inspect-csv", path) == (0, {"encoding": "cp949", "schema_version": "rental_v16", "rows": 2})
    station = tmp_path / NAME.format("21.01.31", "csv")
    station.write_bytes(station_csv([_row()]))
    assert _said(capsys, "inspect-station", station) == (0, {"period": "2021-01-31", "precision": "DAY", "format": "CSV", "rows": 1})


def test_arrived_months_come_once(spark, tmp_path):
    clean, seen = tmp_path / "clean", []
    rows = [(n, *[None] * (len(CLEAN) - 1)) for n in ("a", "b", "c")]

    def arrive(month, row):
        spark.createDataFrame([row], struct(CLEAN)).coalesce(1).write.parquet(str(clean / month / "versions"))

    def follow():
        seen.clear()
        follow_clean(spark, str(clean), str(tmp_path / "checkpoint"), lambda df, n: seen.extend(r[0] for r in df.select("source_row_id").collect()))
        return sorted(seen)

    arrive("2020-01", rows[0])
    arrive("2020-02", rows[1])
    assert follow() == ["a", "b"] and follow() == []
    arrive("2020-03", rows[2])
    assert follow() == ["c"]
