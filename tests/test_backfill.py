"""Raw files to marts, with golden rows, failures, revisions and tampering."""

import datetime as dt
import zipfile

import pytest

from tripwright.backfill.run import Result, Source, execute, plan_id, plan_range, retry
from tripwright.plans.station_history import catalogue
from tripwright.publish import tables
from tripwright.publish.bundle import PublishError, Scope, check
from tripwright.sources.rental import HEADER_16, SourceError, SourceUnit, rows_of

TRIPS = [
    ("BIKE-A", "2020-01-31 23:50:00", "00001", "2020-02-01 00:10:00", "00002", 20, 100),
    ("BIKE-B", "2020-01-15 10:00:00", "00001", "2020-01-15 10:10:00", "00002", 10, 100),
    ("BIKE-LONG", "2020-01-01 00:00:00", "00001", "2020-03-01 00:10:00", "00004", 86400, 100),
    ("BIKE-SAME", "2020-02-01 01:00:00", "00002", "2020-02-01 01:10:00", "00001", 10, 0),
    ("BIKE-SAME", "2020-02-01 02:00:00", "00002", "", "", 20, 50),
    ("BIKE-E", "2020-02-01 03:00:00", "00003", "2020-02-01 03:30:00", "00004", 30, 100001),
    ("BIKE-MARCH", "2020-03-02 09:00:00", "00001", "2020-03-02 09:05:00", "00002", 5, 50),
]


def _csv(trips):
    lines = [",".join(HEADER_16)]
    for bike, rent, a, back, b, usage, metres in trips:
        lines.append(f'{bike},{rent},{a},"대여,소",0,{back},{b},반납소,0,{usage},{metres},1990,M,내국인,ST-1,ST-2')
    return ("\r\n".join(lines) + "\r\n").encode("cp949")


def _source(folder, month, trips, version="v1", recency=0):
    path = folder / f"{month}-{version}.csv"
    path.write_bytes(_csv([t for t in trips if t[1].startswith(month)]))
    return Source(month, SourceUnit(str(path), f"sv1_{version}_{month}"), recency=recency)


def _history(spark, root):
    cat = catalogue(spark.createDataFrame([("2019-12", "MONTH")], "observation_period string, observation_precision string"))
    rows = [("2019-12", s, "n", "d", "a", None, None, 1, None, "LCD", "stv", "sv") for s in ("1", "2", "4")]
    seen = spark.createDataFrame(rows, "observation_period string, station_no string, station_name string, district string, address string,"
                                 "latitude decimal(18,8), longitude decimal(18,8), lcd_capacity int, qr_capacity int, operation_mode string,"
                                 "station_version_id string, source_version_id string").join(cat, "observation_period")  # fmt: skip
    return tables.publish_history(spark, root, seen, cat, {"snapshots": ["2019-12"]})


def _mart(spark, root, kind, month):
    return spark.read.parquet(Scope(root, kind, month).data("mart"))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    files = tmp_path_factory.mktemp("files")
    _history(spark, root)
    plan = plan_range(root, "2020-01", "2020-03", [_source(files, m, TRIPS) for m in ("2020-01", "2020-02", "2020-03")])
    return root, files, plan, execute(spark, root, plan)


def test_golden_marts(spark, store):
    root, _, plan, result = store
    assert result.status == "SUCCEEDED" and [m.status for m in plan] == ["NEW"] * 3
    day = dt.date(2020, 2, 1)
    got = sorted(tuple(r) for r in _mart(spark, root, "station_day", "2020-02").collect())
    assert got == [
        (day, "1", 0, 1, 0, 0, None, None, 0, 0, 0), (day, "2", 2, 1, 1, 1, 15.0, 15.0, 1, 1, 2),
        (day, "3", 1, 0, 1, 1, 30.0, 30.0, 0, 0, 0), (day, "4", 0, 1, 0, 0, None, None, 0, 0, 0),
    ]
    assert sorted(tuple(r) for r in _mart(spark, root, "od_day", "2020-02").collect()) == [
        (day, "2", "1", 1, 1, 10.0, 10.0, 0, None, None), (day, "3", "4", 1, 1, 30.0, 30.0, 0, None, None),
    ]
    quality = _mart(spark, root, "quality", "2020-02").first()
    assert (quality["clean_row_count"], quality["trusted_fact_count"], quality["incomplete_trip_count"], quality["station_unmatched_count"]) == (3, 3, 1, 1)
    assert quality["distance_zero_rate"] == pytest.approx(1 / 3) and quality["schema_version"] == "rental_v16"
    march = check(Scope(root, "station_day", "2020-03"), Scope(root, "station_day", "2020-03").current())
    assert [x[1] for x in march["lineage"]["inputs"]] == ["2020-01", "2020-03"]


def test_same_inputs_are_reused(spark, store):
    root, _, plan, _ = store
    again = plan_range(root, "2020-01", "2020-03", [Source(m.month, m.units[0]) for m in plan])
    assert [m.status for m in again] == ["UNCHANGED"] * 3
    result = execute(spark, root, again)
    assert {r["status"] for r in result.months.values()} == {"SKIPPED_UNCHANGED"}
    text = result.to_json(plan_id(again))
    assert Result.from_json(text, plan_id(again)) == result
    with pytest.raises(PublishError):
        Result.from_json(text.replace("SUCCEEDED", "FAILED"), plan_id(again))


def test_failed_month_keeps_current_and_is_retried(spark, store):
    root, files, _, _ = store
    revised = [t if t[0] != "BIKE-A" else (*t[:3], "2020-03-05 00:10:00", *t[4:]) for t in TRIPS]
    sources = [_source(files, "2020-01", revised, "v2", 1), _source(files, "2020-02", TRIPS), _source(files, "2020-03", TRIPS)]
    plan = plan_range(root, "2020-01", "2020-03", sources)
    assert [m.status for m in plan] == ["REVISED", "UNCHANGED", "UNCHANGED"]
    before = Scope(root, "clean", "2020-01").current()

    def fail(month, step):
        if month == "2020-01" and step == "promote":
            raise PublishError("injected")

    result = execute(spark, root, plan, hook=fail)
    assert result.status == "PARTIAL_FAILURE" and result.failed() == ["2020-01"]
    assert Scope(root, "clean", "2020-01").current() == before
    result = retry(spark, root, plan, result)
    assert result.status == "SUCCEEDED" and result.station_days == ["2020-01", "2020-02", "2020-03"]
    returns = {m: _mart(spark, root, "station_day", m).agg({"return_count": "sum"}).first()[0] for m in ("2020-02", "2020-03")}
    assert returns == {"2020-02": 2, "2020-03": 3}


def test_revision_reaches_months_outside_the_plan_and_over_retries(spark, tmp_path):
    root, files = tmp_path / "root", tmp_path
    _history(spark, root)
    plan = plan_range(root, "2020-01", "2020-03", [_source(files, m, TRIPS) for m in ("2020-01", "2020-02", "2020-03")])
    assert execute(spark, root, plan).status == "SUCCEEDED"
    # BIKE-LONG came back in March and comes back in February now: March is reached by the old fact only
    revised = [t if t[0] != "BIKE-LONG" else (*t[:3], "2020-02-20 00:10:00", *t[4:]) for t in TRIPS]
    plan = plan_range(root, "2020-01", "2020-01", [_source(files, "2020-01", revised, "v2", 1)])
    assert plan[0].status == "REVISED" and plan[0].previous_fact
    march = Scope(root, "station_day", "2020-03").current()

    def fail(month, step):
        if month == "2020-03":
            raise PublishError("injected")

    result = execute(spark, root, plan, hook=fail)
    assert result.failed() == ["2020-01"] and Scope(root, "station_day", "2020-03").current() == march
    result = retry(spark, root, plan, result)
    assert result.status == "SUCCEEDED" and result.station_days == ["2020-01", "2020-02", "2020-03"]
    returns = {m: _mart(spark, root, "station_day", m).agg({"return_count": "sum"}).first()[0] for m in ("2020-02", "2020-03")}
    assert returns == {"2020-02": 4, "2020-03": 1}


def test_row_of_another_month_fails_the_unit(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes(_csv(TRIPS[:4]))
    with pytest.raises(PublishError):
        tables.publish_clean(spark, tmp_path / "root", "2020-01", [SourceUnit(str(path), "sv1_x")])
    assert Scope(tmp_path / "root", "clean", "2020-01").current() is None


def test_tampering_is_found(spark, tmp_path):
    version, status = tables.publish_calendar(spark, tmp_path)
    scope = Scope(tmp_path, "date", "all")
    assert status == "PUBLISHED_CURRENT" and check(scope, version)
    victim = next(scope.version(version).rglob("*.parquet"))
    victim.write_bytes(victim.read_bytes() + b"x")
    with pytest.raises(PublishError):
        check(scope, version)


def test_zip_members_and_odd_files(tmp_path):
    path = tmp_path / "y.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.csv", _csv(TRIPS[:2]))
    rows = list(rows_of(SourceUnit(str(path), "v", "a.csv")))
    assert [r[0] for r in rows] == [1, 2] and rows[0][2][3] == "대여,소"
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n")
    with pytest.raises(SourceError):
        list(rows_of(SourceUnit(str(bad), "v")))
