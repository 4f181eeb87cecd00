"""Typed readings, row rules, group rules, consolidation and history on small rows."""

import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripwright.functions import text as T
from tripwright.functions.identity import content_id, row_id, trip_key
from tripwright.operators.groups import group_status
from tripwright.operators.row_rules import FIELDS, canonical, month_of, typed
from tripwright.operators.stations import consolidate
from tripwright.plans.station_history import catalogue, islands
from tripwright.schemas import SchemaMismatch, require_schema
from tripwright.sources.months import compare_inventories, months_of
from tripwright.sources.rental import SourceError
from tripwright.sources.station import HEADER, data_rows, period_of

BASE = dict(
    bike_id=" SPB-1 ", rent_at="2026-01-01 00:00:00", rent_station_no=" 01729 ", rent_station_name="n", rent_dock_no="0",
    return_at="2026-01-01 00:10:00", return_station_no="00002", return_station_name="r", return_dock_no="0", usage_min="10",
    distance_m="1234.50", birth_year="1990", sex="M", user_type="x", rent_station_internal_id="ST-1",
    return_station_internal_id="ST-2", bike_type=None,
)

CASES = [
    ({}, []),
    ({"bike_id": "  "}, ["bike_id_missing"]),
    ({"rent_at": "soon"}, ["rent_at_invalid"]),
    ({"rent_at": r"\N"}, ["rent_at_missing"]),
    ({"rent_at": "2026-1-1 0:0:0"}, []),
    ({"return_at": "2025-12-31 23:59:59"}, ["return_before_rent"]),
    ({"return_at": "", "return_station_no": ""}, ["return_station_invalid", "return_at_missing"]),
    ({"rent_station_no": "ST-9"}, ["rent_station_invalid"]),
    ({"usage_min": "1440"}, []),
    ({"usage_min": "1441"}, ["usage_min_over_1440"]),
    ({"usage_min": "-1"}, ["usage_min_negative"]),
    ({"usage_min": "1_0"}, ["usage_min_invalid"]),
    ({"distance_m": "0"}, ["distance_m_zero"]),
    ({"distance_m": "-0.1"}, ["distance_m_negative"]),
    ({"distance_m": "100000"}, []),
    ({"distance_m": "100001"}, ["distance_m_extreme_positive"]),
    ({"distance_m": "NaN"}, ["distance_m_invalid"]),
    ({"distance_m": "1e3"}, []),
    ({"birth_year": ""}, ["birth_year_missing"]),
    ({"birth_year": "2027"}, ["birth_year_impossible"]),
    ({"birth_year": "0"}, ["birth_year_impossible"]),
    ({"sex": " f "}, ["sex_noncanonical"]),
    ({"sex": "x"}, ["sex_noncanonical"]),
    ({"sex": "   "}, ["sex_missing"]),
]


def _rows(spark, changes):
    schema = "n int, " + ", ".join(f"{f} string" for f in FIELDS)
    return spark.createDataFrame([(k, *({**BASE, **c}[f] for f in FIELDS)) for k, c in enumerate(changes)], schema)


def test_every_rule_and_threshold(spark):
    got = {r["n"]: r for r in canonical(typed(_rows(spark, [c for c, _ in CASES]))).collect()}
    for k, (change, rules) in enumerate(CASES):
        assert [i["rule_id"] for i in got[k]["dq_issues"]] == rules, change
    assert got[0]["bike_id"] == "SPB-1" and got[0]["rent_station_no"] == "1729" and got[0]["distance_m"] == Decimal("1234.5")
    assert got[0]["is_completed_trip"] and not got[6]["is_completed_trip"]
    assert got[21]["sex_code"] == "F" and got[22]["sex_code"] is None
    assert not got[14]["row_quarantined"] and got[13]["row_quarantined"]


def test_values_that_no_type_holds_are_hard_errors(spark):
    changes = [{}, {"distance_m": "0.1234567890123456789"}, {"distance_m": "1e21"}, {"usage_min": "9" * 20}, {"birth_year": "40000"}]
    got = [r["hard_error"] for r in typed(_rows(spark, changes)).orderBy("n").collect()]
    assert got == [False, True, True, True, True]


def test_month_status(spark):
    rows = typed(_rows(spark, [{}, {"rent_at": "2026-02-01 00:00:00"}, {"rent_at": ""}]))
    got = [(r["source_month"], r["month_status"]) for r in month_of(rows, ["2026-01"]).orderBy("n").collect()]
    assert got == [("2026-01", "MATCH"), ("2026-02", "MISMATCH"), ("2026-01", "UNAVAILABLE")]


def test_trimming_is_unicode(spark):
    df = spark.createDataFrame([("　 1　",), ("\t00\n",), ("",), (None,)], "s string")
    got = [(r[0], r[1]) for r in df.select(T.trimmed(F.col("s")), T.station_number(F.col("s"))).collect()]
    assert got == [("1", "1"), ("00", "0"), (None, None), (None, None)]


def test_identities_equal_python(spark):
    odd = 'a"b\\c\x1f/가\n'
    df = spark.createDataFrame([(odd, 7, dt.datetime(2026, 1, 2, 3, 4, 5))], "m string, n bigint, t timestamp_ntz")
    got = df.select(row_id(F.lit("sv1_x"), F.col("m"), F.col("n")), trip_key(F.col("m"), F.col("t"))).first()
    digest = lambda x: hashlib.sha256(json.dumps(x, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    assert got[0] == "rr1_" + digest(["sv1_x", odd, 7])
    assert got[1] == "ltk1_" + digest([odd, "2026-01-02 03:04:05"])
    assert content_id("a", {"b": 1, "a": 2}) == content_id("a", {"a": 2, "b": 1})


def test_conflict_beats_duplicate_and_null_keys_stay_out(spark):
    rows = [("d", "1"), ("d", "1"), ("c", "1"), ("c", "1"), ("c", "2"), ("s", "1"), (None, "1"), (None, "2")]
    df = spark.createDataFrame(rows, "logical_trip_key string, row_content_sha256 string")
    got = {r["logical_trip_key"]: (r["n_rows"], r["conflict"], r["duplicate"]) for r in group_status(df).collect()}
    assert got == {"d": (2, False, True), "c": (3, True, False)}


def _station(number, row, **change):
    base = dict(source_row_id=f"r{row}", source_row_number=row, station_no=number, station_name="s", district="d", address="a",
                latitude=Decimal("37.5"), longitude=Decimal("126.9"), lcd_capacity=None, qr_capacity=None, operation_mode=None,
                installation_value=None, dq_issues=[])
    row = {**base, **change}
    return {**row, "content": str([v for k, v in row.items() if not k.startswith("source")])}


def test_same_snapshot_consolidation(spark):
    rows = [
        _station("1", 6, lcd_capacity=20, operation_mode="LCD", installation_value="2015"),
        _station("1", 7, qr_capacity=5, operation_mode="QR", installation_value="2019"),
        _station("2", 8), _station("2", 9), _station("2", 10, address="b"),
        _station("3", 11), _station("3", 12),
        _station("4", 13, qr_capacity=1), _station("4", 14, qr_capacity=2),
    ]
    schema = ("source_row_id string, source_row_number bigint, station_no string, station_name string, district string, address string,"
              "latitude decimal(18,8), longitude decimal(18,8), lcd_capacity int, qr_capacity int, operation_mode string, installation_value string,"
              "dq_issues array<struct<rule_id:string,severity:string,field:string,reason:string>>, content string")  # fmt: skip
    seen, bad = consolidate(spark.createDataFrame([tuple(r.values()) for r in rows], schema))
    got = {r["station_no"]: r for r in seen.collect()}
    assert set(got) == {"1", "3"}
    assert (got["1"]["operation_mode"], got["1"]["lcd_capacity"], got["1"]["qr_capacity"]) == ("LCD+QR", 20, 5)
    assert got["1"]["installation_values"] == ["2015", "2019"] and got["3"]["exact_duplicate_count"] == 1
    issues = sorted((r["source_row_id"], r["rule_id"]) for r in bad.collect())
    assert issues == [
        ("r10", "station_identity_conflict"), ("r13", "station_capacity_conflict"), ("r14", "station_capacity_conflict"),
        ("r8", "station_identity_conflict"), ("r9", "station_exact_duplicate"), ("r9", "station_identity_conflict"),
    ]


def test_history_gaps_end_intervals(spark):
    snaps = [("2021-01-31", "DAY"), ("2021-06", "MONTH"), ("2021-12", "MONTH"), ("2022-06", "MONTH")]
    cat = catalogue(spark.createDataFrame(snaps, "observation_period string, observation_precision string"))
    rows = [("2021-01-31", "1", "A"), ("2021-01-31", "2", "X"), ("2021-06", "1", "A"), ("2021-06", "3", "Z"),
            ("2021-12", "1", "B"), ("2021-12", "2", "X"), ("2021-12", "3", "Z"), ("2022-06", "1", "B"), ("2022-06", "3", "Z")]
    seen = spark.createDataFrame(rows, "observation_period string, station_no string, state string").join(cat, "observation_period")
    got = islands(seen, cat, state=("state",), lists={"observation_period": "periods"}).orderBy("station_no", "applicable_from").collect()
    day = lambda s: s and dt.date.fromisoformat(s)
    assert [(r[0], r[1], r[2], r["state"], r["observation_count"]) for r in got] == [
        ("1", day("2021-01-31"), day("2022-01-01"), "A", 2), ("1", day("2022-01-01"), None, "B", 2),
        ("2", day("2021-01-31"), day("2021-07-01"), "X", 1), ("2", day("2022-01-01"), day("2022-07-01"), "X", 1),
        ("3", day("2021-07-01"), None, "Z", 3),
    ]


@pytest.mark.parametrize(
    ("name", "months"),
    [("x_202006.csv", ["2020-06"]), ("x_2020.12.csv", ["2020-12"]), ("x_1512.csv", ["2015-12"]), ("x_22.06.CSV", ["2022-06"]),
     ("x_2606.csv", ["2026-06"]), ("x_22081.csv", ["2022-08"]), ("x_2020.07~08.csv", ["2020-07", "2020-08"]), ("README.txt", None)],
)
def test_member_months(name, months):
    assert months_of(name) == months


@pytest.mark.parametrize("name", ["202001-202002.csv", "2020-12-01.csv", "260615.csv", "201.csv", "2020.12~01.csv"])
def test_doubtful_members_are_errors(name):
    with pytest.raises(SourceError):
        months_of(name)


def test_inventories_and_periods():
    assert compare_inventories({"a": [(1, "x")], "b": [(1, "x")], "c": []}, {"a": [(1, "x")], "b": [(2, "y")], "d": []}) == {
        "a": "UNCHANGED", "b": "REVISED", "c": "REMOVED", "d": "NEW",
    }
    assert period_of("s(21.01.31 기준).csv") == ("2021-01-31", "DAY") and period_of("s(26.6월 기준).xlsx") == ("2026-06", "MONTH")
    rows = [*enumerate(HEADER, 1), (6, [""] * 10), (7, ["v"] * 10), (9, ["w"] * 10)]
    assert list(data_rows(iter(rows))) == [(2, ["v"] * 10), (4, ["w"] * 10)]
    for bad in (rows[1:], rows[:4], [(1, ["h"] * 10), *rows[1:]], [*rows, (10, ["x"] * 9)]):
        with pytest.raises(SourceError):
            list(data_rows(iter(bad)))


def test_schema_gate(spark):
    with pytest.raises(SchemaMismatch):
        require_schema(spark.range(1), (("id", "string"),))


@pytest.mark.parametrize(
    ("name", "months"),
    [("x_2020-12.csv", ["2020-12"]), ("x_2020_12.csv", ["2020-12"]), ("x_2020.12_1.csv", ["2020-12"]), ("x_2020.07 ~ 08.csv", ["2020-07", "2020-08"]),
     ("x_2020-07~08.csv", ["2020-07", "2020-08"]), ("plan2_2206.csv", ["2022-06"]), ("d/x_22081.csv", ["2022-08"]), ("x_22.06.csv", ["2022-06"])],
)
def test_more_month_names(name, months):
    assert months_of(name) == months


@pytest.mark.parametrize("name", ["x_3012.csv", "x_2020.13.csv", "x_2112~22.csv", "x_2020.08~07.csv", "x_2019.01_2020.02.csv", "x.csv"])
def test_refused_month_names(name):
    with pytest.raises(SourceError):
        months_of(name)


def test_white_space_at_the_ends(spark):
    from pyspark.sql import functions as F

    from tripwright.functions.text import WHITE_SPACE, integer_overflow, read_timestamp, utrim

    rows = spark.createDataFrame([(WHITE_SPACE + "a b" + WHITE_SPACE,), ("\u200bx\u200b",), ("",), (None,)], "t string")
    assert [r[0] for r in rows.select(utrim(F.col("t"))).collect()] == ["a b", "\u200bx\u200b", "", None]
    times = spark.createDataFrame([("2020-1-2  3:4:5",), ("2020-01-02T03:04:05",), ("2020-02-30 00:00:00",), ("20-01-02 03:04:05",), (" 2020-01-02\t03:04:05\u3000",)], "t string")
    assert [str(r[0]) for r in times.select(read_timestamp(F.col("t"))).collect()] == ["2020-01-02 03:04:05", "None", "None", "None", "2020-01-02 03:04:05"]
    numbers = spark.createDataFrame([("9223372036854775808",), ("1.5",), ("7",), (None,)], "t string")
    assert [r[0] for r in numbers.select(integer_overflow(F.col("t"))).collect()] == [True, False, False, False]


def test_content_hashes_equal_python(spark):
    from tripwright.functions.identity import content_hash

    rows = [["a", "", "\x1f\\u001F\n"], ["\\", "\x0b\x7f", '"가/']]
    df = spark.createDataFrame([(r,) for r in rows], "f array<string>")
    assert [r[0] for r in df.select(content_hash(F.col("f"))).collect()] == [content_id("", r) for r in rows]
