"""Station files to observations, quarantine and history."""

import csv
import datetime as dt
import io
import zipfile
from decimal import Decimal
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from tripwright.functions.identity import content_id
from tripwright.operators import stations as S
from tripwright.publish import tables
from tripwright.publish.bundle import PublishError, Scope
from tripwright.sources.rental import SourceError
from tripwright.sources.station import HEADER, Snapshot, csv_rows, data_rows, period_of, read_snapshots, xlsx_rows

BASE = ["00102", "역 앞", "마포구", "월드컵로 72", "37.5556488", "126.9106293", "2015-09-06", "", "15", "QR"]
NAME = "대여소 정보({} 기준).{}"


def _row(**change):
    return [change.get(f, v) for f, v in zip(S.FIELDS, BASE, strict=True)]


def _csv(rows, encoding="cp949"):
    out = io.StringIO(newline="")
    csv.writer(out).writerows([*HEADER, *rows])
    return out.getvalue().encode(encoding)


def _xlsx(rows, extra="", shared=("공유",)):
    lines = []
    for n, row in enumerate([*HEADER, *rows], 1):
        cells = [
            f'<c r="{chr(65 + k)}{n}"><v>{v}</v></c>' if n > 5 and k in (0, 4, 5, 6, 7, 8)
            else f'<c r="{chr(65 + k)}{n}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
            for k, v in enumerate(row) if v
        ]
        if cells:
            lines.append(f'<row r="{n}">{"".join(cells)}{extra if n == 6 else ""}</row>')
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="s" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="rId7" Target="worksheets/a.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>{''.join(f'<si><t>{s}</t></si>' for s in shared)}</sst>")
        z.writestr("xl/worksheets/a.xml", f'<worksheet {main}><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()


def _snapshot(folder, rows, when="22.06월", version="sv1_a", suffix="csv"):
    path = folder / f"{version}.{suffix}"
    path.write_bytes(_csv(rows) if suffix == "csv" else _xlsx(rows))
    return Snapshot(str(path), version, NAME.format(when, suffix))


def _observed(spark, snapshot):
    seen, bad = tables.station_tables(spark, snapshot)
    return {r["station_no"]: r for r in seen.collect()}, bad.collect()


def test_csv_and_xlsx_give_the_same_rows():
    rows = [_row(), [""] * 10, _row(station_no="00103")]
    want = [(1, rows[0]), (3, rows[2])]
    for encoding in ("cp949", "utf-8-sig", "utf-8"):
        assert list(data_rows(csv_rows(_csv(rows, encoding)))) == want
    # the sheet has no row for blank lines, header row 5 among them; numbers stay
    assert list(data_rows(xlsx_rows(_xlsx(rows)))) == want
    assert list(data_rows(xlsx_rows(_xlsx([_row(qr_capacity="")], '<c r="I6" t="s"><v>0</v></c>'))))[0][1][8] == "공유"


@pytest.mark.parametrize("cell", ['<c r="A6"><v>9</v></c>', '<c r="K6"><v>9</v></c>', '<c r="H6"><f>1+1</f><v>2</v></c>', '<c r="H7"><v>1</v></c>', '<c r="H6" t="s"><v>8</v></c>'])
def test_refused_cells(cell):
    with pytest.raises(SourceError):
        list(xlsx_rows(_xlsx([_row()], cell)))


@pytest.mark.parametrize("content", [b"PK", _csv([])[:40], _csv([_row()[:9]]), b"\xff\xff"])
def test_refused_files(content):
    with pytest.raises(SourceError):
        list(data_rows((xlsx_rows if content == b"PK" else csv_rows)(content)))


CASES = [
    ({}, []),
    ({"station_no": "ST-102"}, [("station_no_invalid", "station_no", "station number is missing or is not ASCII decimal digits")]),
    ({"district": "  "}, [("station_attribute_missing", "district", "district is missing")]),
    ({"latitude": ""}, [("station_coordinate_invalid", "latitude", "latitude is missing")]),
    ({"latitude": "90.00000001"}, [("station_coordinate_invalid", "latitude", "latitude is not a finite coordinate in [-90,90]")]),
    ({"longitude": "NaN"}, [("station_coordinate_invalid", "longitude", "longitude is not a finite coordinate in [-180,180]")]),
    ({"latitude": "-90", "longitude": "1.8e2"}, []),
    ({"qr_capacity": "15.0"}, []),
    ({"qr_capacity": "15.5"}, [("station_capacity_invalid", "qr_capacity", "qr_capacity must be a non-negative integer")]),
    ({"qr_capacity": "-1"}, [("station_capacity_invalid", "qr_capacity", "qr_capacity must be a non-negative integer")]),
    ({"operation_mode": " lcd "}, [("station_mode_capacity_mismatch", "operation_mode", "LCD row also contains QR capacity")]),
    ({"lcd_capacity": "0"}, [("station_mode_capacity_mismatch", "operation_mode", "QR row also contains LCD capacity")]),
    ({"operation_mode": "it's\n"}, [("station_operation_mode_invalid", "operation_mode", "unrecognized operation mode \"it's\\n\"")]),
    ({"operation_mode": "'\"\\"}, [("station_operation_mode_invalid", "operation_mode", "unrecognized operation mode " + repr("'\"\\"))]),
]


def test_every_station_rule(spark, tmp_path):
    raw = read_snapshots(spark, [_snapshot(tmp_path, [_row(**c) for c, _ in CASES])])
    got = S.station_rows(raw).orderBy("source_row_number").collect()
    for r, (change, issues) in zip(got, CASES, strict=True):
        assert [(i["rule_id"], i["field"], i["reason"]) for i in r["dq_issues"]] == issues, change
    assert got[0]["source_row_id"] == content_id("rr1", ["sv1_a", NAME.format("22.06월", "csv"), 1])
    assert got[0]["content"] == content_id("", BASE) and got[0]["station_no"] == "102" and got[0]["station_no_raw"] == "00102"
    assert got[6]["longitude"] == Decimal(180) and got[7]["qr_capacity"] == 15 and got[10]["operation_mode"] == "LCD"


def test_numbers_are_rounded_and_serial_days_are_dates(spark):
    df = spark.createDataFrame([("0.123456785",), ("0.123456775",), ("42253",), ("42253.9",), ("0",), ("soon",), (" ",)], "s string")
    got = df.select(S.coordinate(F.col("s"), 90), S.installation(F.col("s"), F.lit(True)), S.installation(F.col("s"), F.lit(False))).collect()
    assert [r[0] for r in got[:2]] == [Decimal("0.12345678"), Decimal("0.12345678")]
    assert [r[1] for r in got[2:]] == ["2015-09-06", "2015-09-06", "0", "soon", None]
    assert [r[2] for r in got[2:]] == ["42253", "42253.9", "0", "soon", None]


def test_rows_of_a_station_agree_repeat_or_conflict(spark, tmp_path):
    rows = [
        _row(station_no="1", lcd_capacity="20", qr_capacity="", operation_mode="LCD"), _row(station_no="01", qr_capacity="5", installation_value="2019"),
        _row(station_no="2"), _row(station_no="2"), _row(station_no="2", address="b"),
        _row(station_no="3"), _row(station_no="3"), _row(station_no="ST-4", district=""),
    ]
    seen, bad = _observed(spark, _snapshot(tmp_path, rows))
    assert set(seen) == {"1", "3"}
    one, three = seen["1"], seen["3"]
    assert (one["operation_mode"], one["lcd_capacity"], one["qr_capacity"]) == ("LCD+QR", 20, 5)
    assert one["installation_values"] == ["2015-09-06", "2019"] and one["source_row_numbers"] == [1, 2] and one["dq_issues"] == []
    assert three["exact_duplicate_count"] == 1 and [i["reason"] for i in three["dq_issues"]] == ["1 exact duplicate source row(s) collapsed"]
    assert sorted((r["source_row_number"], r["rule_id"], r["field"], r["station_group_ref"]) for r in bad if r["station_no"]) == [
        (3, "station_identity_conflict", "address", "2"), (4, "station_exact_duplicate", "source_row", "2"),
        (4, "station_identity_conflict", "address", "2"), (5, "station_identity_conflict", "address", "2"),
    ]
    nameless = [(r["rule_id"], r["station_no_raw"], r["station_group_ref"]) for r in bad if not r["station_no"]]
    assert sorted(nameless) == [("station_attribute_missing", "ST-4", None), ("station_no_invalid", "ST-4", None)]


def test_files_to_history(spark, tmp_path):
    root = tmp_path / "root"
    snaps = [
        _snapshot(tmp_path, [_row(station_no="10", address="A"), _row(station_no="2", address="X")], "21.01.31", "sv1_1"),
        _snapshot(tmp_path, [_row(station_no="10", address="A"), _row(station_no="3", address="Z")], "21.06월", "sv1_2", "xlsx"),
        _snapshot(tmp_path, [_row(station_no="10", address="B"), _row(station_no="3", address="Z"), _row(station_no="3", address="Y")], "21.12월", "sv1_3"),
        _snapshot(tmp_path, [_row(station_no="10", address="B"), _row(station_no="3", address="Z")], "22.06월", "sv1_4"),
    ]
    with pytest.raises(PublishError):
        tables.publish_station_history(spark, root)
    for s in snaps:
        assert tables.publish_station(spark, root, s)[1] == "PUBLISHED_CURRENT"
    assert tables.publish_station(spark, root, snaps[0])[1] == "REUSED_CURRENT"
    assert [r[0] for r in spark.read.parquet(Scope(root, "station", "2021-01-31").data("observations")).select("station_no").collect()] == ["2", "10"]
    assert tables.publish_station_history(spark, root)[1] == "PUBLISHED_CURRENT"
    got = spark.read.parquet(Scope(root, "history", "all").data("history")).collect()
    day = lambda s: s and dt.date.fromisoformat(s)
    # station 3 conflicts in the third snapshot: two intervals with a gap, though its state is the same
    assert sorted((r["station_no"], r["applicable_from"], r["applicable_until"] or dt.date.max, r["address"], r["observation_count"]) for r in got) == [
        ("10", day("2021-01-31"), day("2022-01-01"), "A", 2), ("10", day("2022-01-01"), dt.date.max, "B", 2),
        ("2", day("2021-01-31"), day("2021-07-01"), "X", 1),
        ("3", day("2021-07-01"), day("2022-01-01"), "Z", 1), ("3", day("2022-07-01"), dt.date.max, "Z", 1),
    ]
    # the snapshot of a day that a month's snapshot applies from, too, is refused
    tables.publish_station(spark, root, _snapshot(tmp_path, [_row()], "22.07.01", "sv1_5"))
    with pytest.raises(PublishError):
        tables.publish_station_history(spark, root)


def test_a_changed_bundle_stops_the_history(spark, tmp_path):
    root = tmp_path / "root"
    version, _ = tables.publish_station(spark, root, _snapshot(tmp_path, [_row()]))
    part = next((Scope(root, "station", "2022-06").version(version) / "observations").glob("*.parquet"))
    part.write_bytes(part.read_bytes() + b"x")
    with pytest.raises(PublishError):
        tables.publish_station_history(spark, root)


def test_validation_reads_the_source_again(spark, tmp_path):
    snapshot = _snapshot(tmp_path, [_row()])

    def change(step):
        if step == "validate":
            (tmp_path / "sv1_a.csv").write_bytes(_csv([_row(), _row(station_no="7")]))

    with pytest.raises(PublishError):
        tables.publish_station(spark, tmp_path / "root", snapshot, hook=change)
    assert Scope(tmp_path / "root", "station", "2022-06").current() is None


def test_periods():
    assert period_of(NAME.format("21.1.5", "csv")) == ("2021-01-05", "DAY")
    with pytest.raises(SourceError):
        Snapshot("x", "v", NAME.format("22.06월", "txt")).format  # noqa: B018
