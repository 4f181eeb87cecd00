"""Station snapshots as a Spark data source: CSV or XLSX files with five header rows and ten columns.

A file is below a megabyte, so one task reads it whole, without a spreadsheet package. Data rows
are numbered from 1 after the header; blank rows are left out, but count.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tripwright.sources.rental import ENCODINGS, SourceError

#: The header, less white space: fixed values of the source files.
HEADER = (
    ("대여소번호", "보관소(대여소)명", "소재지(위치)", "", "", "", "설치시기", "설치형태", "", "운영방식"),
    ("", "", "", "", "", "", "", "LCD", "QR", ""),
    ("", "", "자치구", "상세주소", "위도", "경도", "", "", "", ""),
    ("", "", "", "", "", "", "", "거치대수", "거치대수", ""),
    ("", "", "", "", "", "", "", "", "", ""),
)
COLUMNS = 10
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DAY = re.compile(r"\((\d{2})\.(\d{1,2})\.(\d{1,2})\s*기준\)")
_MONTH = re.compile(r"\((\d{2})\.(\d{1,2})월?\s*기준\)")
_CELL = re.compile(r"([A-Z]+)([1-9][0-9]*)")

Rows = Iterator[tuple[int, list[str]]]


def period_of(name: str) -> tuple[str, str]:
    """(observation period, DAY or MONTH) from the file name."""
    if m := _DAY.search(name):
        return f"20{m[1]}-{int(m[2]):02d}-{int(m[3]):02d}", "DAY"
    if m := _MONTH.search(name):
        return f"20{m[1]}-{int(m[2]):02d}", "MONTH"
    raise SourceError(f"{name}: no observation period in the name")


def csv_rows(content: bytes) -> Rows:
    for encoding in ENCODINGS:
        try:
            text = content.decode(encoding)
        except UnicodeDecodeError:
            continue
        try:
            yield from enumerate(csv.reader(io.StringIO(text, newline=""), strict=True), 1)
        except csv.Error as e:
            raise SourceError(f"malformed CSV: {e}") from e
        return
    raise SourceError("neither UTF-8 nor CP949")


def _position(reference: str) -> tuple[int, int]:
    """(column from 0, row from 1) of a cell reference."""
    m = _CELL.fullmatch(reference)
    if not m:
        raise SourceError(f"{reference!r} is no cell reference")
    column = 0
    for c in m[1]:
        column = 26 * column + ord(c) - 64
    return column - 1, int(m[2])


def _text_of(cell: ElementTree.Element, shared: list[str]) -> str:
    if cell.get("t") == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    value = cell.findtext(f"{_MAIN}v") or ""
    if cell.get("t") != "s" or not value:
        return value
    if not value.isdecimal() or int(value) >= len(shared):
        raise SourceError(f"{cell.get('r')}: no shared string {value!r}")
    return shared[int(value)]


def _first_sheet(book: zipfile.ZipFile) -> ElementTree.Element:
    sheet = next(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"), None)
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = None if sheet is None else next((r.get("Target") for r in links if r.get("Id") == sheet.get(_REL)), None)
    if not target:
        raise SourceError("the workbook has no sheet")
    path = target.lstrip("/")
    return ElementTree.fromstring(book.read(path if path.startswith("xl/") else f"xl/{path}"))


def xlsx_rows(content: bytes) -> Rows:
    """Rows of the first sheet; formulas, repeated cells, rows out of order and wide rows are errors."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as book:
            shared = []
            if "xl/sharedStrings.xml" in book.namelist():
                items = ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{_MAIN}si")
                shared = ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in items]
            sheet = _first_sheet(book)
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError) as e:
        raise SourceError(f"malformed workbook: {e}") from e
    last = 0
    for row in sheet.iter(f"{_MAIN}row"):
        place = row.get("r") or ""
        if not place.isdecimal() or int(place) <= last:
            raise SourceError(f"row {place!r} comes after row {last}")
        last = int(place)
        cells: dict[int, str] = {}
        for cell in row.findall(f"{_MAIN}c"):
            column, line = _position(cell.get("r") or "")
            if line != last or column in cells or cell.find(f"{_MAIN}f") is not None:
                raise SourceError(f"row {last}: {cell.get('r')} is repeated, of another row or a formula")
            cells[column] = _text_of(cell, shared)
            if column >= COLUMNS and cells[column].strip():
                raise SourceError(f"row {last}: a value beyond column {COLUMNS}")
        yield last, [cells.get(k, "") for k in range(COLUMNS)]


def data_rows(rows: Rows) -> Rows:
    """Data rows, numbered from 1 after the header, less blank ones; ten fields each.

    ``rows`` carry the numbers of the file. Numbers that it skips are blank rows.
    """
    last = 0
    squeezed = lambda row: tuple(re.sub(r"\s+", "", x.lstrip("﻿")) for x in row)
    for number, row in rows:
        for k in range(last + 1, min(number, len(HEADER)) + 1):
            if squeezed(row if k == number else [""] * COLUMNS) != HEADER[k - 1]:
                raise SourceError(f"header row {k} is not the expected one")
        last = number
        if number > len(HEADER):
            if len(row) != COLUMNS:
                raise SourceError(f"data row {number - len(HEADER)} has {len(row)} fields, not {COLUMNS}")
            if any(x.strip() for x in row):
                yield number - len(HEADER), row
    if last < len(HEADER):
        raise SourceError(f"the file ends within its header of {len(HEADER)} rows")


@dataclass(frozen=True)
class Snapshot:
    """A station file and the version that it is; ``name`` is what it was published as."""

    path: str
    source_version_id: str
    name: str

    @property
    def format(self) -> str:
        found = Path(self.name).suffix.lower()
        if found not in (".csv", ".xlsx"):
            raise SourceError(f"{self.name} is neither CSV nor XLSX")
        return found[1:].upper()

    def rows(self) -> Rows:
        reader = csv_rows if self.format == "CSV" else xlsx_rows
        try:
            yield from data_rows(reader(Path(self.path).read_bytes()))
        except SourceError as e:
            raise SourceError(f"{self.name}: {e}") from e


class _Partition(InputPartition):
    def __init__(self, snapshot: Snapshot):
        self.snapshot = snapshot


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.snapshots = [Snapshot(options[f"path{k}"], options[f"version{k}"], options[f"name{k}"]) for k in range(int(options["files"]))]

    def partitions(self):
        return [_Partition(s) for s in self.snapshots]

    def read(self, partition):
        s = partition.snapshot
        for number, fields in s.rows():
            yield s.source_version_id, s.name, *period_of(s.name), s.format, number, fields


class StationSource(DataSource):
    """format("tripwright_station"); options files, path<k>, version<k>, name<k>."""

    @classmethod
    def name(cls):
        return "tripwright_station"

    def schema(self):
        return (
            "source_version_id string, published_filename string, observation_period string, observation_precision string,"
            "source_format string, source_row_number bigint, fields array<string>"
        )

    def reader(self, schema):
        return _Reader(self.options)


def read_snapshots(spark: SparkSession, snapshots: list[Snapshot]) -> DataFrame:
    """All data rows of ``snapshots``, a partition for each."""
    spark.dataSource.register(StationSource)
    reader = spark.read.format("tripwright_station").option("files", len(snapshots))
    for k, s in enumerate(snapshots):
        reader = reader.option(f"path{k}", s.path).option(f"version{k}", s.source_version_id).option(f"name{k}", s.name)
    return reader.load()
