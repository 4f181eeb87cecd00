"""Rental files as a Spark data source: CSV in two known layouts, plain or a member of a ZIP.

The reader is a Python data source with one partition per source unit, as only a file's
reader can number its rows; ``read`` opens the file anew, so a task may run again. Rows
carry the decoded, unmodified texts; typing and rules are column expressions on top.
"""

from __future__ import annotations

import csv
import hashlib
import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The two header layouts, fixed values of the source files.
HEADER_16 = (
    "자전거번호", "대여일시", "대여 대여소번호", "대여 대여소명", "대여거치대", "반납일시", "반납대여소번호", "반납대여소명",
    "반납거치대", "이용시간(분)", "이용거리(M)", "생년", "성별", "이용자종류", "대여대여소ID", "반납대여소ID",
)
HEADERS = {"rental_v16": HEADER_16, "rental_v17": (*HEADER_16, "자전거구분")}
ENCODINGS = ("utf-8-sig", "cp949")
HEADER_BYTES = 64 * 1024


class SourceError(ValueError):
    """A source file that must not be read further."""


@dataclass(frozen=True)
class SourceUnit:
    """A CSV file, or one member of a ZIP file, with the version that it belongs to."""

    path: str
    source_version_id: str
    member_name: str | None = None
    #: What the unit's bytes must be, if registered; each reading checks them first.
    size: int | None = None
    sha256: str | None = None

    def open(self):
        if self.member_name is None:
            return open(self.path, "rb")
        return io.BufferedReader(zipfile.ZipFile(self.path).open(self.member_name))

    def verify(self) -> None:
        if self.sha256 is None:
            return
        size, digest = 0, hashlib.sha256()
        with self.open() as f:
            while block := f.read(1 << 20):
                size += len(block)
                digest.update(block)
        if (size, digest.hexdigest()) != (self.size, self.sha256):
            raise SourceError(f"{self}: its bytes are not those that were registered")


def sniff(unit: SourceUnit) -> tuple[str, str]:
    """(encoding, schema version) from the header alone; an unknown header is an error."""
    with unit.open() as f:
        head = f.read(HEADER_BYTES)
    end = min([k for k in (head.find(b"\n"), head.find(b"\r")) if k >= 0], default=len(head) if len(head) < HEADER_BYTES else -1)
    if end < 0:
        raise SourceError(f"{unit}: the header is longer than {HEADER_BYTES} bytes")
    for encoding in ENCODINGS:
        try:
            names = tuple(next(csv.reader([head[:end].decode(encoding)], strict=True), ()))
        except (UnicodeDecodeError, csv.Error):
            continue
        for version, header in HEADERS.items():
            if names == header:
                return encoding, version
    raise SourceError(f"{unit}: unknown header")


def rows_of(unit: SourceUnit) -> Iterator[tuple[int, str, list[str]]]:
    """(row number from 1, schema version, fields) of every data row."""
    unit.verify()
    encoding, version = sniff(unit)
    width, n = len(HEADERS[version]), 0
    with unit.open() as f, io.TextIOWrapper(f, encoding=encoding, errors="strict", newline="") as text:
        reader = csv.reader(text, strict=True)
        try:
            next(reader)
            for n, fields in enumerate(reader, 1):
                if len(fields) != width:
                    raise SourceError(f"{unit}: row {n} has {len(fields)} fields, not {width}")
                yield n, version, fields
        except (csv.Error, UnicodeDecodeError) as e:
            raise SourceError(f"{unit}: after row {n}: {e}") from e
    if not n:
        raise SourceError(f"{unit}: no data rows")


class _Partition(InputPartition):
    def __init__(self, unit: SourceUnit):
        self.unit = unit


class _Reader(DataSourceReader):
    def __init__(self, options):
        n = int(options["units"])
        self.units = [
            SourceUnit(
                options[f"path{k}"], options[f"version{k}"], options.get(f"member{k}"), int(options[f"size{k}"]) if f"size{k}" in options else None,
                options.get(f"sha256_{k}"),
            )
            for k in range(n)
        ]

    def partitions(self):
        return [_Partition(u) for u in self.units]

    def read(self, partition):
        unit = partition.unit
        for number, version, fields in rows_of(unit):
            yield unit.source_version_id, unit.member_name, number, version, fields


class RentalSource(DataSource):
    """format("tripwright_rental"); options units, path<k>, version<k>, member<k>, size<k>, sha256_<k>."""

    @classmethod
    def name(cls):
        return "tripwright_rental"

    def schema(self):
        return "source_version_id string, member_name string, source_row_number bigint, schema_version string, fields array<string>"

    def reader(self, schema):
        return _Reader(self.options)


def read_units(spark: SparkSession, units: list[SourceUnit]) -> DataFrame:
    """All rows of ``units``, a partition for each."""
    spark.dataSource.register(RentalSource)
    reader = spark.read.format("tripwright_rental").option("units", len(units))
    for k, u in enumerate(units):
        reader = reader.option(f"path{k}", u.path).option(f"version{k}", u.source_version_id)
        if u.member_name is not None:
            reader = reader.option(f"member{k}", u.member_name)
        if u.sha256 is not None:
            reader = reader.option(f"size{k}", u.size).option(f"sha256_{k}", u.sha256)
    return reader.load()
