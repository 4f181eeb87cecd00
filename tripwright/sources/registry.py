"""Registered raw files: a manifest of versions, verified copies, inventories of ZIP files.

Control data of a few hundred records, so it lives on the driver as JSON. Raw copies are never
written over: a version's folder is named by its id, which hashes the file's bytes.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import re
import uuid
import zipfile
from collections import Counter
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import asdict, dataclass, fields
from pathlib import Path
from typing import BinaryIO

from tripwright.functions.identity import content_id
from tripwright.publish.bundle import PublishError, read_json, write_json
from tripwright.sources.months import months_of
from tripwright.sources.rental import SourceError, SourceUnit

CHUNK = 1 << 20
_HEX = re.compile(r"[0-9a-f]{64}")


class RegistryError(SourceError):
    """A manifest, inventory or raw file that can't be trusted."""


def fingerprint(stream: BinaryIO) -> tuple[int, str]:
    """(bytes, SHA-256) of what is left of a stream."""
    size, digest = 0, hashlib.sha256()
    while block := stream.read(CHUNK):
        size += len(block)
        digest.update(block)
    return size, digest.hexdigest()


def file_fingerprint(path: Path) -> tuple[int, str]:
    try:
        with path.open("rb") as f:
            return fingerprint(f)
    except OSError as e:
        raise RegistryError(f"{path}: {e}") from e


@dataclass(frozen=True)
class Record:
    """One version of a source."""

    dataset_id: str
    published_filename: str
    logical_period: str
    source_modified_at: str | None
    observed_at: str
    size_bytes: int
    sha256: str
    source_url: str
    license: str
    source_version_id: str

    def __post_init__(self):
        for f in fields(self):
            value = getattr(self, f.name)
            if f.name == "size_bytes":
                if type(value) is not int or value < 0:
                    raise RegistryError("size_bytes must be a whole number")
            elif not (isinstance(value, str) and value) and not (f.name == "source_modified_at" and value is None):
                raise RegistryError(f"{f.name} must be a text")
        for value in (self.observed_at, self.source_modified_at):
            with_time = value or "2000-01-01T00:00:00+00:00"
            try:
                dt.datetime.fromisoformat(with_time)
            except ValueError as e:
                raise RegistryError(f"{value!r} is no ISO-8601 time") from e
        if not _HEX.fullmatch(self.sha256):
            raise RegistryError("sha256 must be 64 lower-case hexadecimal digits")
        if self.source_version_id != version_id(self.dataset_id, self.logical_period, self.published_filename, self.sha256):
            raise RegistryError(f"{self.source_version_id} is not the id of its record")

    @property
    def zipped(self) -> bool:
        return self.published_filename.lower().endswith(".zip")


def version_id(dataset_id: str, logical_period: str, published_filename: str, sha256: str) -> str:
    said = {"dataset_id": dataset_id, "logical_period": logical_period, "published_filename": published_filename, "sha256": sha256}
    return content_id("sv1", said)


def _checked(path: Path, keys: set[str], items: str) -> dict:
    try:
        found = read_json(path)
    except (OSError, ValueError, PublishError) as e:
        raise RegistryError(f"{path}: {e}") from e
    if not isinstance(found, dict) or set(found) != keys or found["schema_version"] != 1 or not isinstance(found[items], list):
        raise RegistryError(f"{path} has not the expected shape")
    return found


def load(manifest: Path) -> list[Record]:
    """The records in order of registration; a missing file is an empty manifest."""
    if not manifest.exists():
        return []
    out = []
    for item in _checked(manifest, {"schema_version", "records"}, "records")["records"]:
        if not isinstance(item, dict) or set(item) != {f.name for f in fields(Record)}:
            raise RegistryError(f"{manifest}: a record has not the expected fields")
        out.append(Record(**item))
    if len({r.source_version_id for r in out}) != len(out):
        raise RegistryError(f"{manifest}: a version is listed twice")
    return out


def raw_path(raw_root: Path, source_version_id: str) -> Path:
    return raw_root / "artifacts" / source_version_id


def _verify(path: Path, size: int, sha256: str) -> Path:
    if file_fingerprint(path) != (size, sha256):
        raise RegistryError(f"{path}: its bytes are not those that were registered")
    return path


def verified(raw_root: Path, record: Record) -> Path:
    """The path of a version's raw copy, whose bytes are those that were registered."""
    return _verify(raw_path(raw_root, record.source_version_id), record.size_bytes, record.sha256)


def _preserve(artifact: Path, target: Path, size: int, sha256: str) -> None:
    """A copy that is checked before it gets its name; an existing one stays and is checked."""
    target.parent.mkdir(parents=True, exist_ok=True)
    held = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
    try:
        with artifact.open("rb") as source, held.open("xb") as copy:
            while block := source.read(CHUNK):
                copy.write(block)
            copy.flush()
            os.fsync(copy.fileno())
        _verify(held, size, sha256)
        with suppress(FileExistsError):
            os.link(held, target)
        _verify(target, size, sha256)
    finally:
        held.unlink(missing_ok=True)


def register(
    artifact: Path, manifest: Path, raw_root: Path, *, dataset_id: str, logical_period: str, published_filename: str,
    source_url: str, license: str, source_modified_at: str | None = None,
) -> tuple[str, Record]:
    """(NEW, KNOWN_UNCHANGED or REVISION, record) of a file, which is copied to the raw store."""
    if manifest.resolve().is_relative_to((raw_root / "artifacts").resolve()):
        raise RegistryError("the manifest must not lie among the raw files")
    size, sha256 = file_fingerprint(artifact)
    known = load(manifest)
    record = Record(
        dataset_id, published_filename, logical_period, source_modified_at, dt.datetime.now(dt.UTC).isoformat(), size, sha256,
        source_url, license, version_id(dataset_id, logical_period, published_filename, sha256),
    )
    for old in known:
        if old.source_version_id == record.source_version_id:
            verified(raw_root, old)
            return "KNOWN_UNCHANGED", old
    _preserve(artifact, raw_path(raw_root, record.source_version_id), size, sha256)
    write_json(manifest, {"schema_version": 1, "records": [asdict(r) for r in (*known, record)]})
    revised = any((r.dataset_id, r.logical_period) == (dataset_id, logical_period) for r in known)
    return "REVISION" if revised else "NEW", record


@dataclass(frozen=True)
class Member:
    member_name: str
    member_size: int
    member_sha256: str


def _members(path: Path) -> Iterator[Member]:
    with zipfile.ZipFile(path) as z:
        for info in z.infolist():
            if info.is_dir():
                continue
            with z.open(info) as f:
                size, sha256 = fingerprint(f)
            if not info.filename or size != info.file_size:
                raise RegistryError(f"{path}: {info.filename!r} has no name or another size than it says")
            yield Member(info.filename, size, sha256)


def inventory(raw_root: Path, record: Record) -> list[Member]:
    """The members of a registered ZIP by name: made once, checked against the file's bytes ever after."""
    path = verified(raw_root, record)
    at = raw_root / "inventories" / f"{record.source_version_id}.json"
    if at.exists():
        return load_inventory(at, record.source_version_id)
    try:
        found = sorted(_members(path), key=lambda m: m.member_name)
    except (zipfile.BadZipFile, RuntimeError, NotImplementedError, OSError) as e:
        raise RegistryError(f"{record.published_filename}: {e}") from e
    if not found or len({m.member_name for m in found}) != len(found):
        raise RegistryError(f"{record.published_filename}: no members, or two of one name")
    write_json(at, {"schema_version": 1, "parent_source_version_id": record.source_version_id, "members": [asdict(m) for m in found]})
    return found


def load_inventory(path: Path, source_version_id: str) -> list[Member]:
    body = _checked(path, {"schema_version", "parent_source_version_id", "members"}, "members")
    try:
        out = [Member(**m) for m in body["members"]]
    except TypeError as e:
        raise RegistryError(f"{path}: {e}") from e
    whole = all(type(m.member_size) is int and m.member_size >= 0 and _HEX.fullmatch(str(m.member_sha256)) for m in out)
    names = [m.member_name for m in out]
    if body["parent_source_version_id"] != source_version_id or not whole or not names or names != sorted(set(names)):
        raise RegistryError(f"{path} is not the inventory of {source_version_id}")
    return out


def unit(raw_root: Path, record: Record, member_name: str | None = None) -> SourceUnit:
    """The source unit of a version: its file, or the member of its ZIP, which must be named."""
    if record.zipped != (member_name is not None):
        raise RegistryError(f"{record.published_filename}: name a member of a ZIP, and of a ZIP only")
    if member_name is None:
        return SourceUnit(str(verified(raw_root, record)), record.source_version_id, size=record.size_bytes, sha256=record.sha256)
    for m in inventory(raw_root, record):
        if m.member_name == member_name:
            return SourceUnit(str(raw_path(raw_root, record.source_version_id)), record.source_version_id, member_name, m.member_size, m.member_sha256)
    raise RegistryError(f"{record.published_filename} has no member {member_name}")


def months_in(raw_root: Path, record: Record) -> dict[str, list[SourceUnit]]:
    """Month to the units of a registered rental file; a member of several months is in each."""
    if not record.zipped:
        return {record.logical_period: [unit(raw_root, record)]}
    out: dict[str, list[SourceUnit]] = {}
    for m in inventory(raw_root, record):
        for month in months_of(m.member_name) or ():
            at = str(raw_path(raw_root, record.source_version_id))
            out.setdefault(month, []).append(SourceUnit(at, record.source_version_id, m.member_name, m.member_size, m.member_sha256))
    return out


def same_content(a: list[SourceUnit], b: list[SourceUnit]) -> bool:
    """Whether two lists of units hold the same files, each as often, whatever their names."""
    bag = lambda units: Counter((u.size, u.sha256) for u in units)
    return bag(a) == bag(b)
