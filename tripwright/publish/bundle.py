"""Content-addressed versions: stage, validate, promote, and swap the current pointer.

One publisher serves every table. A version's id is the hash of what goes into it, so the
same inputs meet the version that exists already and are not built again. A failed build,
validation or swap leaves the current pointer as it was. Data is written by Spark below
the store's root; promotion renames the staged folder, which is atomic on a file system.
"""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

from tripwright.functions.identity import canonical_json, content_id


class PublishError(RuntimeError):
    """A publication that must not go on; the current version is untouched."""


def _no_repeats(pairs: list[tuple[str, object]]) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise PublishError("repeated key in JSON")
    return out


def read_json(path: Path) -> dict:
    return json.loads(path.read_text(), object_pairs_hook=_no_repeats)


def write_json(path: Path, value: dict) -> None:
    """Whole or not at all: a temporary file, flushed to disk, then renamed."""
    path.parent.mkdir(parents=True, exist_ok=True)
    held = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    with held.open("w") as f:
        f.write(canonical_json(value))
        f.flush()
        os.fsync(f.fileno())
    os.replace(held, path)


def files_fingerprint(folder: Path) -> str:
    """The hash of all data files below ``folder``, for finding tampered bundles."""
    digest = hashlib.sha256()
    for p in sorted(x for x in folder.rglob("*") if x.is_file() and x.name != "metadata.json" and not x.name.endswith(".crc")):
        digest.update(f"{p.relative_to(folder)}\0".encode())
        with p.open("rb") as f:
            while block := f.read(1 << 20):
                digest.update(block)
    return digest.hexdigest()


@dataclass(frozen=True)
class Scope:
    """One published line of versions: a kind of table and what it is for, such as a month."""

    root: Path
    kind: str
    name: str

    @property
    def home(self) -> Path:
        return self.root / self.kind / self.name

    def version(self, version_id: str) -> Path:
        return self.home / "versions" / version_id

    @property
    def pointer(self) -> Path:
        return self.home / "current.json"

    def current(self) -> str | None:
        return read_json(self.pointer)["version_id"] if self.pointer.exists() else None

    def data(self, table: str, version_id: str | None = None) -> str:
        """The path of a table of the current (or a given) version."""
        found = version_id or self.current()
        if found is None:
            raise PublishError(f"{self.kind} {self.name} has no current version")
        return str(self.version(found) / table)


@contextlib.contextmanager
def locked(*scopes: Scope) -> Iterator[None]:
    """Locks of all scopes, taken in one order and without waiting."""
    with contextlib.ExitStack() as held:
        for scope in sorted(scopes, key=lambda s: (s.kind, s.name)):
            scope.home.mkdir(parents=True, exist_ok=True)
            f = held.enter_context((scope.home / ".lock").open("w"))
            try:
                fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
            except OSError as e:
                raise PublishError(f"{scope.kind} {scope.name} is being published") from e
        yield


@dataclass(frozen=True)
class Request:
    """What to publish: ``lineage`` decides the id, ``inputs`` are pointers that must stay."""

    scope: Scope
    prefix: str
    lineage: dict
    build: Callable[[Path], dict]
    validate: Callable[[Path], None]
    inputs: dict[Scope, str] = field(default_factory=dict)
    #: Orders versions of one scope; a lower number than the current one's is history only.
    recency: int | None = None
    before_step: Callable[[str], None] = lambda step: None

    @property
    def version_id(self) -> str:
        return content_id(self.prefix, self.lineage)


def check(scope: Scope, version_id: str) -> dict:
    """The metadata of a version whose bytes are as they were published."""
    folder = scope.version(version_id)
    meta = read_json(folder / "metadata.json")
    if set(meta) != {"version_id", "lineage", "summary", "fingerprint", "recency"} or meta["version_id"] != version_id:
        raise PublishError(f"{folder}: wrong metadata")
    if files_fingerprint(folder) != meta["fingerprint"]:
        raise PublishError(f"{folder}: its files have changed")
    return meta


def publish(request: Request) -> tuple[str, str]:
    """(version id, PUBLISHED_CURRENT, REUSED_CURRENT, BUILT_HISTORICAL or REUSED_HISTORICAL)."""
    scope, version_id, hook = request.scope, request.version_id, request.before_step
    target = scope.version(version_id)
    built = not target.exists()
    if built:
        staged = scope.home / "staging" / f"{version_id}-{uuid.uuid4().hex}"
        staged.mkdir(parents=True)
        try:
            hook("build")
            summary = request.build(staged)
            hook("validate")
            request.validate(staged)
            meta = {"version_id": version_id, "lineage": request.lineage, "summary": summary, "recency": request.recency}
            write_json(staged / "metadata.json", meta | {"fingerprint": files_fingerprint(staged)})
            target.parent.mkdir(parents=True, exist_ok=True)
            hook("promote")
            with contextlib.suppress(OSError):  # another publisher may have been first with the same content
                os.rename(staged, target)
        finally:
            shutil.rmtree(staged, ignore_errors=True)
    check(scope, version_id)
    if not built:
        request.validate(target)
    hook("swap")
    with locked(scope, *request.inputs):
        for other, seen in request.inputs.items():
            if other.current() != seen:
                raise PublishError(f"{other.kind} {other.name} changed meanwhile")
        now = scope.current()
        if now == version_id:
            return version_id, "REUSED_CURRENT"
        if now is not None and request.recency is not None and (read_json(scope.version(now) / "metadata.json")["recency"] or 0) > request.recency:
            return version_id, "BUILT_HISTORICAL" if built else "REUSED_HISTORICAL"
        write_json(scope.pointer, {"schema_version": 1, "version_id": version_id})
    return version_id, "PUBLISHED_CURRENT"
