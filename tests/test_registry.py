"""Registration, verification, inventories, and backfill plans from registered sources."""

import json
import zipfile

import pytest
from test_backfill import TRIPS, _csv, _history, _mart

from tripwright.backfill.run import execute, plan_registered
from tripwright.publish.bundle import PublishError, Scope
from tripwright.sources import registry
from tripwright.sources.registry import RegistryError
from tripwright.sources.rental import SourceError, rows_of


class Store:
    def __init__(self, folder):
        self.folder, self.manifest, self.raw, self.root = folder, folder / "manifest.json", folder / "raw", folder / "root"

    def register(self, content, name, period, dataset="rental_history"):
        path = self.folder / "incoming"
        path.write_bytes(content)
        return registry.register(
            path, self.manifest, self.raw, dataset_id=dataset, logical_period=period, published_filename=name,
            source_url="https://example.org/x", license="open",
        )

    def register_zip(self, members, name="y.zip", period="2020"):
        path = self.folder / "z"
        with zipfile.ZipFile(path, "w") as z:
            z.mkdir("d")
            for member, content in members:
                z.writestr(member, content)
        return self.register(path.read_bytes(), name, period)

    def plan(self, last="2020-03"):
        return plan_registered(self.root, self.manifest, self.raw, "2020-01", last)


@pytest.fixture
def store(tmp_path):
    return Store(tmp_path)


def _month(m):
    return _csv([t for t in TRIPS if t[1].startswith(m)])


def test_registration_knows_new_known_and_revised(store):
    status, record = store.register(b"a", "x_202001.csv", "2020-01")
    assert status == "NEW" and record.size_bytes == 1 and registry.verified(store.raw, record).read_bytes() == b"a"
    assert store.register(b"a", "x_202001.csv", "2020-01") == ("KNOWN_UNCHANGED", record)
    assert store.register(b"b", "x_202001.csv", "2020-01")[0] == "REVISION"
    assert store.register(b"b", "x_202001.csv", "2020-01", "other")[0] == "NEW"
    assert [r.source_version_id for r in registry.load(store.manifest)][0] == record.source_version_id
    registry.raw_path(store.raw, record.source_version_id).write_bytes(b"c")
    with pytest.raises(RegistryError):
        store.register(b"a", "x_202001.csv", "2020-01")


@pytest.mark.parametrize("change", [{"size_bytes": True}, {"sha256": "A" * 64}, {"license": ""}, {"observed_at": "soon"}, {"logical_period": "2020-02"}, {"more": 1}])
def test_damaged_manifests_are_refused(store, change):
    store.register(b"a", "x_202001.csv", "2020-01")
    body = json.loads(store.manifest.read_text())
    body["records"][0].update(change)
    store.manifest.write_text(json.dumps(body))
    with pytest.raises(RegistryError):
        registry.load(store.manifest)


def test_a_version_twice_and_a_key_twice_are_refused(store):
    store.register(b"a", "x_202001.csv", "2020-01")
    text = store.manifest.read_text()
    body = json.loads(text)
    for bad in (json.dumps({**body, "records": body["records"] * 2}), text.replace('"license"', '"license":"x","license"')):
        store.manifest.write_text(bad)
        with pytest.raises(RegistryError):
            registry.load(store.manifest)


def test_inventories(store):
    _, record = store.register_zip([("b_2002.csv", b"22"), ("a_2001.csv", b"1"), ("README.txt", b"")])
    found = registry.inventory(store.raw, record)
    assert [(m.member_name, m.member_size) for m in found] == [("README.txt", 0), ("a_2001.csv", 1), ("b_2002.csv", 2)]
    assert registry.inventory(store.raw, record) == found
    assert {m: [u.member_name for u in us] for m, us in registry.months_in(store.raw, record).items()} == {"2020-01": ["a_2001.csv"], "2020-02": ["b_2002.csv"]}
    for name in (None, "c.csv"):
        with pytest.raises(RegistryError):
            registry.unit(store.raw, record, name)
    with pytest.warns(UserWarning), pytest.raises(RegistryError):
        registry.inventory(store.raw, store.register_zip([("a", b"1"), ("a", b"2")], period="2021")[1])
    with pytest.raises(RegistryError):
        registry.inventory(store.raw, store.register(b"no zip", "z.zip", "2022")[1])
    at = next((store.raw / "inventories").glob("*.json"))
    at.write_text(at.read_text().replace("a_2001", "z_2001"))
    with pytest.raises(RegistryError):
        registry.inventory(store.raw, record)


def test_a_unit_is_verified_before_it_is_read(store):
    _, record = store.register(_month("2020-01"), "x_202001.csv", "2020-01")
    unit = registry.unit(store.raw, record)
    assert len(list(rows_of(unit))) == 3
    registry.raw_path(store.raw, record.source_version_id).write_bytes(_month("2020-02"))
    with pytest.raises(SourceError):
        list(rows_of(unit))


def test_plans_from_registered_sources(spark, store):
    _history(spark, store.root)
    first = store.register_zip([("x_2020.01~02.csv", _month("2020-01") + _month("2020-02").split(b"\r\n", 1)[1]), ("x_2003.csv", _month("2020-03"))])[1]
    assert [m.status for m in store.plan()] == ["NEW", "NEW", "NEW"]
    assert store.plan()[0].expected == ("2020-01", "2020-02")
    result = execute(spark, store.root, store.plan())
    assert result.status == "SUCCEEDED", result
    returns = {m: _mart(spark, store.root, "station_day", m).agg({"return_count": "sum"}).first()[0] for m in ("2020-02", "2020-03")}
    assert returns == {"2020-02": 3, "2020-03": 2}
    assert [m.status for m in store.plan()] == ["UNCHANGED"] * 3
    # the same files under other names in a new ZIP: nothing changes, the version stays
    same = (_month("2020-01") + _month("2020-02").split(b"\r\n", 1)[1])
    store.register_zip([("y_2020.01~02.csv", same), ("README.txt", b"x")])
    plan = store.plan()
    assert [m.status for m in plan] == ["UNCHANGED", "UNCHANGED", "REMOVED"]
    assert plan[0].units[0].source_version_id == first.source_version_id
    current = Scope(store.root, "clean", "2020-03").current()
    result = execute(spark, store.root, plan, only=["2020-03"])
    assert result.failed() == ["2020-03"] and Scope(store.root, "clean", "2020-03").current() == current
    # a month by itself and in a ZIP has no clear source
    store.register(_month("2020-01"), "x_202001.csv", "2020-01")
    with pytest.raises(PublishError):
        store.plan()
