"""Every query that has a DuckDB twin gives its rows."""

import duckdb
import pytest

from tripwright.queries import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _rows(rows):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_duckdb(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({catalogue.ORACLES[name]})").fetchall()
    assert _rows(df.select(*columns).collect()) == _rows(want)
