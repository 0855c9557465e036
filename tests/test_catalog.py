"""Every query of the catalog against its SQL."""

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from graphloom.plans import catalog, catalog_graph, catalog_history, catalog_reports, catalog_runs, catalog_sources, catalog_store  # noqa: F401

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, Decimal):
        return str(value)
    return value.isoformat() if isinstance(value, datetime) else value


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.iterdir():
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, duck, name):
    found = catalog.QUERIES[name](spark, str(DATA))
    columns = sorted(found.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in found.collect()), key=repr)
    expected = duck.sql(catalog.ORACLES[name])
    names = list(expected.columns)
    assert columns == sorted(names)
    assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in expected.fetchall()), key=repr)
