"""Every registered query against its SQL in a second engine, on the small tables."""

import os

import duckdb
import pytest

from millrace.plans import catalog
from tests.compare import of_duckdb, of_frame

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the shared tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows(spark, tables, name):
    assert of_frame(catalog.QUERIES[name](spark, DATA)) == of_duckdb(tables, catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0
