"""Every registered query against its SQL on the same tables."""

import glob
import os

import duckdb
import pytest
from conftest import SMALL
from tools.compare import rows_of

from tripweave.plans import oracles, registry

QUERIES, SQL = registry.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    expected = con.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, expected.fetchall())


def test_entry_runs(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 1182
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_sorted_result_is_in_order(spark):
    keys = [r.trip_id for r in QUERIES["trips_sorted"](spark, SMALL).collect()]
    assert keys == sorted(keys) and len(keys) > 1000
    latest = [r.trip_id for r in QUERIES["trips_latest"](spark, SMALL).collect()]
    assert latest == keys[::-1][:500]
