"""Every registered query against its SQL on the whole tables, values compared row by row."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SQL = driver.tick_sql()


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return db


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    plain = [tuple(None if r[i] is None else r[i] for i in order) for r in rows]
    return names, sorted(plain, key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", driver.tick_queries())
def test_query_equals_sql(spark, tables, name):
    found = driver.tick_queries()[name](spark, SF_DIR)
    result = tables.execute(SQL[name])
    expected = normal(result.fetchall(), [d[0] for d in result.description])
    got = normal([tuple(r) for r in found.collect()], found.columns)
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1]) > 0
    assert got[1] == expected[1]


def test_every_query_has_sql():
    assert set(SQL) == set(driver.tick_queries())


def test_entry(spark):
    rows = driver.entry(spark)
    assert rows.columns == ["timestamp", "symbol", "window", "zscore_price"]
    assert rows.count() == 6000
