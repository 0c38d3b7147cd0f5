"""Every registered query against its SQL on the smallest given tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from threadloom.plans.catalog.base import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "-"
    return f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    rows = df.collect()
    if name not in driver.oracle_sql():
        assert rows
        return
    result = duck.execute(driver.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert table(df.columns, rows) == table(names, result.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
