"""Every query against its SQL in DuckDB, over the smallest tables."""

import os

import duckdb
import pytest

from sitesieve import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.sql(f"create view {f[:-8]} as select * from '{DIR}/{f}'")
    return c


def rows(values):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in values), key=str)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert catalogue.QUERIES[name](spark, DIR).count() > 0


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    df = catalogue.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    wanted = con.sql(f"select {','.join(columns)} from ({catalogue.ORACLES[name]})")
    assert rows(df.select(*columns).collect()) == rows(wanted.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
