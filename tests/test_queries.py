"""Every registered query with SQL against it on the smallest tables."""

import numbers

import duckdb
import numpy as np
import pandas as pd
import pytest

from folioforge.plans.bridge import BASE
from folioforge.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, numbers.Number) and not isinstance(v, (bool, np.bool_)):
        return repr(round(float(v), 6))
    return str(v)


def rows(df):
    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in BASE:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
