"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
OWN = sorted(k for k in SQL if not k.startswith("op") and k != "pipeline")


def rows(df):
    def plain(x):
        if x is None or (np.isscalar(x) or x is pd.NA) and pd.isna(x):
            return None
        return round(float(x), 3) + 0.0 if isinstance(x, (int, float, np.number)) and not isinstance(x, (bool, np.bool_)) else str(x)

    return sorted((tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", OWN)
def test_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
