"""Every query of the library that has SQL, held against DuckDB on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark.plans import registry

TABLES = "/root/testdata/sf0.001"
NAMES = sorted(registry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(TABLES):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for name in os.listdir(TABLES):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{TABLES}/{name}'")
    return con


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and np.isnan(value)):
        return None
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(map(plain, value))
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, float, np.number)):
        return round(float(value), 6)
    return str(value)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, TABLES)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, result.fetchall())


def test_every_query_is_registered_once():
    assert set(NAMES) <= set(registry.queries()) and len(NAMES) > 90
