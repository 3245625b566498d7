"""Every registered query against its SQL twin, on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from vialis import questions

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(value, 9) if isinstance(value, float) else str(value)


def table(frame):
    names = sorted(frame.columns)
    rows = [tuple(plain(x) for x in row) for row in frame[names].astype(object).itertuples(index=False, name=None)]
    return names, sorted(rows, key=str)


@pytest.mark.parametrize("name", sorted(questions.queries()))
def test_query_matches_sql(spark, duck, name):
    found = questions.queries()[name](spark, DATA).toPandas()
    sql = questions.oracle_sql().get(name)
    if sql is None:
        assert len(found) > 0
        return
    assert table(found) == table(duck.sql(sql).df())


def test_every_sql_has_a_query():
    assert set(questions.oracle_sql()) <= set(questions.queries())
