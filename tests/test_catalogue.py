"""Every catalogued query against its oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from tessella import catalogue, catalogue_decks, catalogue_drawings  # noqa: F401

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 6) if isinstance(v, float) and math.isfinite(v) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    oracle = duck.execute(catalogue.ORACLES[name])
    columns = [d[0] for d in oracle.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.collect(), df.columns) == plain(oracle.fetchall(), columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
