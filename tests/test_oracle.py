"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from dayprints import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, float):
        return repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def _rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(_plain(v) for v in r) for r in pdf.itertuples(index=False))


def test_every_query_of_the_catalog_has_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()
    assert catalog.queries().keys() <= QUERIES.keys()
    assert ORACLES.keys() <= QUERIES.keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_duckdb(spark, duck, key):
    ours = QUERIES[key](spark, SF).toPandas()
    theirs = duck.execute(ORACLES[key]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _rows(ours) == _rows(theirs)
