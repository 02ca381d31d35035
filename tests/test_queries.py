"""Every query with SQL gives the same rows in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from sieveworks.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(str, frame.astype(object).where(frame.notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows(spark, duck, name):
    got = entry.queries()[name](spark, DATA).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["qa_id", "k"]
