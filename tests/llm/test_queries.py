"""Queries of this subpackage that have SQL give the same rows in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from sieveworks.llm import entries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_same_rows(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = entries.queries()[name](spark, DATA), duck.sql(entries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())
