"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import importlib.util
import os

import duckdb
import pytest

from tests.conftest import ROOT, SF001

spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(ROOT, "scripts", "check_oracle.py"))
check_oracle = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check_oracle)

import __spark_entry__ as E  # noqa: E402

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from strata.sources.tpch import TABLES

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.core_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert df.columns  # rows-only check
        return
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert check_oracle.digest(df.columns, rows)[0] == check_oracle.digest(cols, res.fetchall())[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns
