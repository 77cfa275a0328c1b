"""Every registered graph query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from graphloom.plans.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.removesuffix('.parquet')} as from '{SF}/{name}'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return str(value) if not isinstance(value, (int, bool)) else value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted([tuple(normal(r[k]) for k in order) for r in data], key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    if name in ORACLES:
        result = oracle.execute(ORACLES[name])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        want = rows(columns, result.fetchall())
        assert len(got) == len(want)
        assert got == want
