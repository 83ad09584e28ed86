"""The driver contract: entry, queries and their DuckDB oracles."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tickforge import registry

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["date", "fsym", "tsym"]


def test_every_query_has_an_oracle():
    core = set(registry.queries())
    assert core <= set(entry.queries()) and core <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(core) >= 60


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    rel = duck.sql(entry.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    s_rows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    d_idx = [rel.columns.index(c) for c in cols]
    d_rows = sorted((tuple(_norm(r[i]) for i in d_idx) for r in rel.fetchall()), key=repr)
    assert s_rows == d_rows
