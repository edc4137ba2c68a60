"""The driver contract: entry(), queries() and oracle_sql() agree with each other."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF_SMALL
from keysweep.plans.catalog import ORACLE_SQL, QUERIES

TABLES = "events".split()


def test_entry_returns_summary(spark):
    df = contract.entry(spark)
    assert df.columns == ["deleted_events", "skipped_events"]
    row = df.first()
    assert row["deleted_events"] > 0 and row["skipped_events"] > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql_at_small_scale(spark, con, key):
    df = contract.queries()[key](spark, SF_SMALL)
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    res = con.execute(contract.oracle_sql()[key])
    names = [d[0] for d in res.description]
    want = sorted(res.fetchall(), key=repr)
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    assert got == sorted((tuple(r[i] for i in order) for r in want), key=repr)
