"""Every registered query against its SQL in DuckDB, and rules every plan must keep."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
import parity.oracle
import parity.queries

DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test data not present")
duckdb = pytest.importorskip("duckdb")

QUERIES, ORACLE = parity.queries.QUERIES, parity.oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, str(DATA))
    expected = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    assert got and got == comparable(expected.columns, expected.fetchall())


EAGER = {
    "monitoring_run", "monitoring_written", "monitoring_rerun", "partitioned_roundtrip", "bucketed_limit_utilization",
    "daily_snapshot", "daily_snapshot_staged", "anomaly_flags", "monitoring_versioned", "net_cashflow_stream", "dq_files",
}
LAZY = sorted(set(QUERIES) - EAGER)


@pytest.mark.parametrize("name", LAZY)
def test_plans_have_no_python_no_cross_join_and_no_limit(spark, plan, name):
    text = plan(QUERIES[name](spark, str(DATA)))
    for forbidden in ("Python", "Arrow", "CartesianProduct", "NestedLoopJoin", "ObjectHashAggregate", "CollectLimit"):
        assert forbidden not in text


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
