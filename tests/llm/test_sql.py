"""Registered SQL against the queries, over whole tables."""

from __future__ import annotations

import duckdb
import pytest

from cashwatch.llm.queries import ORACLE_SQL, QUERIES

TABLES = "documents embeddings benchmark conversations".split()


@pytest.mark.parametrize("name", ["op3_ngram_jaccard", "op7_embedding_near_dedup"])
def test_same_rows_as_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    expected = con.sql(ORACLE_SQL[name])
    found = QUERIES[name](spark, sf)
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())


def test_sql_is_of_registered_queries():
    assert set(ORACLE_SQL) <= set(QUERIES)
