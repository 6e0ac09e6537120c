from __future__ import annotations

import pytest

from cashwatch.operators.quality import (
    check_no_duplicates,
    check_no_nulls,
    check_nulls_and_rowcount,
    check_rowcount_between,
    dq_suite,
)
from cashwatch.schemas import BALANCES, CASHFLOWS, COLLATERAL, INPUT_TABLES, LIMITS, TRANSACTIONS
from cashwatch.sources.tables import read_parquet

ROWS = [(1, "a", None), (1, "a", 2.0), (1, "a", None), (None, "b", 1.0), (None, "b", 1.0), (2, None, 1.0)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "k int, s string, v double")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "k int, s string, v double")


def only(check):
    (row,) = check.collect()
    return row.check_name, row.passed, row.details


def test_null_counts_name_bad_columns_in_the_given_order(df):
    assert only(check_no_nulls(df, ["v", "k", "s"], "c")) == ("c", False, "null_counts={'v': 2, 'k': 2, 's': 1}")
    assert only(check_no_nulls(df.filter("k = 1"), ["k", "v"], "c")) == ("c", False, "null_counts={'v': 2}")


def test_no_nulls_passes(df, empty):
    assert only(check_no_nulls(df.filter("k = 1"), ["k", "s"], "c")) == ("c", True, "ok")
    assert only(check_no_nulls(empty, ["k", "s"], "c")) == ("c", True, "ok")


def test_duplicates_count_all_copies_and_null_keys_are_equal(df, empty):
    assert only(check_no_duplicates(df, ["k"], "c")) == ("c", False, "duplicate_rows=5")
    assert only(check_no_duplicates(df, ["k", "v"], "c")) == ("c", False, "duplicate_rows=4")
    assert only(check_no_duplicates(df.filter("k = 2"), ["k"], "c")) == ("c", True, "ok")
    assert only(check_no_duplicates(empty, ["k"], "c")) == ("c", True, "ok")


def test_a_hot_key_is_counted_before_the_shuffle(df, plan):
    text = plan(check_no_duplicates(df, ["k"], "c"))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


@pytest.mark.parametrize("low, high, passed", [(6, 6, True), (0, 5, False), (7, 9, False)])
def test_rowcount_bounds_are_inclusive(df, low, high, passed):
    assert only(check_rowcount_between(df, low, high, "n")) == ("n", passed, f"rowcount=6, expected=[{low},{high}]")


def test_two_checks_from_one_scan(df):
    got = check_nulls_and_rowcount(df, ["k"], "nulls", 1, 5, "rows").collect()
    assert [tuple(r) for r in got] == [
        ("nulls", False, "null_counts={'k': 2}"),
        ("rows", False, "rowcount=6, expected=[1,5]"),
    ]


def test_counts_can_come_from_file_statistics(spark, df, conf, plan, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    conf("spark.sql.sources.useV1SourceList", "")
    conf("spark.sql.parquet.aggregatePushdown", "true")
    check = check_nulls_and_rowcount(spark.read.parquet(str(tmp_path / "t")), ["k", "s"], "nulls", 1, 9, "rows")
    assert "PushedAggregation: [COUNT(*), COUNT(k), COUNT(s)]" in plan(check)
    assert [r.details for r in check.collect()] == ["null_counts={'k': 2, 's': 1}", "rowcount=6, expected=[1,9]"]


def test_suite_on_empty_tables(spark):
    tables = [spark.createDataFrame([], s) for s in (TRANSACTIONS, CASHFLOWS, BALANCES, COLLATERAL, LIMITS)]
    got = {r.check_name: (r.passed, r.details) for r in dq_suite(*tables).collect()}
    assert set(got) == {
        "tx_no_nulls",
        "tx_pk_unique",
        "tx_volume_sanity",
        "cf_no_nulls",
        "cf_pk_unique",
        "bal_no_nulls",
        "bal_key_unique",
        "col_no_nulls",
        "col_pk_unique",
        "lim_no_nulls",
        "lim_key_unique",
    }
    assert got.pop("tx_volume_sanity") == (False, "rowcount=0, expected=[1,10000000]")
    assert set(got.values()) == {(True, "ok")}


def test_nulls_are_found_in_a_table_read_with_a_not_null_schema(spark, tmp_path):
    schema, partition = INPUT_TABLES["balances"]
    path = str(tmp_path / "balances")
    spark.sql(
        "SELECT DATE '2026-01-23' AS as_of_date, 'A1' AS account_id, CAST(NULL AS STRING) AS currency, "
        "CAST(NULL AS DOUBLE) AS balance, 'x' AS customer_segment"
    ).write.partitionBy(partition).parquet(path)
    check = check_no_nulls(read_parquet(spark, path, schema), ["account_id", "currency", "balance"], "c")
    assert only(check) == ("c", False, "null_counts={'currency': 1, 'balance': 1}")
