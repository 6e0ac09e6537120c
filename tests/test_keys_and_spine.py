from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cashwatch.functions.keys import hash_assign, key_assign, padded_key
from cashwatch.operators.spine import calendar_spine, fill_gaps, observed_spine, with_each

DAY = date(2026, 1, 30)


def test_padded_keys_never_cut_the_number(spark):
    df = spark.createDataFrame([(7,), (123456,), (1234567,)], "n long").select(padded_key("CP", F.col("n"), 6).alias("k"))
    assert [r.k for r in df.collect()] == ["CP000007", "CP123456", "CP1234567"]


@pytest.fixture
def ids(spark):
    return spark.range(20_000)


def test_hash_groups_do_not_depend_on_the_partitioning_and_are_spread_evenly(ids):
    group = hash_assign([F.col("id")], 7, "group").alias("g")
    once, other = ids.select("id", group), ids.repartition(13).select("id", group)
    assert once.exceptAll(other).count() == 0
    sizes = [r["count"] for r in once.groupBy("g").count().collect()]
    assert len(sizes) == 7 and min(sizes) > 2500 and max(sizes) < 3200


def test_salts_make_attributes_independent(ids):
    pairs = ids.select(*[hash_assign([F.col("id")], 3, salt).alias(salt) for salt in ("product", "channel")])
    counts = [r["count"] for r in pairs.groupBy("product", "channel").count().collect()]
    assert len(counts) == 9 and min(counts) > 1900


def test_key_groups_are_remainders(spark):
    df = spark.createDataFrame([(-1,), (0,), (9,), (None,)], "n long").select(key_assign(F.col("n"), 7).alias("g"))
    assert [r.g for r in df.collect()] == [6, 0, 2, None]


def test_observed_spine_takes_its_bounds_from_the_data(spark):
    keys = spark.createDataFrame([("A1",), ("A2",)], "account_id string")
    seen = spark.createDataFrame([(DAY + timedelta(days=2),), (None,), (DAY,)], "value_date date")
    rows = {tuple(r) for r in observed_spine(keys, seen).collect()}
    assert rows == {(DAY + timedelta(days=n), a) for n in range(3) for a in ("A1", "A2")}
    assert observed_spine(keys, seen.limit(0)).count() == 0


def test_spine_runs_forward_without_a_join(spark, plan):
    keys = spark.createDataFrame([("A1",), ("A2",)], "account_id string")
    grid = calendar_spine(with_each(keys, "currency", ["THB", "USD"]), DAY, 3)
    assert grid.columns == ["value_date", "account_id", "currency"]
    rows = {tuple(r) for r in grid.collect()}
    assert rows == {(DAY + timedelta(days=n), a, c) for n in range(3) for a in ("A1", "A2") for c in ("THB", "USD")}
    assert calendar_spine(keys, DAY, 0).count() == 0
    text = plan(grid)
    assert "Exchange" not in text and "Join" not in text and "Cartesian" not in text


def test_gaps_keep_their_row(spark):
    keys = spark.createDataFrame([("A1",)], "account_id string")
    seen = spark.createDataFrame([(DAY + timedelta(days=1), "A1", 5.0)], "value_date date, account_id string, v double")
    filled = fill_gaps(calendar_spine(keys, DAY, 3), seen, ["value_date", "account_id"]).orderBy("value_date")
    assert [r.v for r in filled.collect()] == [None, 5.0, None]
