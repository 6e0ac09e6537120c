"""Hot right keys, values carried forward, counts from footers, incomplete files."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cashwatch.operators.joins import hot_keys, left_join_split
from cashwatch.operators.quality import check_files_complete, check_nulls_and_rowcount
from cashwatch.operators.spine import carry_forward
from cashwatch.schemas import TRANSACTIONS
from cashwatch.sources import testdata
from cashwatch.sources.statistics import counts_of, footer_counts, table_counts
from cashwatch.sources.tables import read_parquet
from tests.build import at, transactions

D0 = date(2026, 1, 1)


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_split_join_equals_the_plain_one(spark):
    left = spark.createDataFrame([(k, f"l{k}") for k in [*range(20), None, 5]], "k int, l string")
    right = spark.createDataFrame([(1, 7.0)] * 500 + [(k, float(k or 0)) for k in [2, 2, 3, 30, None, 5]], "k int, r double")
    plain = left.join(right, ["k"], "left")
    for least in (1, 2, 100, 10_000):
        split = left_join_split(left, right, ["k"], least, parts=50)
        assert split.columns == plain.columns and rows_of(split) == rows_of(plain)
    assert rows_of(left_join_split(left, right.limit(0), ["k"], 1)) == rows_of(left.join(right.limit(0), ["k"], "left"))
    assert left_join_split(left.limit(0), right, ["k"], 1).count() == 0


def test_a_hot_right_key_lies_in_several_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "64")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("l"))
    right = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("long").alias("k"), F.lit(1.0).alias("r"))
    hot = hot_keys(right, ["k"], 1000).collect()
    assert [(r.k, r["_salts"]) for r in hot] == [(1, 101)]
    joined = left_join_split(left, right, ["k"], 1000)
    of_key = joined.filter("k = 1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in of_key) == 100_001 and len(of_key) > 30
    assert max(r["count"] for r in of_key) < 10_000


def test_hot_keys_are_fewer_than_the_parts(spark):
    even = spark.range(10_000).select((F.col("id") % 100).alias("k"))
    assert hot_keys(even, ["k"], 1, parts=100).count() == 0
    assert 0 < hot_keys(even.unionAll(even.filter("k < 50")), ["k"], 1, parts=100).count() < 100


@pytest.mark.parametrize("range_days", [1, 5, 1000])
def test_values_are_carried_forward(spark, range_days):
    rng = random.Random(2)
    rows, expected = [], []
    for key in ("a", "b", None):
        last, other = None, None
        for i in range(60):
            value, name = (None if rng.random() < 0.8 else float(i)), (None if rng.random() < 0.9 else f"n{i}")
            last, other = (last if value is None else value), (other if name is None else name)
            rows.append((key, D0 + timedelta(i), value, name))
            expected.append((key, D0 + timedelta(i), last, other))
    rows += [("a", None, None, None), ("z", D0, None, None)]
    expected += [("a", None, None, None), ("z", D0, None, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, value_date date, v double, n string")
    assert rows_of(carry_forward(df, ["k"], ["v", "n"], range_days=range_days)) == sorted(map(str, expected))
    assert carry_forward(df.limit(0), ["k"], ["v"]).count() == 0


def test_no_window_holds_the_dates_of_a_key(spark, plan):
    df = spark.createDataFrame([("a", D0, 1.0)], "k string, value_date date, v double")
    windows = [line for line in plan(carry_forward(df, ["k"], ["v"])).splitlines() if "Window [" in line]
    assert windows and all("_range" in line for line in windows)


def test_counts_come_from_footers(spark, tmp_path, plan):
    path = str(tmp_path / "tx")
    tx = transactions(spark, [(at(h), "CP1", "IN", 1.0 if h % 2 else None) for h in range(10)])
    tx.coalesce(2).write.parquet(path)
    with footer_counts(spark):
        text = plan(counts_of(read_parquet(spark, path), ["tx_id", "amount"]))
    assert "PushedAggregation: [COUNT(*), COUNT(tx_id), COUNT(amount)]" in text
    assert "BatchScan" not in plan(read_parquet(spark, path)), "other reads are as before"
    counts = table_counts(spark, path, ["tx_id", "amount"])
    args = (["tx_id", "amount"], "nulls", 1, 5, "volume")
    read = read_parquet(spark, path)
    assert rows_of(check_nulls_and_rowcount(read, *args, counts)) == rows_of(check_nulls_and_rowcount(read, *args))


def test_a_file_without_a_column_is_reported(spark, tmp_path):
    path = str(tmp_path / "tx")
    tx = testdata.transactions(spark, "/root/testdata/sf0.001")
    tx.repartition(3).write.parquet(path)
    tx.limit(10).drop("amount", "product").coalesce(1).write.mode("append").parquet(path)
    read = read_parquet(spark, path, TRANSACTIONS)
    (row,) = check_files_complete(read, ["tx_id", "amount", "product"], "files").collect()
    assert tuple(row) == ("files", False, "files_without={'amount': 1, 'product': 1}")
    (row,) = check_files_complete(read, ["tx_id", "currency"], "files").collect()
    assert tuple(row) == ("files", True, "ok")
