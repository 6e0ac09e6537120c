from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from cashwatch.schemas import BALANCES, INPUT_TABLES, conform
from cashwatch.sources.tables import (
    read_parquet,
    run_together,
    stage,
    write_bucketed,
    write_parquet,
    write_parquet_partitioned,
)

D1, D2 = date(2026, 1, 23), date(2026, 1, 24)
SCHEMA = "value_date date, currency string, v double"


@pytest.mark.parametrize("small_groups", [False, True])
def test_only_the_written_partitions_are_replaced(spark, tmp_path, small_groups):
    path, keys = str(tmp_path / "t"), ["value_date", "currency"]
    rows = [(D1, "THB", 1.0), (D1, "USD", 2.0), (D2, "THB", 3.0)]
    write_parquet_partitioned(spark.createDataFrame(rows, SCHEMA), path, keys, small_groups)
    write_parquet_partitioned(spark.createDataFrame([(D1, "THB", 9.0)], SCHEMA), path, keys, small_groups)
    got = {(r.value_date, r.currency, r.v) for r in read_parquet(spark, path).collect()}
    assert got == {(D1, "THB", 9.0), (D1, "USD", 2.0), (D2, "THB", 3.0)}


def test_a_schema_keeps_a_numeric_looking_partition_as_text(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(D1, "0764", 1.0)], SCHEMA)
    write_parquet_partitioned(df, path, ["currency"])
    assert read_parquet(spark, path, df.schema).first().currency == "0764"


def test_partition_filters_reach_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(D1, "THB", 1.0), (D2, "THB", 2.0)], SCHEMA)
    write_parquet_partitioned(df, path, ["value_date"])
    text = plan(read_parquet(spark, path, df.schema).filter(F.col("value_date") == F.lit(D2)).select("v"))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(value_date" in scan and "ReadSchema: struct<v:double>" in scan


def test_a_large_partition_is_split_and_small_groups_are_one_file_each(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    big = spark.range(200_000).select(F.lit("USD").alias("currency"), F.rand(1).alias("v"))
    write_parquet_partitioned(big, str(tmp_path / "big"), ["currency"])
    assert len(list((tmp_path / "big" / "currency=USD").glob("*.parquet"))) > 1
    small = spark.range(1000).select((F.col("id") % 20).alias("g"), "id").repartition(7)
    write_parquet_partitioned(small, str(tmp_path / "small"), ["g"], small_groups=True)
    assert len(list((tmp_path / "small").glob("g=*/*.parquet"))) == 20


def test_unpartitioned_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1.0, 2.0):
        write_parquet(spark.createDataFrame([(D1, "THB", v)], SCHEMA), path)
    assert [r.v for r in read_parquet(spark, path).collect()] == [2.0]


def test_stage_returns_the_same_rows_from_the_written_table(spark, tmp_path, plan):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("part"))
    staged = stage(df, str(tmp_path / "s"), ["part"])
    assert staged.columns == df.columns and "Range" not in plan(staged)
    assert staged.exceptAll(df).count() == df.exceptAll(staged).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, plan, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("left_side", "right_side"):
        df = spark.range(1000).select(F.col("id").alias("k"), F.lit(name).alias(name))
        write_bucketed(df, name, ["k"], 4, path=str(tmp_path / name))
    joined = spark.table("left_side").join(spark.table("right_side"), "k", "left")
    assert "Exchange" not in plan(joined) and "Join" in plan(joined)
    assert joined.filter("right_side IS NOT NULL").count() == 1000
    for name in ("left_side", "right_side"):
        spark.sql(f"DROP TABLE {name}")


def test_a_bucket_is_one_file(spark, tmp_path):
    df = spark.range(1000).repartition(7)
    write_bucketed(df, "one_file_each", ["id"], 8, path=str(tmp_path / "bucketed"))
    assert len(list((tmp_path / "bucketed").glob("part-*.parquet"))) == 8


def test_conform_orders_and_casts(spark):
    raw = spark.sql(
        "SELECT 'x' AS customer_segment, '7.5' AS balance, 'THB' AS currency, 1 AS account_id, "
        "'2026-01-23' AS as_of_date, 0 AS extra"
    )
    got = conform(raw, BALANCES)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in BALANCES]
    assert tuple(got.first()) == (D1, "1", "THB", 7.5, "x")


def test_every_input_table_is_partitioned_by_one_of_its_dates():
    for schema, partition in INPUT_TABLES.values():
        assert schema[partition].dataType.typeName() == "date"


def test_run_together_returns_in_order_and_raises(spark):
    assert run_together(spark, lambda: spark.range(3).count(), lambda: spark.range(5).count()) == [3, 5]
    with pytest.raises(ZeroDivisionError):
        run_together(spark, lambda: 1, lambda: 1 // 0)
