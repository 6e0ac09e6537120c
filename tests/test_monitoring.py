"""The whole run: staged and lazy frames agree, outputs are complete and a day can be run again."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cashwatch.operators.grains import transaction_grains
from cashwatch.operators.flows import intraday_time_bucket
from cashwatch.plans.monitoring import OUTPUT_PARTITIONS, Settings, monitoring_frames, run_monitoring
from cashwatch.schemas import INPUT_TABLES
from cashwatch.sources import testdata
from cashwatch.sources.tables import read_parquet, write_parquet_partitioned

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test data not present")

SETTINGS = Settings(top_n=3, concentration_share=0.35)


@pytest.fixture(scope="module")
def inputs(spark):
    sources = (testdata.transactions, testdata.cashflows, testdata.balances, testdata.collateral, testdata.limits)
    return [source(spark, str(DATA)) for source in sources]


def rounded(df):
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return df.select(*[F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in sorted(df.columns)])


def same(a, b):
    a, b = rounded(a), rounded(b)
    return a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_staged_frames_equal_lazy_ones(spark, inputs, tmp_path):
    lazy = monitoring_frames(*inputs, settings=SETTINGS, lazy=True)
    staged = monitoring_frames(*inputs, settings=SETTINGS, staging_path=str(tmp_path))
    assert set(lazy) == set(staged) == set(OUTPUT_PARTITIONS)
    for name in lazy:
        assert same(lazy[name], staged[name]), name


def test_grains_take_one_scan_and_one_shuffle(spark, inputs, plan):
    text = plan(transaction_grains(intraday_time_bucket(inputs[0])))
    assert text.count("FileScan") == 1 and text.count("Exchange ") == 1


def test_invariants(spark, inputs):
    frames = monitoring_frames(*inputs, settings=SETTINGS)
    daily = frames["daily_snapshots"]
    assert daily.filter("NOT worst_cum_net_cashflow <= eod_cum_net_cashflow").count() == 0
    assert daily.filter("NOT eod_cum_net_cashflow <= best_cum_net_cashflow").count() == 0
    intraday = frames["intraday_snapshots"]
    assert intraday.filter("NOT cum_net_cashflow BETWEEN min_cum_net_cashflow AND max_cum_net_cashflow").count() == 0
    net = intraday.groupBy("value_date", "currency").agg(F.sum("net_cashflow").alias("net"))
    apart = daily.join(net, ["value_date", "currency"], "left").filter("NOT abs(net - eod_cum_net_cashflow) < 1e-6")
    assert apart.count() == 0


def test_results_do_not_depend_on_the_partitioning(spark, inputs):
    shuffled = [df.repartition(5) for df in inputs]
    before, after = monitoring_frames(*inputs, settings=SETTINGS), monitoring_frames(*shuffled, settings=SETTINGS)
    for name in before:
        assert same(before[name], after[name]), name


def test_run_writes_every_output_and_can_run_a_day_again(spark, inputs, tmp_path):
    raw, again, out = str(tmp_path / "raw"), str(tmp_path / "again"), str(tmp_path / "out")
    names = ("transactions", "cashflows", "balances", "collateral", "limits")
    day = date(2024, 1, 15)
    for name, df in zip(names, inputs):
        partition = INPUT_TABLES[name][1]
        write_parquet_partitioned(df, f"{raw}/{name}", [partition])
        one = df.filter(F.col(partition) == F.lit(day)) if name != "cashflows" else df.limit(0)
        if name == "transactions":
            one = one.withColumn("amount", F.col("amount") * 2)
        one.write.partitionBy(partition).parquet(f"{again}/{name}")

    run_monitoring(spark, raw, out, SETTINGS)
    assert spark.read.parquet(f"{out}/dq_results").count() == 11
    lazy = monitoring_frames(*inputs, settings=SETTINGS)
    before = {}
    for name, frame in lazy.items():
        before[name] = read_parquet(spark, f"{out}/{name}", frame.schema)
        assert same(before[name], frame), name

    def totals():
        df = read_parquet(spark, f"{out}/intraday_snapshots")
        sums = df.groupBy("value_date").agg(F.round(F.sum("inflow"), 2).alias("s")).collect()
        return {r.value_date: r.s for r in sums}

    first = totals()
    kept = {name: spark.createDataFrame(before[name].select(*frame.columns).collect(), frame.schema) for name, frame in lazy.items()}
    run_monitoring(spark, raw, out, SETTINGS, str(tmp_path / "staging"), dates=[day])
    for name, frame in lazy.items():
        assert same(read_parquet(spark, f"{out}/{name}", frame.schema), kept[name]), name
    run_monitoring(spark, again, out, SETTINGS, str(tmp_path / "staging"))
    second = totals()
    assert second.pop(day) == pytest.approx(2 * first.pop(day))
    assert second == first
