from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cashwatch.functions.amounts import maturity_bucket_expr
from cashwatch.functions.buckets import bucket_start
from cashwatch.operators.flows import (
    intraday_time_bucket,
    maturity_ladder,
    net_cashflow_by_bucket,
    with_bucket_end,
)
from tests.build import DAY, at, dicts, transactions


def test_net_cashflow_of_one_hour(spark):
    tx = transactions(spark, [(at(10, 5), "CP1", "IN", 100.0), (at(10, 55), "CP2", "OUT", 40.0)])
    got = dicts(net_cashflow_by_bucket(intraday_time_bucket(tx, "UTC", "hour")))
    assert got == [
        {
            "value_date": DAY,
            "currency": "THB",
            "bucket_start_ts": at(10),
            "net_cashflow": 60.0,
            "inflow": 100.0,
            "outflow": 40.0,
            "tx_count": 2,
        }
    ]


def test_unknown_directions_count_negative_in_the_net_only(spark):
    tx = transactions(
        spark,
        [
            (at(9), "CP1", "IN", 10.0),
            (at(9), "CP1", None, 3.0),
            (at(9), "CP1", "X", 4.0),
            (at(9), "CP1", "OUT", None),
        ],
    )
    (row,) = dicts(net_cashflow_by_bucket(intraday_time_bucket(tx)))
    assert (row["net_cashflow"], row["inflow"], row["outflow"], row["tx_count"]) == (3.0, 10.0, 0.0, 4)


def test_value_date_is_not_taken_from_the_event(spark):
    late = transactions(spark, [(at(23, 30), "CP1", "IN", 1.0, date(2026, 1, 26))])
    (row,) = dicts(net_cashflow_by_bucket(intraday_time_bucket(late)))
    assert (row["value_date"], row["bucket_start_ts"]) == (date(2026, 1, 26), at(23))


def test_one_shuffle_from_scan_to_net(spark, plan):
    tx = transactions(spark, [(at(10, 5), "CP1", "IN", 100.0)])
    text = plan(net_cashflow_by_bucket(intraday_time_bucket(tx)))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text


def test_granularities(spark):
    tx = transactions(spark, [(at(10, 29), "a", "IN", 1.0), (at(10, 30), "b", "IN", 1.0)])
    by = {
        g: [r["bucket_start_ts"] for r in dicts(intraday_time_bucket(tx, granularity=g), "event_ts")]
        for g in ("hour", "30min", "minute")
    }
    assert by == {
        "hour": [at(10), at(10)],
        "30min": [at(10), at(10, 30)],
        "minute": [at(10, 29), at(10, 30)],
    }
    with pytest.raises(ValueError):
        intraday_time_bucket(tx, granularity="day")
    ends = dicts(with_bucket_end(intraday_time_bucket(tx, granularity="30min"), "30min"), "event_ts")
    assert [r["bucket_end_ts"] for r in ends] == [at(10, 30), at(11)]


@pytest.mark.parametrize("granularity", ["hour", "30min"])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Bangkok", "Asia/Kolkata", "Asia/Kathmandu", "America/New_York"])
def test_an_explicit_zone_cuts_as_that_session_zone_does(spark, conf, zone, granularity):
    """Every quarter of an hour over both daylight-saving changes of the year."""
    steps = spark.range(0, 366 * 96).select(
        F.timestamp_seconds(F.col("id") * 900 + F.lit(1767225600)).alias("event_ts")
    )
    explicit = steps.select("event_ts", bucket_start(F.col("event_ts"), granularity, zone).alias("explicit"))
    conf("spark.sql.session.timeZone", zone)
    differ = explicit.filter(F.col("explicit") != bucket_start(F.col("event_ts"), granularity))
    assert differ.count() == 0


def test_repeated_hours_of_a_clock_change_stay_apart(spark):
    # New York sets the clock back at 06:00 UTC on 2026-11-01: 05:30 and 06:30 are both 01:30.
    rows = [(datetime(2026, 11, 1, 5, 30), "a", "IN", 1.0), (datetime(2026, 11, 1, 6, 30), "b", "IN", 1.0)]
    buckets = dicts(intraday_time_bucket(transactions(spark, rows), "America/New_York"), "event_ts")
    assert [b["bucket_start_ts"] for b in buckets] == [datetime(2026, 11, 1, 5), datetime(2026, 11, 1, 6)]


CASHFLOW = (
    "cf_id string, as_of_date date, maturity_date date, counterparty_id string, currency string, "
    "direction string, amount double, source string"
)


def test_maturity_bucket_edges(spark):
    edges = {
        -1: "past_due",
        0: "t0",
        1: "t1_7d",
        7: "t1_7d",
        8: "t8_30d",
        30: "t8_30d",
        31: "t31_90d",
        90: "t31_90d",
        91: "t90d_plus",
    }
    rows = [(n, DAY, DAY + timedelta(days=n)) for n in edges] + [(None, DAY, None)]
    df = spark.createDataFrame(rows, "n int, a date, m date").select("n", maturity_bucket_expr("m", "a").alias("b"))
    assert {r["n"]: r["b"] for r in df.collect()} == {**edges, None: "t90d_plus"}


def test_maturity_ladder(spark):
    rows = [
        ("c1", DAY, DAY, "CP1", "THB", "OUT", 10.0, "loan"),
        ("c2", DAY, DAY + timedelta(days=7), "CP1", "THB", "IN", 25.0, "bond"),
        ("c3", DAY, DAY + timedelta(days=15), "CP2", "THB", "OUT", 5.0, "fx_swap"),
    ]
    ladder = maturity_ladder(spark.createDataFrame(rows, CASHFLOW), ordered=True)
    got = [(r.maturity_bucket, r.net_cashflow, r.inflow, r.outflow, r.cf_count) for r in ladder.collect()]
    assert got == [("t0", -10.0, 0.0, 10.0, 1), ("t1_7d", 25.0, 25.0, 0.0, 1), ("t8_30d", -5.0, 0.0, 5.0, 1)]
