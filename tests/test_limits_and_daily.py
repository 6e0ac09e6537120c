from __future__ import annotations

import pytest

from cashwatch.operators.limits import daily_limit_flags, limit_utilization, settlement_limits
from cashwatch.operators.liquidity import (
    balance_total,
    eligible_collateral,
    liquidity_base,
    with_total_liquidity,
)
from cashwatch.plans.daily import daily_snapshot, with_anomaly_flags
from tests.build import DAY, NEXT_DAY, at, dicts

OUTFLOW = "value_date date, currency string, counterparty_id string, cp_outflow double"
LIMIT = "as_of_date date, counterparty_id string, limit_type string, limit_amount double, currency string"
UTILIZED = "value_date date, currency string, flag_limit_warning boolean, flag_limit_breach boolean, utilization double"
BALANCE = "as_of_date date, account_id string, currency string, balance double, customer_segment string"
COLLATERAL = (
    "as_of_date date, collateral_id string, counterparty_id string, currency string, "
    "market_value double, haircut_pct double, eligible_lcr int"
)


def outflows(spark, *amounts):
    return spark.createDataFrame([(DAY, "THB", f"CP{i}", a) for i, a in enumerate(amounts, 1)], OUTFLOW)


def limits(spark, *rows):
    return spark.createDataFrame([(DAY, cp, kind, amount, "THB") for cp, kind, amount in rows], LIMIT)


def test_utilization_and_its_thresholds(spark):
    lim = limits(spark, *[(f"CP{i}", "settlement", 100.0) for i in range(1, 5)])
    got = dicts(limit_utilization(outflows(spark, 89.0, 90.0, 99.0, 100.0), lim), "counterparty_id")
    assert [r["utilization"] for r in got] == [0.89, 0.9, 0.99, 1.0]
    assert [r["flag_limit_warning"] for r in got] == [False, True, True, True]
    assert [r["flag_limit_breach"] for r in got] == [False, False, False, True]


def test_no_limit_zero_limit_and_negative_limit_give_null(spark):
    lim = limits(spark, ("CP2", "settlement", 0.0), ("CP3", "settlement", -1.0), ("CP1", "credit", 50.0))
    got = dicts(limit_utilization(outflows(spark, 10.0, 10.0, 10.0), lim), "counterparty_id")
    assert [r["limit_amount"] for r in got] == [None, 0.0, -1.0]
    assert {r[k] for r in got for k in ("utilization", "flag_limit_warning", "flag_limit_breach")} == {None}


def test_a_limit_listed_twice_gives_two_rows(spark):
    lim = limits(spark, ("CP1", "settlement", 10.0), ("CP1", "settlement", 20.0))
    got = dicts(limit_utilization(outflows(spark, 10.0), lim), "limit_amount")
    assert [r["utilization"] for r in got] == [1.0, 0.5]


def test_settlement_limits_are_keyed_by_value_date(spark):
    lim = limits(spark, ("CP1", "settlement", 10.0), ("CP1", "intraday", 20.0))
    (row,) = dicts(settlement_limits(lim))
    assert row["value_date"] == DAY and row["limit_type"] == "settlement" and "as_of_date" not in row


def test_daily_limit_flags(spark):
    rows = [
        (DAY, "THB", True, False, 0.95),
        (DAY, "THB", None, None, None),
        (DAY, "THB", False, False, 0.1),
        (DAY, "USD", None, None, None),
    ]
    got = {r["currency"]: r for r in dicts(daily_limit_flags(spark.createDataFrame(rows, UTILIZED)))}
    thb, usd = got["THB"], got["USD"]
    assert (thb["flag_limit_warning_any"], thb["flag_limit_breach_any"], thb["max_utilization"]) == (True, False, 0.95)
    assert (usd["flag_limit_warning_any"], usd["flag_limit_breach_any"], usd["max_utilization"]) == (None, None, None)


def balances(spark):
    rows = [(DAY, "A1", "THB", 10.0, "x"), (DAY, "A2", "THB", -4.0, "x"), (NEXT_DAY, "A1", "THB", 1.0, "x")]
    return spark.createDataFrame(rows, BALANCE)


def collateral(spark):
    rows = [
        (DAY, "C1", "CP1", "THB", 100.0, 0.25, 1),
        (DAY, "C2", "CP1", "THB", 10.0, 0.0, 1),
        (DAY, "C3", "CP1", "THB", 999.0, 0.0, 0),
        (NEXT_DAY, "C4", "CP1", "THB", 999.0, 0.0, 0),
    ]
    return spark.createDataFrame(rows, COLLATERAL)


def test_balances_and_collateral(spark):
    assert [r["total_balance"] for r in dicts(balance_total(balances(spark)), "value_date")] == [6.0, 1.0]
    assert [r["eligible_collateral_value"] for r in dicts(eligible_collateral(collateral(spark)))] == [85.0]


def test_a_day_without_eligible_collateral_is_null_and_counts_as_zero_in_the_total(spark):
    base = with_total_liquidity(liquidity_base(balances(spark), collateral(spark)))
    got = [(r["eligible_collateral_value"], r["total_liquidity"]) for r in dicts(base, "value_date")]
    assert got == [(85.0, 91.0), (None, 1.0)]


FLAGS = "n int, flag_concentration boolean, flag_liquidity_drop_any boolean, flag_limit_breach_any boolean"


def test_anomaly_list_order_and_emptiness(spark):
    rows = [(0, True, True, True), (1, None, True, False), (2, False, None, None), (3, None, None, True)]
    got = with_anomaly_flags(spark.createDataFrame(rows, FLAGS)).orderBy("n").collect()
    assert [r.anomaly_flags for r in got] == [
        ["CONCENTRATION", "LIQUIDITY_DROP", "LIMIT_BREACH"],
        ["LIQUIDITY_DROP"],
        [],
        ["LIMIT_BREACH"],
    ]


def test_daily_snapshot_keeps_days_with_transactions_only(spark):
    intraday = spark.createDataFrame(
        [(DAY, "THB", at(9), 4.0, False, -0.5), (DAY, "THB", at(10), 1.0, True, -3.5)],
        "value_date date, currency string, bucket_start_ts timestamp, cum_net_cashflow double, "
        "flag_liquidity_drop boolean, delta_z double",
    )
    no_limits = spark.createDataFrame(
        [],
        "value_date date, currency string, flag_limit_warning_any boolean, flag_limit_breach_any boolean, "
        "max_utilization double",
    )
    shares = spark.createDataFrame(
        [(DAY, "THB", 0.5, 0.7, 3, True)],
        "value_date date, currency string, top1_share double, topN_share double, topN int, flag_concentration boolean",
    )
    daily = daily_snapshot(intraday, no_limits, liquidity_base(balances(spark), collateral(spark)), shares)
    assert daily.columns == [
        "value_date",
        "currency",
        "eod_cum_net_cashflow",
        "worst_cum_net_cashflow",
        "best_cum_net_cashflow",
        "flag_liquidity_drop_any",
        "min_delta_z",
        "flag_limit_warning_any",
        "flag_limit_breach_any",
        "max_utilization",
        "total_balance",
        "eligible_collateral_value",
        "flag_concentration",
        "top1_share",
        "topN_share",
        "topN",
        "anomaly_flags",
    ]
    (row,) = daily.collect()
    assert (row.value_date, row.eod_cum_net_cashflow, row.worst_cum_net_cashflow) == (DAY, 1.0, 1.0)
    assert row.total_balance == 6.0 and row.eligible_collateral_value == pytest.approx(85.0)
    assert row.flag_limit_breach_any is None
    assert row.anomaly_flags == ["CONCENTRATION", "LIQUIDITY_DROP"]
