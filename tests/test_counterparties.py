from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cashwatch.operators import counterparties
from cashwatch.operators.counterparties import (
    concentration_top_counterparties,
    counterparty_flows,
    counterparty_outflow,
    flag_concentration_anomaly,
    day_gross_total,
    outflow_of_flows,
    top_of_flows,
)
from tests.build import DAY, NEXT_DAY, at, dicts, transactions



def brute_force(rows, top_n):
    """Shares and ranks straight from the definition. Amounts are whole, so sums are exact."""
    gross, net = defaultdict(float), defaultdict(float)
    for _, cp, direction, amount, day, cur in rows:
        gross[day, cur, cp] += abs(amount)
        net[day, cur, cp] += amount if direction == "IN" else -amount
    groups = defaultdict(list)
    for (day, cur, cp), value in gross.items():
        groups[day, cur].append((cp, value))
    out = {}
    for (day, cur), members in groups.items():
        total = sum(v for _, v in members)
        shares = sorted(((v / total if total > 0 else 0.0, cp) for cp, v in members), key=lambda s: (-s[0], s[1]))
        for rank, (share, cp) in enumerate(shares[:top_n], 1):
            out[day, cur, cp] = (
                net[day, cur, cp],
                gross[day, cur, cp],
                total,
                share,
                rank,
                shares[0][0],
                pytest.approx(sum(s for s, _ in shares[:top_n])),
                top_n,
            )
    return out


def result(df):
    return {
        (r.value_date, r.currency, r.counterparty_id): (
            r.cp_net_flow,
            r.cp_gross_flow,
            r.total_gross_flow,
            r.cp_share,
            r.cp_rank,
            r.top1_share,
            r.topN_share,
            r.topN,
        )
        for r in df.collect()
    }


def random_rows(n=3000, counterparties=90, seed=3):
    """Many ties, and one counterparty and one currency with an outsized part of the rows."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        cp = "CP_HOT" if rng.random() < 0.34 else f"CP{rng.randrange(counterparties):04d}"
        cur = "THB" if rng.random() < 0.7 else "USD"
        rows.append((at(9), cp, rng.choice(["IN", "OUT"]), float(rng.randrange(1, 4)), rng.choice([DAY, NEXT_DAY]), cur))
    return rows


def test_two_counterparties_top_one(spark):
    tx = transactions(spark, [(at(10, 5), "CP1", "IN", 100.0), (at(10, 6), "CP2", "IN", 50.0)])
    (got,) = dicts(concentration_top_counterparties(tx, 1))
    assert got["counterparty_id"] == "CP1" and got["topN"] == 1 and got["cp_rank"] == 1
    assert got["cp_share"] == got["top1_share"] == got["topN_share"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("top_n", [1, 5, 40, 500])
def test_top_matches_brute_force(spark, top_n):
    rows = random_rows()
    tx = transactions(spark, rows).repartition(7)
    assert result(concentration_top_counterparties(tx, top_n)) == brute_force(rows, top_n)


@pytest.mark.parametrize("salts", [1, 2, 7])
def test_salts_change_no_row(spark, salts):
    rows = random_rows(seed=11)
    tx = transactions(spark, rows)
    assert result(concentration_top_counterparties(tx, 20, salts=salts)) == brute_force(rows, 20)


def test_near_ties_are_cut_as_they_are_ranked(spark):
    """CP1 and CP2 round to one share, so the smaller id leads whatever the list's length."""
    amounts = {"CP1": 1.9712075281962813, "CP2": 1.9712075281962815, "CP3": 0.40588265025613957}
    tx = transactions(spark, [(at(10), cp, "IN", amount) for cp, amount in amounts.items()])
    for salts in (1, 3):
        one = dicts(concentration_top_counterparties(tx, 1, salts=salts))
        two = dicts(concentration_top_counterparties(tx, 2, salts=salts), "cp_rank")
        assert [r["counterparty_id"] for r in one] == ["CP1"]
        assert [r["counterparty_id"] for r in two] == ["CP1", "CP2"]
    staged = top_of_flows(counterparty_flows(tx), day_gross_total(tx), 1)
    assert [r["counterparty_id"] for r in dicts(staged)] == ["CP1"]


def test_no_result_for_top_zero(spark):
    tx = transactions(spark, [(at(10), "CP1", "IN", 1.0)])
    assert concentration_top_counterparties(tx, 0).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    tx = transactions(spark, [(at(10), cp, "IN", 5.0) for cp in ("CP3", "CP1", "CP2")])
    got = dicts(concentration_top_counterparties(tx, 2), "cp_rank")
    assert [r["counterparty_id"] for r in got] == ["CP1", "CP2"]
    assert got[0]["topN_share"] == pytest.approx(2 / 3)


def test_decimal_amounts_tie_exactly(spark):
    """0.1 + 0.2 is not 0.3 in doubles; with decimals the two counterparties tie."""
    rows = [(at(10), "CP1", "IN", 0.3), (at(10), "CP2", "IN", 0.1), (at(10), "CP2", "OUT", 0.2)]
    tx = transactions(spark, rows).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = dicts(concentration_top_counterparties(tx, 2), "cp_rank")
    assert [(r["counterparty_id"], r["cp_share"]) for r in got] == [("CP1", 0.5), ("CP2", 0.5)]
    assert str(got[0]["total_gross_flow"]) == "0.60"


def test_a_zero_total_ranks_by_id_even_with_null_amounts(spark):
    tx = transactions(spark, [(at(10), "CP1", "IN", None), (at(10), "CP2", "IN", 0.0), (at(10), "CP3", "IN", 0.0)])
    got = dicts(concentration_top_counterparties(tx, 2), "cp_rank")
    assert [(r["counterparty_id"], r["cp_share"]) for r in got] == [("CP1", 0.0), ("CP2", 0.0)]


def test_null_amounts_rank_last_under_a_positive_total(spark):
    tx = transactions(spark, [(at(10), "CP1", "IN", None), (at(10), "CP2", "IN", 0.0), (at(10), "CP3", "IN", 9.0)])
    got = dicts(concentration_top_counterparties(tx, 3), "cp_rank")
    assert [(r["counterparty_id"], r["cp_share"]) for r in got] == [("CP3", 1.0), ("CP2", 0.0), ("CP1", None)]


def test_a_null_counterparty_is_not_the_total(spark):
    tx = transactions(spark, [(at(10), None, "IN", 30.0), (at(10), "CP1", "IN", 10.0)])
    got = dicts(concentration_top_counterparties(tx, 5), "cp_rank")
    assert [(r["counterparty_id"], r["cp_share"]) for r in got] == [(None, 0.75), ("CP1", 0.25)]


def test_null_keys_get_share_zero_and_no_summary(spark):
    rows = [(at(10), "CP2", "IN", 30.0, None), (at(10), "CP1", "IN", 10.0, None)]
    got = dicts(concentration_top_counterparties(transactions(spark, rows), 1))
    assert [(r["counterparty_id"], r["cp_share"], r["cp_rank"]) for r in got] == [("CP1", 0.0, 1)]
    assert {got[0][k] for k in ("total_gross_flow", "top1_share", "topN_share", "topN")} == {None}


def test_rows_are_limited_before_they_are_shuffled_by_day(spark, plan):
    lines = plan(concentration_top_counterparties(transactions(spark, random_rows(200)), 3)).splitlines()
    ranking = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    assert any("Exchange" in line for line in lines[ranking - 3 : ranking])


def test_concentration_flag(spark):
    tx = transactions(spark, [(at(10), "CP1", "IN", 60.0), (at(10), "CP2", "IN", 40.0)])
    top = concentration_top_counterparties(tx, 2)
    (flag,) = dicts(flag_concentration_anomaly(top, 0.6))
    assert flag == {
        "value_date": DAY,
        "currency": "THB",
        "top1_share": 0.6,
        "topN_share": 1.0,
        "topN": 2,
        "flag_concentration": True,
    }
    assert dicts(flag_concentration_anomaly(top, 0.61))[0]["flag_concentration"] is False
    assert dicts(flag_concentration_anomaly(top, 0.61, metric="topN_share"))[0]["flag_concentration"] is True
    with pytest.raises(ValueError):
        flag_concentration_anomaly(top, 0.5, metric="cp_share")


def test_outflow_from_flows_equals_the_direct_one(spark):
    rows = [(at(9), "CP1", "IN", 5.0), (at(9), "CP2", "OUT", 7.0), (at(9), "CP3", "OUT", None), (at(9), "CP4", None, 2.0)]
    tx = transactions(spark, rows)
    direct = counterparty_outflow(tx).orderBy("counterparty_id").collect()
    fused = outflow_of_flows(counterparty_flows(tx)).orderBy("counterparty_id").collect()
    assert direct == fused
    assert [(r.counterparty_id, r.cp_outflow) for r in direct] == [("CP2", 7.0), ("CP3", None)]


def test_flows_keep_groups_without_outflow(spark):
    (row,) = dicts(counterparty_flows(transactions(spark, [(at(9), "CP1", "IN", 5.0), (at(9), "CP1", "X", 2.0)])))
    assert (row["cp_net_flow"], row["cp_gross_flow"], row["cp_outflow"], row["cp_out_count"]) == (3.0, 7.0, None, 0)


def test_shares_of_a_day_sum_to_one(spark):
    top = concentration_top_counterparties(transactions(spark, random_rows()), 500)
    sums = top.groupBy("value_date", "currency").agg(F.sum("cp_share").alias("s")).collect()
    assert [r.s for r in sums] == pytest.approx([1.0] * len(sums))


def test_flows_and_totals_come_from_one_scan(spark, tmp_path, plan):
    transactions(spark, random_rows(300)).write.parquet(str(tmp_path / "tx"))
    top = concentration_top_counterparties(spark.read.parquet(str(tmp_path / "tx")), 3)
    top.collect()
    final = plan(top).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_too_many_totals_for_a_broadcast_ask_for_salts(spark, monkeypatch):
    monkeypatch.setattr(counterparties, "MOST_TOTALS", 1)
    rows = [(at(9), "CP1", "IN", 5.0, DAY, c) for c in ("THB", "USD", "EUR")]
    with pytest.raises(Exception, match="pass salts"):
        concentration_top_counterparties(transactions(spark, rows), 3).collect()
    salted = concentration_top_counterparties(transactions(spark, rows), 3, salts=2)
    assert [r.cp_share for r in salted.collect()] == [1.0, 1.0, 1.0]
