"""One query per operator, each over whole tables.

Money is rounded to cents, ratios to six places, and flags and dates are shown as text, so
that the rows compare equal across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial, reduce, wraps
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cashwatch.functions.amounts import maturity_bucket_expr, signed_amount
from cashwatch.functions.keys import hash_assign, key_assign, padded_key
from cashwatch.operators import counterparties, flows, grains, intraday, limits, liquidity, quality, spine
from cashwatch.plans.daily import with_anomaly_flags
from cashwatch.plans.monitoring import Settings, monitoring_frames, run_monitoring
from cashwatch.schemas import INPUT_TABLES, TRANSACTIONS
from cashwatch.sources import outputs, statistics, tables, testdata
from cashwatch.streaming import flows as stream_flows

Z = 3.0
TOP_N = 3
SHARE = 0.35
TOP_SHARE = 0.42
WARNING = 0.90
BREACH = 1.00
SETTINGS = Settings(z_threshold=Z, top_n=TOP_N, concentration_share=SHARE)

DAY = ["value_date", "currency"]
BUCKET = [*DAY, "bucket_start_ts"]


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the session's checkpoint folder, or else under its warehouse."""
    try:
        return tables.shared_folder(spark)
    except ValueError:
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/cashwatch-{uuid4().hex}"


def money(name: str) -> Column:
    return F.round(name, 2).alias(name)


def ratio(name: str) -> Column:
    return F.round(name, 6).alias(name)


def money_of(value: Column) -> Column:
    return F.round(value, 2)


def text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def moment(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def _bucketed(spark: SparkSession, d: str) -> DataFrame:
    return flows.intraday_time_bucket(testdata.transactions(spark, d))


def _net(spark: SparkSession, d: str) -> DataFrame:
    return flows.net_cashflow_by_bucket(_bucketed(spark, d))


def _snapshot(spark: SparkSession, d: str) -> DataFrame:
    return intraday.build_intraday_snapshot(_net(spark, d))


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return intraday.flag_liquidity_drop_anomaly(_snapshot(spark, d), Z)


def _top(spark: SparkSession, d: str) -> DataFrame:
    return counterparties.concentration_top_counterparties(testdata.transactions(spark, d), TOP_N)


def _utilization(spark: SparkSession, d: str) -> DataFrame:
    outflow = counterparties.counterparty_outflow(testdata.transactions(spark, d))
    return limits.limit_utilization(outflow, testdata.limits(spark, d), WARNING, BREACH)


def _inputs(spark: SparkSession, d: str) -> list[DataFrame]:
    """In the order of `monitoring_frames` and `dq_suite`."""
    sources = (
        testdata.transactions,
        testdata.cashflows,
        testdata.balances,
        testdata.collateral,
        testdata.limits,
    )
    return [source(spark, d) for source in sources]


# -- input tables -------------------------------------------------------------------------


def transactions_table(spark: SparkSession, d: str) -> DataFrame:
    return testdata.transactions(spark, d).withColumn("event_ts", moment("event_ts"))


def cashflows_table(spark: SparkSession, d: str) -> DataFrame:
    return testdata.cashflows(spark, d)


def balances_table(spark: SparkSession, d: str) -> DataFrame:
    return testdata.balances(spark, d)


def collateral_table(spark: SparkSession, d: str) -> DataFrame:
    return testdata.collateral(spark, d)


def limits_table(spark: SparkSession, d: str) -> DataFrame:
    return testdata.limits(spark, d).withColumn("limit_amount", ratio("limit_amount"))


# -- projections --------------------------------------------------------------------------


def signed_amounts(spark: SparkSession, d: str) -> DataFrame:
    return testdata.transactions(spark, d).select("tx_id", "direction", signed_amount().alias("signed_amount"))


def hour_bucket(spark: SparkSession, d: str) -> DataFrame:
    return _bucketed(spark, d).select("tx_id", moment("bucket_start_ts"))


def fine_buckets(spark: SparkSession, d: str) -> DataFrame:
    tx = testdata.transactions(spark, d)
    half = flows.intraday_time_bucket(tx, granularity="30min").withColumnRenamed("bucket_start_ts", "half_hour_ts")
    both = flows.intraday_time_bucket(half, granularity="minute")
    return both.select("tx_id", moment("half_hour_ts"), moment("bucket_start_ts"))


def zoned_bucket(spark: SparkSession, d: str) -> DataFrame:
    tx = testdata.transactions(spark, d)
    return flows.intraday_time_bucket(tx, "Asia/Kolkata").select("tx_id", moment("bucket_start_ts"))


def maturity_bucket(spark: SparkSession, d: str) -> DataFrame:
    label = maturity_bucket_expr("maturity_date", "as_of_date").alias("maturity_bucket")
    return testdata.cashflows(spark, d).select("cf_id", "as_of_date", "maturity_date", label)


# -- flows --------------------------------------------------------------------------------


def net_cashflow_by_bucket(spark: SparkSession, d: str) -> DataFrame:
    return _net(spark, d).select(
        *DAY, moment("bucket_start_ts"), money("net_cashflow"), money("inflow"), money("outflow"), "tx_count"
    )


def maturity_ladder(spark: SparkSession, d: str) -> DataFrame:
    return flows.maturity_ladder(testdata.cashflows(spark, d)).select(
        "as_of_date",
        "currency",
        "maturity_bucket",
        money("net_cashflow"),
        money("inflow"),
        money("outflow"),
        "cf_count",
    )


def maturity_ladder_sorted(spark: SparkSession, d: str) -> DataFrame:
    return flows.maturity_ladder(testdata.cashflows(spark, d), ordered=True).select(
        "as_of_date", "currency", "maturity_bucket", money("net_cashflow"), "cf_count"
    )


# -- intraday -----------------------------------------------------------------------------


def intraday_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return _snapshot(spark, d).select(
        *DAY,
        moment("bucket_start_ts"),
        money("net_cashflow"),
        money("cum_net_cashflow"),
        money("min_cum_net_cashflow"),
        money("max_cum_net_cashflow"),
    )


def delta_and_z(spark: SparkSession, d: str) -> DataFrame:
    return intraday.delta_and_z(_snapshot(spark, d)).select(
        *DAY, moment("bucket_start_ts"), money("delta_cum"), ratio("delta_z")
    )


def liquidity_drop_flags(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).select(*DAY, moment("bucket_start_ts"), text("flag_liquidity_drop"))


def daily_drop_rollup(spark: SparkSession, d: str) -> DataFrame:
    return intraday.daily_liquidity_drop_flag(_flagged(spark, d)).select(
        *DAY, text("flag_liquidity_drop_any"), ratio("min_delta_z")
    )


def daily_from_intraday(spark: SparkSession, d: str) -> DataFrame:
    return intraday.daily_snapshot_from_intraday(_snapshot(spark, d)).select(
        *DAY,
        money("eod_cum_net_cashflow"),
        money("worst_cum_net_cashflow"),
        money("best_cum_net_cashflow"),
    )


def intraday_running_balance(spark: SparkSession, d: str) -> DataFrame:
    opening = liquidity.balance_total(testdata.balances(spark, d))
    snapshot = flows.with_bucket_end(_snapshot(spark, d))
    return intraday.with_running_balance(snapshot, opening).select(
        *DAY, moment("bucket_start_ts"), moment("bucket_end_ts"), money("running_balance")
    )


# -- counterparties -----------------------------------------------------------------------


def counterparty_flows(spark: SparkSession, d: str) -> DataFrame:
    return counterparties.counterparty_flows(testdata.transactions(spark, d)).select(
        *DAY, "counterparty_id", money("cp_net_flow"), money("cp_gross_flow"), money("cp_outflow"), "cp_out_count"
    )


def day_gross_total(spark: SparkSession, d: str) -> DataFrame:
    return counterparties.day_gross_total(testdata.transactions(spark, d)).select(*DAY, money("total_gross_flow"))


def concentration_top(spark: SparkSession, d: str) -> DataFrame:
    return _top(spark, d).select(
        *DAY,
        "counterparty_id",
        money("cp_net_flow"),
        money("cp_gross_flow"),
        money("total_gross_flow"),
        ratio("cp_share"),
        "cp_rank",
        ratio("top1_share"),
        ratio("topN_share"),
        "topN",
    )


def concentration_flags(spark: SparkSession, d: str) -> DataFrame:
    return counterparties.flag_concentration_anomaly(_top(spark, d), SHARE).select(
        *DAY, ratio("top1_share"), ratio("topN_share"), "topN", text("flag_concentration")
    )


def concentration_flags_top_n(spark: SparkSession, d: str) -> DataFrame:
    flags = counterparties.flag_concentration_anomaly(_top(spark, d), TOP_SHARE, metric="topN_share")
    return flags.select(*DAY, ratio("topN_share"), text("flag_concentration"))


def counterparty_outflow(spark: SparkSession, d: str) -> DataFrame:
    return counterparties.counterparty_outflow(testdata.transactions(spark, d)).select(
        *DAY, "counterparty_id", money("cp_outflow")
    )


# -- limits -------------------------------------------------------------------------------


def _show_utilization(df: DataFrame) -> DataFrame:
    return df.select(
        *DAY,
        "counterparty_id",
        money("cp_outflow"),
        "limit_type",
        ratio("limit_amount"),
        ratio("utilization"),
        text("flag_limit_warning"),
        text("flag_limit_breach"),
    )


def limit_utilization(spark: SparkSession, d: str) -> DataFrame:
    return _show_utilization(_utilization(spark, d))


def limit_utilization_split(spark: SparkSession, d: str) -> DataFrame:
    """Every order as a limit of its own, so that many keys are listed more than once, and keys of
    more than two rows dealt to several pieces."""
    outflow = counterparties.counterparty_outflow(testdata.transactions(spark, d))
    listed = testdata.order_limits(spark, d)
    return limits.limit_utilization(outflow, listed, WARNING, BREACH, split_rows=2).groupBy(*DAY, "counterparty_id").agg(
        money_of(F.max("cp_outflow")).alias("cp_outflow"),
        F.count("limit_amount").alias("n_limits"),
        F.round(F.max("utilization"), 6).alias("max_utilization"),
        F.round(F.min("utilization"), 6).alias("min_utilization"),
    )


def daily_limit_flags(spark: SparkSession, d: str) -> DataFrame:
    return limits.daily_limit_flags(_utilization(spark, d)).select(
        *DAY, text("flag_limit_warning_any"), text("flag_limit_breach_any"), ratio("max_utilization")
    )


def bucketed_limit_utilization(spark: SparkSession, d: str) -> DataFrame:
    """`limit_utilization` from two bucketed tables, joined without a shuffle."""
    base = scratch_dir(spark)
    keys = ["value_date", "currency", "counterparty_id"]
    outflow = counterparties.counterparty_outflow(testdata.transactions(spark, d))
    settlement = limits.settlement_limits(testdata.limits(spark, d)).withColumnRenamed("value_date", "as_of_date")
    names = ("parity_outflow", "parity_limits")  # each run replaces them
    tables.write_bucketed(outflow, names[0], keys, 8, path=f"{base}/outflow")
    tables.write_bucketed(
        settlement, names[1], ["as_of_date", "currency", "counterparty_id"], 8, path=f"{base}/limits"
    )
    return _show_utilization(limits.limit_utilization(*map(spark.table, names), WARNING, BREACH))


# -- balances and collateral --------------------------------------------------------------


def balance_total(spark: SparkSession, d: str) -> DataFrame:
    return liquidity.balance_total(testdata.balances(spark, d)).select(*DAY, money("total_balance"))


def eligible_collateral(spark: SparkSession, d: str) -> DataFrame:
    return liquidity.eligible_collateral(testdata.collateral(spark, d)).select(
        *DAY, F.round("eligible_collateral_value", 3).alias("eligible_collateral_value")
    )


def liquidity_base(spark: SparkSession, d: str) -> DataFrame:
    base = liquidity.liquidity_base(testdata.balances(spark, d), testdata.collateral(spark, d))
    return liquidity.with_total_liquidity(base).select(
        *DAY,
        money("total_balance"),
        F.round("eligible_collateral_value", 3).alias("eligible_collateral_value"),
        F.round("total_liquidity", 3).alias("total_liquidity"),
    )


# -- daily snapshot -----------------------------------------------------------------------


def anomaly_flags(spark: SparkSession, d: str) -> DataFrame:
    frames = monitoring_frames(*_inputs(spark, d), settings=SETTINGS, staging_path=scratch_dir(spark))
    flags = with_anomaly_flags(frames["daily_snapshots"].drop("anomaly_flags"))
    return flags.select(*DAY, F.array_join("anomaly_flags", ",").alias("anomaly_flags"))


def _show_daily(df: DataFrame) -> DataFrame:
    return df.select(
        *DAY,
        money("eod_cum_net_cashflow"),
        money("worst_cum_net_cashflow"),
        money("best_cum_net_cashflow"),
        text("flag_liquidity_drop_any"),
        ratio("min_delta_z"),
        text("flag_limit_warning_any"),
        text("flag_limit_breach_any"),
        ratio("max_utilization"),
        money("total_balance"),
        F.round("eligible_collateral_value", 3).alias("eligible_collateral_value"),
        text("flag_concentration"),
        ratio("top1_share"),
        ratio("topN_share"),
        "topN",
        F.array_join("anomaly_flags", ",").alias("anomaly_flags"),
    )


def daily_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Staged, so that the transactions are scanned once; with a folder of its own choice."""
    frames = monitoring_frames(*_inputs(spark, d), settings=SETTINGS, staging_path=scratch_dir(spark))
    return _show_daily(frames["daily_snapshots"])


def daily_snapshot_lazy(spark: SparkSession, d: str) -> DataFrame:
    frames = monitoring_frames(*_inputs(spark, d), settings=SETTINGS, lazy=True)
    return _show_daily(frames["daily_snapshots"])


def daily_snapshot_staged(spark: SparkSession, d: str) -> DataFrame:
    frames = monitoring_frames(*_inputs(spark, d), settings=SETTINGS, staging_path=scratch_dir(spark))
    return _show_daily(frames["daily_snapshots"])


def transaction_grains(spark: SparkSession, d: str) -> DataFrame:
    return grains.transaction_grains(_bucketed(spark, d)).select(
        "grain",
        *DAY,
        moment("bucket_start_ts"),
        "counterparty_id",
        money("net_cashflow"),
        money("inflow"),
        money("outflow"),
        "tx_count",
        money("cp_gross_flow"),
        "cp_out_count",
    )


# -- data quality -------------------------------------------------------------------------


def dq_nulls(spark: SparkSession, d: str) -> DataFrame:
    """NULLs put into two columns of the transactions, and none in the third."""
    tx = testdata.transactions(spark, d).withColumns(
        {
            "counterparty_id": F.nullif(F.col("counterparty_id"), F.lit(testdata.HOT_COUNTERPARTY)),
            "channel": F.nullif(F.col("channel"), F.lit("CH4")),
        }
    )
    bad = quality.check_no_nulls(tx, ["tx_id", "counterparty_id", "channel"], "tx_some_nulls")
    return bad.unionByName(quality.check_no_nulls(tx, ["tx_id", "amount"], "tx_no_nulls")).withColumn(
        "passed", text("passed")
    )


def dq_duplicates(spark: SparkSession, d: str) -> DataFrame:
    cf, col = testdata.cashflows(spark, d), testdata.collateral(spark, d)
    checks = quality.check_no_duplicates(cf, ["cf_id"], "cf_pk_unique").unionByName(
        quality.check_no_duplicates(col, ["collateral_id"], "col_pk_unique")
    )
    return checks.withColumn("passed", text("passed"))


def dq_rowcount(spark: SparkSession, d: str) -> DataFrame:
    tx = testdata.transactions(spark, d)
    checks = quality.check_rowcount_between(tx, 1, 10_000_000, "tx_volume_sanity").unionByName(
        quality.check_rowcount_between(tx, 1, 10, "tx_volume_tiny")
    )
    return checks.withColumn("passed", text("passed"))


def dq_rowcount_footers(spark: SparkSession, d: str) -> DataFrame:
    """The same checks on events, whose counts come from the files' footers."""
    path = f"{d}/events.parquet"
    counts = statistics.table_counts(spark, path, ["event_id", "value"])
    events = spark.read.parquet(path)
    checks = quality.check_rowcount_between(events, 1, 10, "events_volume_tiny", counts).unionByName(
        quality.check_nulls_and_rowcount(
            events, ["event_id", "value"], "events_no_nulls", 1, 10_000_000, "events_volume_sanity", counts
        )
    )
    return checks.withColumn("passed", text("passed"))


def dq_files(spark: SparkSession, d: str) -> DataFrame:
    """Transactions of odd ids in a file that lacks their amounts: the file is reported."""
    path = f"{scratch_dir(spark)}/files"
    tx = testdata.transactions(spark, d)
    odd = F.substring("tx_id", -1, 1).isin("1", "3", "5", "7", "9")
    tx.filter(~odd).coalesce(1).write.parquet(path)
    tx.filter(odd).drop("amount").coalesce(1).write.mode("append").parquet(path)
    read = tables.read_parquet(spark, path, TRANSACTIONS)
    checks = quality.check_files_complete(read, ["tx_id", "amount"], "tx_files_complete").unionByName(
        quality.check_files_complete(read, ["tx_id"], "tx_files_named")
    )
    return checks.withColumn("passed", text("passed"))


def dq_suite(spark: SparkSession, d: str) -> DataFrame:
    return quality.dq_suite(*_inputs(spark, d)).withColumn("passed", text("passed"))


# -- spine and keys -----------------------------------------------------------------------


def calendar_spine(spark: SparkSession, d: str) -> DataFrame:
    """Every account on every observed day in both currencies, with its balance where it has one."""
    bal = testdata.balances(spark, d).withColumnRenamed("as_of_date", "value_date")
    accounts = spine.with_each(bal.select("account_id").distinct(), "currency", ["THB", "USD"])
    grid = spine.observed_spine(accounts, bal)
    filled = spine.fill_gaps(grid, bal, ["value_date", "account_id", "currency"])
    return filled.select("value_date", "account_id", "currency", "balance")


def balance_carried(spark: SparkSession, d: str) -> DataFrame:
    """`calendar_spine` with every gap after a balance filled by that balance."""
    filled = calendar_spine(spark, d)
    carried = spine.carry_forward(filled, ["account_id", "currency"], ["balance"], range_days=7)
    return carried.select("value_date", "account_id", "currency", money("balance"))


def padded_keys(spark: SparkSession, d: str) -> DataFrame:
    """A width of 3 is too short for many of the ids, which must stay whole."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.select("o_orderkey", padded_key("K", F.col("o_orderkey"), 3).alias("padded_key"))


def hash_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Groups of integer keys, and whether the hashed group is in range and stays the same
    when the rows lie in other partitions."""
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey")
    groups = orders.withColumn("assigned", hash_assign([F.col("o_orderkey")], 7, "group"))
    moved = orders.repartition(13).select(
        F.col("o_orderkey").alias("moved_key"), hash_assign([F.col("o_orderkey")], 7, "group").alias("moved_group")
    )
    return groups.join(moved, F.col("o_orderkey") == F.col("moved_key")).select(
        "o_orderkey",
        key_assign(F.col("o_orderkey"), 7).alias("key_group"),
        F.col("assigned").between(0, 6).cast("string").alias("in_range"),
        (F.col("assigned") == F.col("moved_group")).cast("string").alias("stays"),
    )


# -- sinks --------------------------------------------------------------------------------


def partitioned_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write all days of the bucket flows, write one day again with doubled inflow, read back."""
    path = f"{scratch_dir(spark)}/net"
    net = _net(spark, d)
    tables.write_parquet_partitioned(net, path, DAY, small_groups=True)
    again = net.filter(F.col("value_date") == F.lit(date(2024, 1, 15))).withColumn("inflow", F.col("inflow") * 2)
    tables.write_parquet_partitioned(again, path, DAY, small_groups=True)
    return tables.read_parquet(spark, path, net.schema).select(
        *DAY, moment("bucket_start_ts"), money("inflow"), money("outflow"), "tx_count"
    )


def _written_inputs(spark: SparkSession, d: str, base: str) -> str:
    raw = f"{base}/raw"
    named = dict(zip(("transactions", "cashflows", "balances", "collateral", "limits"), _inputs(spark, d)))
    tables.run_together(
        spark,
        *[
            partial(tables.write_parquet_partitioned, named[name], f"{raw}/{name}", [partition])
            for name, (_, partition) in INPUT_TABLES.items()
        ]
    )
    return raw


def _written_daily(spark: SparkSession, out: str) -> DataFrame:
    daily = tables.read_parquet(spark, f"{out}/daily_snapshots")
    return _show_daily(daily.withColumn("value_date", F.col("value_date").cast("date")))


def monitoring_written(spark: SparkSession, d: str) -> DataFrame:
    """The daily snapshots as the whole job writes them."""
    base = scratch_dir(spark)
    run_monitoring(spark, _written_inputs(spark, d, base), f"{base}/out", SETTINGS, base)
    return _written_daily(spark, f"{base}/out")


def monitoring_rerun(spark: SparkSession, d: str) -> DataFrame:
    """The same after one day was run again over the full history: nothing may change."""
    base = scratch_dir(spark)
    raw = _written_inputs(spark, d, base)
    run_monitoring(spark, raw, f"{base}/out", SETTINGS, base)
    run_monitoring(spark, raw, f"{base}/out", SETTINGS, base, dates=[date(2024, 1, 15)])
    return _written_daily(spark, f"{base}/out")


def monitoring_versioned(spark: SparkSession, d: str) -> DataFrame:
    """The daily snapshots as readers see them after a versioned run and one day run again."""
    base = scratch_dir(spark)
    raw = _written_inputs(spark, d, base)
    run_monitoring(spark, raw, f"{base}/out", SETTINGS, base, versioned=True)
    run_monitoring(spark, raw, f"{base}/out", SETTINGS, base, dates=[date(2024, 1, 15)], versioned=True)
    daily = outputs.read_output(spark, f"{base}/out", "daily_snapshots")
    return _show_daily(daily.withColumn("value_date", F.col("value_date").cast("date")))


def net_cashflow_stream(spark: SparkSession, d: str) -> DataFrame:
    """Transaction files as a stream: every hour that ends two hours before the newest event."""
    base = scratch_dir(spark)
    testdata.transactions(spark, d).write.parquet(f"{base}/tx")
    emitted = stream_flows.net_cashflow_stream(stream_flows.transaction_stream(spark, f"{base}/tx", TRANSACTIONS))
    stream_flows.write_stream(emitted, f"{base}/net", f"{base}/checkpoint").awaitTermination()
    return tables.read_parquet(spark, f"{base}/net", emitted.schema).select(
        *DAY, moment("bucket_start_ts"), money("net_cashflow"), money("inflow"), money("outflow"), "tx_count"
    )


def monitoring_run(spark: SparkSession, d: str) -> DataFrame:
    """Write the five input tables, run the whole job on them, count and sum what it wrote."""
    base = scratch_dir(spark)
    raw, out = _written_inputs(spark, d, base), f"{base}/out"
    run_monitoring(spark, raw, out, SETTINGS, base)
    measures = {
        "dq_results": F.col("passed").cast("double"),
        "intraday_snapshots": F.col("cum_net_cashflow"),
        "daily_snapshots": F.col("eod_cum_net_cashflow"),
        "concentration_top_counterparties": F.col("cp_gross_flow"),
        "maturity_ladder": F.col("net_cashflow"),
        "limit_utilization": F.col("cp_outflow"),
    }
    written = [
        tables.read_parquet(spark, f"{out}/{name}").agg(
            F.lit(name).alias("output"),
            F.count("*").alias("row_count"),
            F.round(F.sum(measure), 2).alias("measure_sum"),
        )
        for name, measure in measures.items()
    ]
    return reduce(DataFrame.unionByName, written)


Query = Callable[[SparkSession, str], DataFrame]


def _dates_as_text(query: Query) -> Query:
    @wraps(query)
    def shown(spark: SparkSession, d: str) -> DataFrame:
        df = query(spark, d)
        dates = [f.name for f in df.schema if f.dataType.typeName() == "date"]
        return df.withColumns({name: text(name) for name in dates}) if dates else df

    return shown


QUERIES: dict[str, Query] = {
    f.__name__: _dates_as_text(f)
    for f in (
        transactions_table,
        cashflows_table,
        balances_table,
        collateral_table,
        limits_table,
        signed_amounts,
        hour_bucket,
        fine_buckets,
        zoned_bucket,
        maturity_bucket,
        net_cashflow_by_bucket,
        maturity_ladder,
        maturity_ladder_sorted,
        intraday_snapshot,
        delta_and_z,
        liquidity_drop_flags,
        daily_drop_rollup,
        daily_from_intraday,
        intraday_running_balance,
        counterparty_flows,
        day_gross_total,
        concentration_top,
        concentration_flags,
        concentration_flags_top_n,
        counterparty_outflow,
        limit_utilization,
        limit_utilization_split,
        daily_limit_flags,
        bucketed_limit_utilization,
        balance_total,
        eligible_collateral,
        liquidity_base,
        anomaly_flags,
        daily_snapshot,
        daily_snapshot_staged,
        daily_snapshot_lazy,
        monitoring_rerun,
        monitoring_versioned,
        net_cashflow_stream,
        monitoring_written,
        transaction_grains,
        dq_nulls,
        dq_duplicates,
        dq_rowcount,
        dq_rowcount_footers,
        dq_files,
        dq_suite,
        calendar_spine,
        balance_carried,
        padded_keys,
        hash_assignment,
        partitioned_roundtrip,
        monitoring_run,
    )
}
