"""The five banking tables, derived row by row from the benchmark tables.

Each table is a projection of one source table (limits: one aggregate), so it grows with
it. Days run over the 30 days the events cover. About a third of the transactions belong
to one counterparty, CP000000, on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cashwatch.schemas import BALANCES, CASHFLOWS, COLLATERAL, LIMITS, TRANSACTIONS, conform

HOT_COUNTERPARTY = "CP000000"

# The columns read from each source table.
_SOURCES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _day(key: str) -> str:
    return f"date_add(DATE '2024-01-01', CAST({key} % 30 AS INT))"


def _currency(first: str) -> str:
    return f"if({first}, 'THB', 'USD')"


def _padded(prefix: str, number: str, width: int = 6) -> str:
    digits = f"CAST({number} AS STRING)"
    return f"concat('{prefix}', lpad({digits}, greatest(length({digits}), {width}), '0'))"


def _counterparty(number: str, hot: str) -> str:
    return f"if({hot}, '{HOT_COUNTERPARTY}', {_padded('CP', f'({number} + 1)')})"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events: purchases, views and sign-ups come in, clicks and errors go out."""
    frame = _table(spark, sf_dir, "events").selectExpr(
        "event_id AS tx_id",
        "ts AS event_ts",
        "CAST(ts AS DATE) AS value_date",
        f"{_padded('A', 'user_id')} AS account_id",
        f"{_counterparty('user_id', 'event_id % 3 = 0')} AS counterparty_id",
        f"{_currency('event_id % 2 = 0')} AS currency",
        "if(event_type IN ('click', 'error'), 'OUT', 'IN') AS direction",
        "value AS amount",
        "event_type AS product",
        "concat('CH', event_id % 5) AS channel",
    )
    return conform(frame, TRANSACTIONS)


def cashflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, as of the month they ship, maturing 10 days before to 110 days after."""
    as_of = "trunc(CAST(l_shipdate AS DATE), 'month')"
    days = "CAST((l_orderkey * 7 + l_linenumber) % 121 - 10 AS INT)"
    frame = _table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber) AS cf_id",
        f"{as_of} AS as_of_date",
        f"date_add({as_of}, {days}) AS maturity_date",
        f"{_padded('CP', 'l_suppkey')} AS counterparty_id",
        f"""{_currency("l_returnflag <> 'R'")} AS currency""",
        "if(l_linestatus = 'O', 'IN', 'OUT') AS direction",
        "l_extendedprice AS amount",
        "'loan' AS source",
    )
    return conform(frame, CASHFLOWS)


def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, one balance each."""
    frame = _table(spark, sf_dir, "customer").selectExpr(
        f"{_day('c_custkey')} AS as_of_date",
        f"{_padded('A', 'c_custkey')} AS account_id",
        f"{_currency('c_custkey div 30 % 2 = 0')} AS currency",
        "c_acctbal AS balance",
        "c_mktsegment AS customer_segment",
    )
    return conform(frame, BALANCES)


def collateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts; every fifth is not eligible, which leaves some days with none at all."""
    frame = _table(spark, sf_dir, "part").selectExpr(
        f"{_day('p_partkey')} AS as_of_date",
        f"{_padded('COL', 'p_partkey', 8)} AS collateral_id",
        f"{_padded('CP', '(p_partkey % 1000)')} AS counterparty_id",
        f"{_currency('p_partkey div 30 % 2 = 0')} AS currency",
        "p_retailprice AS market_value",
        "p_size % 21 / 100 AS haircut_pct",
        "if(p_partkey % 5 = 0, 0, 1) AS eligible_lcr",
    )
    return conform(frame, COLLATERAL)


def _keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        f"{_day('o_orderkey')} AS as_of_date",
        f"{_counterparty('o_custkey div 10', 'o_custkey % 10 = 0')} AS counterparty_id",
        "element_at(array('intraday', 'settlement', 'credit'), CAST(o_orderkey div 60 % 3 AS INT) + 1) AS limit_type",
        f"{_currency('o_orderkey div 30 % 2 = 0')} AS currency",
        "o_totalprice",
    )


def limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per day, counterparty, currency and limit type, scaled to the outflows.
    Many counterparties have no settlement limit on a day."""
    totals = _keyed_orders(spark, sf_dir).groupBy("as_of_date", "counterparty_id", "limit_type", "currency").sum("o_totalprice")
    return conform(totals.selectExpr("*", "`sum(o_totalprice)` * 0.0004D + 200 AS limit_amount"), LIMITS)


def order_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a limit, so that a key is listed once for each of its orders."""
    return conform(_keyed_orders(spark, sf_dir).selectExpr("*", "o_totalprice * 0.0004D + 200 AS limit_amount"), LIMITS)
