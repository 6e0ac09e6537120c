"""Bucketed transaction flows and the maturity ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cashwatch.functions.amounts import (
    INFLOW,
    OUTFLOW,
    amount_if,
    maturity_bucket_expr,
    signed_amount,
)
from cashwatch.functions.buckets import GRANULARITIES, bucket_start


def intraday_time_bucket(df_tx: DataFrame, timezone: str | None = None, granularity: str = "hour") -> DataFrame:
    """Add `bucket_start_ts`: hour, 30min or minute, in `timezone` or else the session zone."""
    return df_tx.withColumn("bucket_start_ts", bucket_start(F.col("event_ts"), granularity, timezone))


def with_bucket_end(df: DataFrame, granularity: str = "hour") -> DataFrame:
    """Add `bucket_end_ts`, the exclusive end of the bucket."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {sorted(GRANULARITIES)}, not {granularity!r}")
    length = F.expr(f"INTERVAL {GRANULARITIES[granularity]} SECONDS")
    return df.withColumn("bucket_end_ts", F.col("bucket_start_ts") + length)


def flow_totals(count_name: str) -> list[Column]:
    """Net, in, out and count. Unknown directions count in the net (negative) only."""
    return [
        F.sum(signed_amount()).alias("net_cashflow"),
        F.sum(amount_if(INFLOW)).alias("inflow"),
        F.sum(amount_if(OUTFLOW)).alias("outflow"),
        F.count("*").alias(count_name),
    ]


def net_cashflow_by_bucket(df_tx: DataFrame) -> DataFrame:
    """Flows per value date, currency and bucket; partial sums before the one shuffle."""
    return df_tx.groupBy("value_date", "currency", "bucket_start_ts").agg(*flow_totals("tx_count"))


def maturity_ladder(df_cashflows: DataFrame, ordered: bool = False) -> DataFrame:
    """Flows per as-of date, currency and maturity bucket.

    `ordered` sorts for display (labels sort as text). Leave it off before a write: the
    range shuffle is lost in a partitioned table.
    """
    keys = ["as_of_date", "currency", "maturity_bucket"]
    ladder = (
        df_cashflows.withColumn("maturity_bucket", maturity_bucket_expr("maturity_date", "as_of_date"))
        .groupBy(*keys)
        .agg(*flow_totals("cf_count"))
    )
    return ladder.orderBy(*keys) if ordered else ladder
