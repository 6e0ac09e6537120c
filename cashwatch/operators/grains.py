"""All transaction aggregates in one pass.

The monitoring outputs need transactions summed by bucket, by counterparty and by day.
Grouping sets give the first two from one scan and one shuffle of partial sums, and the
days follow from the buckets. The frame is meant to be staged once (see
`cashwatch.sources.tables.stage`) and read per grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cashwatch.functions.amounts import OUTFLOW, signed_amount
from cashwatch.operators.flows import flow_totals

BUCKET = "bucket"
COUNTERPARTY = "counterparty"

_DAY_KEYS = ["value_date", "currency"]


def counterparty_totals() -> list[Column]:
    """Net, gross and outgoing flow, with the number of outgoing transactions."""
    outgoing = F.col("direction") == OUTFLOW
    return [
        F.sum(signed_amount()).alias("cp_net_flow"),
        F.sum(F.abs(signed_amount())).alias("cp_gross_flow"),
        F.sum(F.when(outgoing, F.col("amount"))).alias("cp_outflow"),
        F.count_if(outgoing).alias("cp_out_count"),
    ]


def day_gross() -> Column:
    """Gross flow of a group of transactions."""
    return F.sum(F.abs(signed_amount()))


def transaction_grains(df_tx_bucketed: DataFrame) -> DataFrame:
    """Bucket sums and counterparty sums of bucketed transactions, told apart by `grain`."""
    bucket, counterparty = F.col("bucket_start_ts"), F.col("counterparty_id")
    keys = [F.col(k) for k in _DAY_KEYS]
    grain = F.when(F.grouping("counterparty_id") == 1, BUCKET).otherwise(COUNTERPARTY)
    return df_tx_bucketed.groupingSets(
        [[*keys, bucket], [*keys, counterparty]], *keys, bucket, counterparty
    ).agg(grain.alias("grain"), *flow_totals("tx_count"), *counterparty_totals())


def bucket_grain(df_grains: DataFrame) -> DataFrame:
    """Same frame as `net_cashflow_by_bucket`."""
    return df_grains.filter(F.col("grain") == BUCKET).select(
        *_DAY_KEYS, "bucket_start_ts", "net_cashflow", "inflow", "outflow", "tx_count"
    )


def counterparty_grain(df_grains: DataFrame) -> DataFrame:
    """Same frame as `counterparty_flows`."""
    return df_grains.filter(F.col("grain") == COUNTERPARTY).select(
        *_DAY_KEYS, "counterparty_id", "cp_net_flow", "cp_gross_flow", "cp_outflow", "cp_out_count"
    )


def day_totals(df_grains: DataFrame) -> DataFrame:
    """Same frame as `day_gross_total`, from the bucket rows, of which a day has few."""
    buckets = df_grains.filter(F.col("grain") == BUCKET)
    return buckets.groupBy(*_DAY_KEYS).agg(F.sum("cp_gross_flow").alias("total_gross_flow"))
