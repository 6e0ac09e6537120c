"""The joined daily snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cashwatch.functions.amounts import CONCENTRATION, LIMIT_BREACH, LIQUIDITY_DROP, anomaly_list
from cashwatch.operators.intraday import daily_intraday_summary

_KEYS = ["value_date", "currency"]


def with_anomaly_flags(df: DataFrame) -> DataFrame:
    """Add `anomaly_flags`, the names of the raised flags. Limit warnings are not among them."""
    return df.withColumn(
        "anomaly_flags",
        anomaly_list(
            **{
                CONCENTRATION: F.col("flag_concentration"),
                LIQUIDITY_DROP: F.col("flag_liquidity_drop_any"),
                LIMIT_BREACH: F.col("flag_limit_breach_any"),
            }
        ),
    )


def daily_snapshot(
    df_intraday_flags: DataFrame,
    df_limit_flags: DataFrame,
    df_liquidity: DataFrame,
    df_concentration_flags: DataFrame,
) -> DataFrame:
    """One row per day and currency with transactions, everything else left-joined.

    Every input is aggregated to that key already, so these joins handle a few rows per day.
    """
    concentration = df_concentration_flags.select(
        *_KEYS, "flag_concentration", "top1_share", "topN_share", "topN"
    )
    joined = (
        daily_intraday_summary(df_intraday_flags)
        .join(df_limit_flags, _KEYS, "left")
        .join(df_liquidity, _KEYS, "left")
        .join(concentration, _KEYS, "left")
    )
    return with_anomaly_flags(joined).select(
        *_KEYS,
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
    )
