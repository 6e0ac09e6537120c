"""Balances and eligible collateral."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cashwatch.functions.amounts import net_value


def balance_total(df_balances: DataFrame) -> DataFrame:
    """Total balance per day and currency."""
    return df_balances.groupBy(F.col("as_of_date").alias("value_date"), "currency").agg(
        F.sum("balance").alias("total_balance")
    )


def eligible_collateral(df_collateral: DataFrame) -> DataFrame:
    """Value after haircut of the eligible collateral per day and currency."""
    return (
        df_collateral.filter(F.col("eligible_lcr") == 1)
        .groupBy(F.col("as_of_date").alias("value_date"), "currency")
        .agg(F.sum(net_value()).alias("eligible_collateral_value"))
    )


def liquidity_base(df_balances: DataFrame, df_collateral: DataFrame) -> DataFrame:
    """Balance and eligible collateral side by side; NULL where a day has no collateral."""
    return balance_total(df_balances).join(
        eligible_collateral(df_collateral), ["value_date", "currency"], "left"
    )


def with_total_liquidity(df_base: DataFrame) -> DataFrame:
    """Add `total_liquidity`: balance plus eligible collateral, none counting as zero."""
    return df_base.withColumn(
        "total_liquidity",
        F.col("total_balance") + F.coalesce(F.col("eligible_collateral_value"), F.lit(0.0)),
    )
