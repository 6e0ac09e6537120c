"""Settlement-limit utilization."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cashwatch.functions.amounts import at_least, ratio_or_null
from cashwatch.operators.joins import left_join_split

SETTLEMENT = "settlement"


def settlement_limits(df_limits: DataFrame) -> DataFrame:
    """Limits of type settlement, keyed by `value_date`."""
    return df_limits.filter(F.col("limit_type") == SETTLEMENT).withColumnRenamed("as_of_date", "value_date")


def limit_utilization(
    df_outflow: DataFrame,
    df_limits: DataFrame,
    warning_threshold: float = 0.90,
    breach_threshold: float = 1.00,
    split_rows: int | None = None,
) -> DataFrame:
    """Outflow per counterparty against its settlement limit, with warning and breach flags.

    `df_outflow` is `counterparty_outflow(...)`: one row per key, so no key is hot on that
    side, and its aggregate is already partitioned for the join. A counterparty with no
    limit, or one that is not positive, keeps its row with NULL utilization; a limit listed
    twice yields two rows. No broadcast is forced: limits grow with dates and
    counterparties, so the engine decides from their measured size.

    With `split_rows` a key listed more often than that is counted first and its rows are dealt
    to several tasks (`left_join_split`); rows are the same. It costs a count of the limits.
    """
    keys = ["value_date", "currency", "counterparty_id"]
    settlement = settlement_limits(df_limits)
    if split_rows is None:
        joined = df_outflow.join(settlement, keys, "left")
    else:
        joined = left_join_split(df_outflow, settlement, keys, split_rows)
    utilization = ratio_or_null(F.col("cp_outflow"), F.col("limit_amount"))
    used = F.col("utilization")
    return (
        joined.withColumn("utilization", utilization)
        .withColumns(
            {
                "flag_limit_warning": at_least(used, warning_threshold),
                "flag_limit_breach": at_least(used, breach_threshold),
            }
        )
    )


def daily_limit_flags(df_utilization: DataFrame) -> DataFrame:
    """Any warning, any breach and the highest utilization per day and currency."""
    return df_utilization.groupBy("value_date", "currency").agg(
        F.bool_or("flag_limit_warning").alias("flag_limit_warning_any"),
        F.bool_or("flag_limit_breach").alias("flag_limit_breach_any"),
        F.max("utilization").alias("max_utilization"),
    )
