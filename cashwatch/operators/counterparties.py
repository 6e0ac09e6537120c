"""Counterparty flows, concentration and top-N."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cashwatch.functions.amounts import OUTFLOW, at_least, known_keys, ratio_or_zero, signed_amount
from cashwatch.operators.grains import counterparty_totals, day_gross

_DAY_KEYS = ["value_date", "currency"]
MOST_TOTALS = 1_000_000  # rows of 40 bytes that may be broadcast


def counterparty_flows(df_tx: DataFrame) -> DataFrame:
    """Net, gross and outgoing flow per day, currency and counterparty in one aggregate."""
    return df_tx.groupBy(*_DAY_KEYS, "counterparty_id").agg(*counterparty_totals())


def counterparty_outflow(df_tx: DataFrame) -> DataFrame:
    """Outgoing amount per counterparty; the direction filter reaches the scan."""
    return (
        df_tx.filter(F.col("direction") == OUTFLOW)
        .groupBy(*_DAY_KEYS, "counterparty_id")
        .agg(F.sum("amount").alias("cp_outflow"))
    )


def outflow_of_flows(df_flows: DataFrame) -> DataFrame:
    """`counterparty_outflow` from already aggregated `counterparty_flows`."""
    return df_flows.filter(F.col("cp_out_count") > 0).select(*_DAY_KEYS, "counterparty_id", "cp_outflow")


def day_gross_total(df_tx: DataFrame) -> DataFrame:
    """Gross flow per day and currency, summed directly: one partial sum per task and day."""
    return df_tx.groupBy(*_DAY_KEYS).agg(day_gross().alias("total_gross_flow"))


def totals_of_flows(df_flows: DataFrame) -> DataFrame:
    """`day_gross_total` from already aggregated `counterparty_flows`."""
    return df_flows.groupBy(*_DAY_KEYS).agg(F.sum("cp_gross_flow").alias("total_gross_flow"))


def concentration_top_counterparties(df_tx: DataFrame, top_n: int, salts: int = 1) -> DataFrame:
    """The `top_n` counterparties by share of the day's gross flow, with top-1 and top-N shares.

    `salts` above 1 cuts a day's counterparties into that many parts which meet the day's total
    without a broadcast and are limited to `top_n` rows each before they meet. It changes no row.
    Use it where `top_n` exceeds `spark.sql.optimizer.windowGroupLimitThreshold`, beyond which
    tasks no longer limit rows before the shuffle, or for more than `MOST_TOTALS` days and currencies.
    """
    # Both sums are needed for the net, the gross and the day's total alike, so all three read one shuffle.
    signed, nothing = signed_amount(), F.lit(0)
    up = F.sum(F.when(signed > 0, signed).when(signed.isNotNull(), nothing))
    down = F.sum(F.when(signed < 0, -signed).when(signed.isNotNull(), nothing))
    sums = df_tx.groupBy(*_DAY_KEYS, "counterparty_id").agg(up.alias("_up"), down.alias("_down"))
    net, gross = F.col("_up") - F.col("_down"), F.col("_up") + F.col("_down")
    flows = sums.select(*_DAY_KEYS, "counterparty_id", net.alias("cp_net_flow"), gross.alias("cp_gross_flow"))
    return top_of_flows(flows, totals_of_flows(flows), top_n, salts)


def _few(df_day_totals: DataFrame) -> DataFrame:
    """The totals, if they are few enough to be broadcast; else an error when it runs.

    One row more than allowed is enough to tell, so the count never holds more than that."""
    columns = df_day_totals.columns
    counted = df_day_totals.limit(MOST_TOTALS + 1).withColumn("_rows", F.count("*").over(Window.partitionBy(F.lit(0))))
    refusal = F.raise_error(F.lit(f"more than {MOST_TOTALS} days and currencies: pass salts"))
    return counted.filter(F.when(F.col("_rows") <= MOST_TOTALS, F.lit(True)).otherwise(refusal.cast("boolean"))).select(*columns)


def top_of_flows(df_flows: DataFrame, df_day_totals: DataFrame, top_n: int, salts: int = 1) -> DataFrame:
    """Rank `counterparty_flows` rows within a day, given `day_gross_total` rows.

    The total is joined first, so that the cut before the shuffle and the final rank go by the
    same share and then by the id: near ties that round to one share are cut as they are
    ranked. A day and currency may hold a large part of all counterparties, so they never meet in
    one task; each task keeps its own best rows first. Totals are one row per day and currency (a
    century in 20 currencies is 730,000 rows): up to `MOST_TOTALS` of them are broadcast, so that
    flows are not moved for the join, and more raise an error that asks for `salts`, with which
    flows join by day, currency and salt.
    """
    top_n, salts = int(top_n), int(salts)
    if salts < 1:
        raise ValueError("salts must be at least 1")
    known = known_keys(*_DAY_KEYS)
    share, rank = F.col("cp_share"), F.col("cp_rank")
    by_share = [share.desc(), F.col("counterparty_id")]

    # A NULL day or currency matches no total: its shares are 0.0 and only ids order its rows.
    if salts > 1:
        salted = df_flows.withColumn("_salt", F.pmod(F.xxhash64("counterparty_id"), F.lit(salts)))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
        joined = salted.join(df_day_totals.withColumn("_salt", every), [*_DAY_KEYS, "_salt"], "left")
    else:
        joined = df_flows.join(F.broadcast(_few(df_day_totals)), _DAY_KEYS, "left")
    shared = joined.withColumn("cp_share", ratio_or_zero(F.col("cp_gross_flow"), F.col("total_gross_flow")))
    # Rank 1 is kept for the top-1 share even where no row is asked for.
    limit = max(top_n, 1)
    if salts > 1:
        within = Window.partitionBy(*_DAY_KEYS, "_salt").orderBy(*by_share)
        shared = shared.withColumn("_row", F.row_number().over(within)).filter(F.col("_row") <= limit).drop("_row", "_salt")

    day = Window.partitionBy(*_DAY_KEYS)
    best = shared.withColumn("cp_rank", F.row_number().over(day.orderBy(*by_share))).filter(rank <= limit)
    ranked = best.withColumns(
        {
            "top1_share": F.when(known, F.max(F.when(rank == 1, share)).over(day)),
            "topN_share": F.when(known, F.sum(F.when(rank <= top_n, share)).over(day)),
            "topN": F.when(known, F.lit(top_n)),
        }
    )
    return ranked.filter(rank <= top_n).select(
        *_DAY_KEYS,
        "counterparty_id",
        "cp_net_flow",
        "cp_gross_flow",
        "total_gross_flow",
        "cp_share",
        "cp_rank",
        "top1_share",
        "topN_share",
        "topN",
    )


def flag_concentration_anomaly(
    df_conc_top: DataFrame, share_threshold: float, metric: str = "top1_share"
) -> DataFrame:
    """One row per day and currency, flagged where `metric` reaches the threshold.

    `metric` is `top1_share`, or `topN_share` to flag on the whole top list. Day-level columns
    are the same on all rows of a day, so its first-ranked row gives them all.
    """
    if metric not in ("top1_share", "topN_share"):
        raise ValueError(f"metric must be top1_share or topN_share, not {metric!r}")
    leaders = df_conc_top.where("cp_rank = 1")
    raised = at_least(F.col(metric), share_threshold).alias("flag_concentration")
    return leaders.select(*_DAY_KEYS, "top1_share", "topN_share", "topN", raised)
