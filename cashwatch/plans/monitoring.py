"""The monitoring run: all outputs from the five input tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cashwatch.operators.counterparties import (
    counterparty_flows,
    flag_concentration_anomaly,
    outflow_of_flows,
    top_of_flows,
    totals_of_flows,
)
from cashwatch.operators.flows import intraday_time_bucket, maturity_ladder, net_cashflow_by_bucket
from cashwatch.operators.grains import bucket_grain, counterparty_grain, day_totals, transaction_grains
from cashwatch.operators.intraday import build_intraday_snapshot, day_moments, flag_liquidity_drop_anomaly
from cashwatch.operators.limits import daily_limit_flags, limit_utilization
from cashwatch.operators.liquidity import liquidity_base
from cashwatch.operators.quality import dq_suite, transaction_counts
from cashwatch.plans.daily import daily_snapshot
from cashwatch.schemas import INPUT_TABLES
from cashwatch.sources.outputs import FolderOutputs, VersionedOutputs
from cashwatch.sources.staging import Staging
from cashwatch.sources.tables import read_parquet, run_together


@dataclass(frozen=True)
class Settings:
    """Parameters of a run, with the default thresholds."""

    granularity: str = "hour"
    timezone: str | None = None
    z_threshold: float = 3.0
    reset_daily: bool = False
    top_n: int = 10
    top_salts: int = 1
    concentration_share: float = 0.20
    limit_warning: float = 0.90
    limit_breach: float = 1.00
    limit_split_rows: int | None = None
    max_tx_rows: int = 10_000_000


# Output tables and the columns they are partitioned by. All but the
# utilization, which has a row per counterparty, have a bounded number of rows in a partition.
OUTPUT_PARTITIONS = {
    "intraday_snapshots": ["value_date", "currency"],
    "daily_snapshots": ["value_date"],
    "concentration_top_counterparties": ["value_date", "currency"],
    "maturity_ladder": ["as_of_date", "currency"],
    "limit_utilization": ["value_date", "currency"],
}

# What later runs need of each day, one row per day and currency.
STATE_TABLE = "intraday_state"


class ChecksFailed(Exception):
    """Quality checks that were to stop a run did not pass; `failed` has their names and details."""

    def __init__(self, failed: list[tuple[str, str]]):
        super().__init__(", ".join(f"{name}: {details}" for name, details in failed))
        self.failed = failed


def _of_dates(column: str, dates: Sequence[date] | None) -> Column:
    return F.lit(True) if dates is None else F.col(column).isin(list(dates))


def _staged_sums(
    tx: DataFrame, settings: Settings, work: Staging, dates: Sequence[date] | None = None, whole_history: bool = True
) -> dict[str, DataFrame]:
    """Sums of transactions by bucket, counterparty and day, staged.

    All come from one scan, of the chosen dates alone where the other days' moments are stored.
    Otherwise bucket sums cover the whole history and counterparty sums the chosen dates.
    """
    bucketed = intraday_time_bucket(tx, settings.timezone, settings.granularity)
    chosen = _of_dates("value_date", dates)
    if dates is None or not whole_history:
        grains = work.stage(transaction_grains(bucketed.filter(chosen)), "grains", ["grain"])
        return {"net": bucket_grain(grains), "flows": counterparty_grain(grains), "totals": day_totals(grains)}
    net = work.stage(net_cashflow_by_bucket(bucketed), "buckets")
    flows = work.stage(counterparty_flows(tx.filter(chosen)), "flows")
    return {"net": net, "flows": flows, "totals": totals_of_flows(flows)}


def _frames(
    sums: dict[str, DataFrame],
    lim: DataFrame,
    settings: Settings,
    dates: Sequence[date] | None = None,
    moments: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Intraday, top and utilization frames. `moments` are those of all days, where the sums are of some."""
    snapshot = build_intraday_snapshot(sums["net"])
    flagged = flag_liquidity_drop_anomaly(snapshot, settings.z_threshold, settings.reset_daily, moments)
    outflow = outflow_of_flows(sums["flows"])
    return {
        "intraday_snapshots": flagged.filter(_of_dates("value_date", dates)),
        "concentration_top_counterparties": top_of_flows(
            sums["flows"], sums["totals"], settings.top_n, settings.top_salts
        ),
        "limit_utilization": limit_utilization(
            outflow, lim, settings.limit_warning, settings.limit_breach, settings.limit_split_rows
        ),
    }


def _daily(frames: dict[str, DataFrame], bal: DataFrame, col: DataFrame, settings: Settings) -> DataFrame:
    return daily_snapshot(
        frames["intraday_snapshots"],
        daily_limit_flags(frames["limit_utilization"]),
        liquidity_base(bal, col),
        flag_concentration_anomaly(frames["concentration_top_counterparties"], settings.concentration_share),
    )


def monitoring_frames(
    tx: DataFrame,
    cf: DataFrame,
    bal: DataFrame,
    col: DataFrame,
    lim: DataFrame,
    settings: Settings = Settings(),
    staging_path: str | None = None,
    lazy: bool = False,
) -> dict[str, DataFrame]:
    """The five output frames by table name.

    Transactions are scanned and shuffled once for all grains, and what feeds several outputs is
    written to a new folder under `staging_path`, or else under the session's checkpoint folder,
    and read back. What the returned frames read stays there, and nothing else. With `lazy`
    nothing runs yet, and each output scans the transactions for itself.
    """
    if lazy:
        net = net_cashflow_by_bucket(intraday_time_bucket(tx, settings.timezone, settings.granularity))
        flows = counterparty_flows(tx)
        frames = _frames({"net": net, "flows": flows, "totals": totals_of_flows(flows)}, lim, settings)
    else:
        with Staging(tx.sparkSession, staging_path, "monitoring") as work:
            lazy_frames = _frames(_staged_sums(tx, settings, work), lim, settings)
            written = run_together(
                tx.sparkSession, *[partial(work.stage, frame, name) for name, frame in lazy_frames.items()]
            )
            work.keep(*written)
        frames = dict(zip(lazy_frames, written))
    return {**frames, "daily_snapshots": _daily(frames, bal, col, settings), "maturity_ladder": maturity_ladder(cf)}


def _other_days(outputs: FolderOutputs | VersionedOutputs, settings: Settings, dates: Sequence[date]) -> DataFrame | None:
    """Stored moments of all days but `dates`; None where some are missing or of other buckets."""
    state = outputs.current(STATE_TABLE)
    if state is None:
        return None
    same = (F.col("granularity") == settings.granularity) & F.col("timezone").eqNullSafe(F.lit(settings.timezone))
    if not state.filter(~same).isEmpty():
        return None
    typed = state.withColumn("value_date", F.col("value_date").cast("date")).withColumn("currency", F.col("currency").cast("string"))
    return typed.filter(~F.coalesce(_of_dates("value_date", dates), F.lit(False))).drop("granularity", "timezone")


def run_monitoring(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    settings: Settings = Settings(),
    staging_path: str | None = None,
    dates: Sequence[date] | None = None,
    versioned: bool = False,
    stop_on_failed_checks: bool = False,
) -> None:
    """Read the input tables under `raw_path`, write `dq_results` and the five outputs.

    Without `dates` the dates present in the input are replaced. With them only those dates are
    read and written. Changes are compared with the whole history all the same: each run stores,
    per day and currency, the moments of its changes and its close (`intraday_state`), so a date
    that is run again gets the values of a run over everything. Other dates keep theirs. Where
    that state is missing, or of other buckets, such a run reads the whole history once. Quality
    checks cover the rows that are read.

    With `versioned`, readers (`read_output`) see all outputs change at one moment, at the end,
    and dates that left the input are gone; a run that stops before leaves them on the old version.
    With `stop_on_failed_checks` a failed check raises `ChecksFailed` before any output but
    `dq_results` is written.

    Each output is written once; daily snapshots are derived from what was written. Staged sums
    go to a new folder under `staging_path` or else under the session's checkpoint folder, which
    is deleted at the end.
    """
    tables = {
        name: read_parquet(spark, f"{raw_path}/{name}", schema).filter(_of_dates(partition, dates))
        for name, (schema, partition) in INPUT_TABLES.items()
    }
    cf, bal, col, lim = (tables[n] for n in ("cashflows", "balances", "collateral", "limits"))
    outputs = VersionedOutputs(spark, out_path) if versioned else FolderOutputs(spark, out_path)
    others = None if dates is None else _other_days(outputs, settings, dates)
    whole_history = dates is not None and others is None
    tx = read_parquet(spark, f"{raw_path}/transactions", INPUT_TABLES["transactions"][0]) if whole_history else tables["transactions"]

    def write(name: str, frame: DataFrame) -> None:
        bounded = name != "limit_utilization"
        outputs.write(frame, name, OUTPUT_PARTITIONS[name], bounded)

    with Staging(spark, staging_path, "monitoring") as work:
        # The scan for the sums also counts rows and NULLs for the checks: one row, to the driver.
        counts = Observation()
        sums = _staged_sums(tx.observe(counts, *transaction_counts()), settings, work, dates, whole_history)
        moments = day_moments(build_intraday_snapshot(sums["net"]))
        # All days that the sums cover are stored; what they do not cover is stored already.
        state = moments.withColumns(
            {"granularity": F.lit(settings.granularity), "timezone": F.lit(settings.timezone).cast("string")}
        )
        frames = _frames(sums, lim, settings, dates, None if others is None else others.unionByName(moments))
        frames["maturity_ladder"] = maturity_ladder(cf)

        def write_checks() -> None:
            seen = counts.get
            row = spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in seen.items()])
            checks = dq_suite(tx, cf, bal, col, lim, max_tx_rows=settings.max_tx_rows, tx_counts=row)
            if not stop_on_failed_checks:
                return outputs.write(checks, "dq_results")
            checks = work.stage(checks, "checks")
            outputs.write(checks, "dq_results")
            failed = checks.filter("NOT passed").collect()  # eleven rows at most
            if failed:
                raise ChecksFailed([(r.check_name, r.details) for r in failed])

        writes = [partial(write, name, frame) for name, frame in frames.items()]
        if stop_on_failed_checks:
            write_checks()
        else:
            writes.insert(0, write_checks)
        run_together(spark, *writes)

        # Dates of this run, as earlier runs may have left others in the outputs.
        days = sums["net"].filter(_of_dates("value_date", dates)).select("value_date").distinct()
        daily_inputs = ("intraday_snapshots", "limit_utilization", "concentration_top_counterparties")
        daily = _daily({name: outputs.written(name, frames[name].schema, days) for name in daily_inputs}, bal, col, settings)
        run_together(
            spark,
            partial(write, "daily_snapshots", daily),
            # Rows of other days are written only where they were not stored before.
            partial(outputs.write, state, STATE_TABLE, ["value_date"], True),
        )
        outputs.commit(dates)
