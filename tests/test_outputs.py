"""State that later runs start from, outputs that switch together, staging that goes with its work."""

from __future__ import annotations

import shutil
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cashwatch.operators.intraday import build_intraday_snapshot, day_moments, delta_and_z
from cashwatch.plans import monitoring
from cashwatch.plans.monitoring import STATE_TABLE, ChecksFailed, Settings, run_monitoring
from cashwatch.schemas import INPUT_TABLES
from cashwatch.sources import testdata
from cashwatch.sources.outputs import VersionedOutputs, read_output
from cashwatch.sources.staging import Staging
from cashwatch.sources.tables import run_together, write_parquet_partitioned
from tests.test_monitoring import OUTPUT_PARTITIONS, SETTINGS, same

DATA = "/root/testdata/sf0.001"
DAY = date(2024, 1, 15)
NAMES = ("transactions", "cashflows", "balances", "collateral", "limits")


def write_raw(spark, raw, keep="true", factor=1.0):
    sources = (testdata.transactions, testdata.cashflows, testdata.balances, testdata.collateral, testdata.limits)
    for name, source in zip(NAMES, sources):
        df, partition = source(spark, DATA), INPUT_TABLES[name][1]
        if name != "cashflows":
            df = df.filter(F.col(partition).between("2024-01-13", "2024-01-17"))
        if name == "transactions":
            df = df.filter(keep).withColumn("amount", F.col("amount") * F.lit(factor))
        write_parquet_partitioned(df, f"{raw}/{name}", [partition], small_groups=True)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    write_raw(spark, path)
    return path


def outputs(spark, out):
    """The outputs as they are now, read once and for all."""
    found = {}
    for name in OUTPUT_PARTITIONS:
        df = read_output(spark, out, name)
        df = df.select(*[F.col(c).cast("string").alias(c) if c in ("value_date", "currency", "as_of_date") else c for c in df.columns])
        found[name] = spark.createDataFrame(df.collect(), df.schema)
    return found


def equal(a, b):
    return all(same(a[name], b[name]) for name in OUTPUT_PARTITIONS)


def test_a_day_is_run_again_from_its_own_transactions_alone(spark, raw, tmp_path, versioned=True):
    out, lonely = str(tmp_path / "out"), tmp_path / "lonely"
    run_monitoring(spark, raw, out, SETTINGS, versioned=versioned)
    before = outputs(spark, out)
    shutil.copytree(raw, lonely)
    # No other day's transactions can be read any more.
    for folder in (lonely / "transactions").glob("value_date=*"):
        if folder.name != f"value_date={DAY}":
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"not a Parquet file")
    for crc in (lonely / "transactions").rglob(".*.crc"):
        crc.unlink()
    run_monitoring(spark, str(lonely), out, SETTINGS, dates=[DAY], versioned=versioned)
    assert equal(outputs(spark, out), before)


def test_the_scan_of_a_run_over_dates_is_pruned(spark, raw, tmp_path, monkeypatch, plan):
    out, scans = str(tmp_path / "out"), []
    run_monitoring(spark, raw, out, SETTINGS)
    sums = monitoring._staged_sums

    def noted(tx, *args):
        scans.append(plan(tx))
        return sums(tx, *args)

    monkeypatch.setattr(monitoring, "_staged_sums", noted)
    run_monitoring(spark, raw, out, SETTINGS, dates=[DAY])
    scan = next(line for line in scans[0].splitlines() if "FileScan" in line)
    assert "PartitionFilters: [" in scan and "2024-01-15" in scan.split("PartitionFilters: [")[1].split("]")[0]
    # Other buckets than the stored ones: the whole history is read.
    run_monitoring(spark, raw, out, Settings(granularity="30min"), dates=[DAY])
    assert "PartitionFilters: []" in next(line for line in scans[1].splitlines() if "FileScan" in line)


def test_a_changed_day_gets_the_values_of_a_run_over_everything(spark, raw, tmp_path):
    settings = Settings(top_n=3)
    changed, out, full = str(tmp_path / "changed"), str(tmp_path / "out"), str(tmp_path / "full")
    run_monitoring(spark, raw, out, settings)
    shutil.copytree(raw, changed)
    tx = testdata.transactions(spark, DATA).filter(F.col("value_date") == F.lit(DAY)).withColumn("amount", F.col("amount") * 7)
    write_parquet_partitioned(tx, f"{changed}/transactions", ["value_date"])
    run_monitoring(spark, changed, out, settings, dates=[DAY])
    run_monitoring(spark, changed, full, settings)
    of_day = F.col("value_date") == str(DAY)
    a, b = outputs(spark, out), outputs(spark, full)
    for name in ("intraday_snapshots", "daily_snapshots", "limit_utilization"):
        assert same(a[name].filter(of_day), b[name].filter(of_day)), name
    assert same(read_output(spark, out, STATE_TABLE).drop("timezone"), read_output(spark, full, STATE_TABLE).drop("timezone"))


def test_a_first_run_over_dates_reads_the_history_once_and_stores_it(spark, raw, tmp_path):
    out, full = str(tmp_path / "out"), str(tmp_path / "full")
    run_monitoring(spark, raw, out, SETTINGS, dates=[DAY])
    run_monitoring(spark, raw, full, SETTINGS)
    of_day = F.col("value_date") == F.lit(DAY)
    assert same(read_output(spark, out, "daily_snapshots"), read_output(spark, full, "daily_snapshots").filter(of_day))
    assert same(read_output(spark, out, STATE_TABLE).drop("timezone"), read_output(spark, full, STATE_TABLE).drop("timezone"))


def test_moments_stored_for_other_days_give_the_same_scores(spark):
    net = testdata.transactions(spark, DATA).withColumn("bucket_start_ts", F.date_trunc("hour", "event_ts"))
    from cashwatch.operators.flows import net_cashflow_by_bucket

    snapshot = build_intraday_snapshot(net_cashflow_by_bucket(net))
    one = F.col("value_date") == F.lit(DAY)
    whole = delta_and_z(snapshot).filter(one)
    stored = day_moments(snapshot.filter(~one)).unionByName(day_moments(snapshot.filter(one)))
    assert same(delta_and_z(snapshot.filter(one), df_moments=stored), whole)


def test_readers_stay_on_the_old_version_when_a_run_stops(spark, raw, tmp_path, monkeypatch):
    out, doubled = str(tmp_path / "out"), str(tmp_path / "doubled")
    run_monitoring(spark, raw, out, SETTINGS, versioned=True)
    before = outputs(spark, out)
    write_raw(spark, doubled, factor=2.0)
    write = VersionedOutputs.write

    def stops(self, df, table, *args):
        if table == "daily_snapshots":
            raise OSError("stopped between two writes")
        write(self, df, table, *args)

    monkeypatch.setattr(VersionedOutputs, "write", stops)
    with pytest.raises(OSError):
        run_monitoring(spark, doubled, out, SETTINGS, versioned=True)
    assert equal(outputs(spark, out), before)
    monkeypatch.undo()
    run_monitoring(spark, doubled, out, SETTINGS, versioned=True)
    after = outputs(spark, out)
    assert not same(after["daily_snapshots"], before["daily_snapshots"])
    total = after["intraday_snapshots"].agg(F.sum("inflow")).first()[0]
    assert total == pytest.approx(2 * before["intraday_snapshots"].agg(F.sum("inflow")).first()[0])


def test_dates_gone_from_the_input_disappear_and_old_folders_expire(spark, raw, tmp_path):
    out, shorter = str(tmp_path / "out"), str(tmp_path / "shorter")
    run_monitoring(spark, raw, out, SETTINGS, versioned=True)
    write_raw(spark, shorter, keep=F.col("value_date") != F.lit(DAY))
    run_monitoring(spark, shorter, out, SETTINGS, versioned=True)
    days = {r.value_date for r in outputs(spark, out)["daily_snapshots"].collect()}
    assert days and str(DAY) not in days
    run_monitoring(spark, raw, out, SETTINGS, dates=[DAY], versioned=True)
    seen = outputs(spark, out)
    assert {r.value_date for r in seen["daily_snapshots"].collect()} == days | {str(DAY)}
    versions = VersionedOutputs(spark, out)
    assert [v.version for v in versions.versions()] == [1, 2, 3]
    assert versions.expire(keep=1) > 0
    assert [v.version for v in versions.versions()] == [3] and equal(outputs(spark, out), seen)
    assert len(list(Path(out, "dq_results").glob("run=*"))) == 1


def test_failed_checks_can_stop_a_run(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    run_monitoring(spark, raw, out, SETTINGS, versioned=True)
    before = outputs(spark, out)
    small = Settings(top_n=3, max_tx_rows=5)
    with pytest.raises(ChecksFailed) as error:
        run_monitoring(spark, raw, out, small, versioned=True, stop_on_failed_checks=True)
    assert {name for name, _ in error.value.failed} == {"tx_volume_sanity", "cf_pk_unique"}
    assert equal(outputs(spark, out), before)
    plain = str(tmp_path / "plain")
    with pytest.raises(ChecksFailed):
        run_monitoring(spark, raw, plain, small, stop_on_failed_checks=True)
    assert [p.name for p in Path(plain).iterdir()] == ["dq_results"]
    failed = {r.check_name for r in read_output(spark, plain, "dq_results").filter("NOT passed").collect()}
    assert failed == {"tx_volume_sanity", "cf_pk_unique"}


def test_nothing_staged_is_left_after_a_run(spark, raw, tmp_path):
    staging = tmp_path / "staging"
    run_monitoring(spark, raw, str(tmp_path / "out"), SETTINGS, str(staging))
    run_monitoring(spark, raw, str(tmp_path / "out"), SETTINGS, str(staging), dates=[DAY])
    assert list(staging.rglob("*.parquet")) == []


def test_staged_frames_keep_only_what_they_read(spark, tmp_path):
    sources = (testdata.transactions, testdata.cashflows, testdata.balances, testdata.collateral, testdata.limits)
    frames = monitoring.monitoring_frames(*[s(spark, DATA) for s in sources], settings=SETTINGS, staging_path=str(tmp_path))
    (work,) = tmp_path.iterdir()
    assert {p.name.rsplit("-", 1)[0] for p in work.iterdir()} == {
        "intraday_snapshots", "limit_utilization", "concentration_top_counterparties"
    }
    assert frames["daily_snapshots"].count() > 0


def test_staging(spark, tmp_path):
    with Staging(spark, str(tmp_path)) as work:
        a, b, c = run_together(spark, *[lambda i=i: work.stage(spark.range(i), f"t{i}") for i in (1, 2, 3)])
        work.release(a)
        assert len(list(Path(work.path).iterdir())) == 2
        kept = work.keep(b)
    assert kept.count() == 2 and len(list(Path(work.path).iterdir())) == 1
    with pytest.raises(ValueError):
        with Staging(spark, str(tmp_path)) as work:
            work.keep(work.stage(c.limit(0), "x"))
            raise ValueError
    assert not Path(work.path).exists()
