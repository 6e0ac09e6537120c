"""Bucketed flows of a stream against the batch."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from cashwatch.operators.flows import intraday_time_bucket, net_cashflow_by_bucket
from cashwatch.schemas import TRANSACTIONS
from cashwatch.streaming.flows import net_cashflow_stream, transaction_stream, write_stream
from tests.build import DAY, at, transactions

KEYS = ["value_date", "currency", "bucket_start_ts"]


def rows_of(df):
    return {tuple(r) for r in df.select(*KEYS, "net_cashflow", "inflow", "outflow", "tx_count").collect()}


def batch(spark, rows, granularity="hour"):
    return rows_of(net_cashflow_by_bucket(intraday_time_bucket(transactions(spark, rows), granularity=granularity)))


class Stream:
    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options, self.files = spark, folder, options, 0

    def arrive(self, rows):
        transactions(self.spark, rows).coalesce(1).write.mode("append").parquet(f"{self.folder}/tx")

    def run(self):
        tx = transaction_stream(self.spark, f"{self.folder}/tx", TRANSACTIONS, files_per_batch=1)
        out = net_cashflow_stream(tx, **self.options)
        write_stream(out, f"{self.folder}/net", f"{self.folder}/checkpoint").awaitTermination()
        return rows_of(self.spark.read.schema(out.schema).parquet(f"{self.folder}/net"))


def test_emitted_buckets_equal_the_batch_and_only_late_ones_are_missing(spark, tmp_path):
    stream = Stream(spark, str(tmp_path))
    first = [(at(h, 10 * m), "CP1", "IN" if m % 2 else "OUT", 5.0 + m, DAY, c) for h in range(3) for m in range(6) for c in ("THB", "USD")]
    stream.arrive(first)
    # The newest event is at 2:50, so buckets that end by 0:50 are complete: none yet.
    assert stream.run() == set()
    second = [(at(5, 1), "CP2", "IN", 1.0), (at(2, 59), "CP1", None, 7.0)]
    stream.arrive(second)
    emitted = stream.run()
    expected = {r for r in batch(spark, first + second) if r[2] + timedelta(hours=1) <= datetime(2026, 1, 23, 3, 1)}
    assert emitted == expected and len(emitted) == 6
    # Behind the watermark: dropped. Within it: counted once, in a run that starts from the checkpoint.
    stream.arrive([(at(0, 5), "CP1", "IN", 1000.0), (at(4, 30), "CP3", "OUT", 2.0)])
    stream.arrive([(at(9), "CP3", "OUT", 3.0)])
    emitted = stream.run()
    whole = batch(spark, first + second + [(at(4, 30), "CP3", "OUT", 2.0), (at(9), "CP3", "OUT", 3.0)])
    assert emitted == {r for r in whole if r[2] + timedelta(hours=1) <= datetime(2026, 1, 23, 7)}
    assert stream.run() == emitted


def test_finer_buckets_and_lateness(spark, tmp_path):
    stream = Stream(spark, str(tmp_path), lateness="0 minutes", granularity="30min")
    rows = [(at(h, m), "CP1", "IN", 1.0) for h in (1, 2) for m in (0, 29, 30, 59)] + [(at(4), "CP1", "IN", 1.0)]
    stream.arrive(rows)
    assert stream.run() == {r for r in batch(spark, rows, "30min") if r[2] < datetime(2026, 1, 23, 4)}
    with pytest.raises(ValueError):
        net_cashflow_stream(spark.readStream.schema(TRANSACTIONS).parquet(f"{tmp_path}/tx"), granularity="day")
