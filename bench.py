"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all cores) choose the
data and the parallelism. Each query runs once to warm up and once on the clock, its
result going to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from parity.queries import QUERIES

HEADLINE = [
    "net_cashflow_by_bucket",
    "maturity_ladder",
    "intraday_snapshot",
    "liquidity_drop_flags",
    "daily_from_intraday",
    "counterparty_flows",
    "concentration_top",
    "concentration_flags",
    "counterparty_outflow",
    "limit_utilization",
    "daily_limit_flags",
    "liquidity_base",
    "daily_snapshot",
    "daily_snapshot_staged",
    "dq_suite",
    "calendar_spine",
    "partitioned_roundtrip",
    "monitoring_run",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cashwatch-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS") or str(os.cpu_count()))
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
