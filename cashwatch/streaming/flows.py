"""Bucketed flows of a stream of transaction files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cashwatch.functions.buckets import GRANULARITIES
from cashwatch.operators.flows import flow_totals


def transaction_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files under `path`, each file once. The schema is declared: a stream infers none."""
    reader = spark.readStream.schema(schema)
    return (reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)).parquet(path)


def net_cashflow_stream(df_tx: DataFrame, lateness: str = "2 hours", granularity: str = "hour", offset: str = "0 minutes") -> DataFrame:
    """`net_cashflow_by_bucket` of a stream: the same columns and the same sums.

    A bucket is a tumbling window of event time. It is emitted once, when the newest event seen
    is `lateness` past its end; rows that come later than that are dropped, and state of emitted
    buckets is freed. State is one row of sums per open bucket, day and currency, whatever the
    number of transactions. `offset` shifts buckets for zones that are not whole hours from UTC.
    """
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {sorted(GRANULARITIES)}, not {granularity!r}")
    length = f"{GRANULARITIES[granularity]} seconds"
    bucket = F.window("event_ts", length, startTime=offset)
    sums = df_tx.withWatermark("event_ts", lateness).groupBy(bucket, "value_date", "currency").agg(*flow_totals("tx_count"))
    return sums.select(
        "value_date", "currency", F.col("window.start").alias("bucket_start_ts"),
        "net_cashflow", "inflow", "outflow", "tx_count",
    )


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what the stream emits to Parquet files, up to all files there are now.

    The checkpoint holds which files were read and the open buckets: a run that starts again
    with it, after a stop or a failure, goes on where the last one committed, and the sink's own
    log keeps a repeated batch from being written twice.
    """
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
