"""Parquet reads, partitioned and bucketed writes, staging."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

T = TypeVar("T")


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a Parquet directory. With a schema, partition values keep their declared type
    (a currency code such as 0764 stays text) and no footer is read for inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str], small_groups: bool = False
) -> None:
    """Replace the partitions present in `df`, leaving all others as they are.

    Rows are gathered by partition first, so that each gets few files. By default adaptive
    execution then sizes the tasks by bytes: it splits a partition that is too large and
    merges small ones. `small_groups` is for results with a bounded number of rows in every
    partition, where the files and not the bytes are the work: partitions are spread evenly
    over `spark.sql.shuffle.partitions` tasks and not merged.
    """
    if small_groups:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        gathered = df.repartition(tasks, *partitions)
    else:
        gathered = df.hint("rebalance", *partitions)
    (
        gathered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table."""
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int = 64, **options: str) -> None:
    """Write a catalog table bucketed and sorted by `keys`. Two tables with the same
    buckets join on the keys without a shuffle. Pass `path=` for an external table.

    Rows are first dealt to one task per bucket, so that each bucket is one file and keeps
    its sort order on read."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.options(**options).saveAsTable(table)


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under the session's checkpoint folder, which all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/cashwatch-{uuid4().hex}"


def stage(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Write `df` once and go on from the written table.

    Later steps read columns and partitions of it selectively, and a lost executor costs a
    re-read, not the lineage behind it. `path` must be on storage all executors share.
    """
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_together(spark: SparkSession, *actions: Callable[[], T]) -> list[T]:
    """Submit independent actions from threads of their own and return their results.

    Small jobs then fill the executors the large ones leave idle. The first error is raised.
    """
    in_thread = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(in_thread(action)) for action in actions]
        return [job.result() for job in running]
