"""Staging, distributed ranks and span texts shared by the operators of this package."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cashwatch.sources.staging import Staging
from cashwatch.sources.tables import stage

# Fixed value: words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
RANGES_SHIFT = 48  # the top 16 bits of a 64-bit key name one of 65,536 ranges


def shared_base(spark: SparkSession) -> str:
    """Storage that all executors share: `spark.checkpoint.dir`, or where that is unset, as in
    tests, the warehouse."""
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name for intermediate tables on shared storage."""
    return f"{shared_base(spark)}/llm-{name}-{uuid4().hex}"


_WORK: ContextVar[Staging | None] = ContextVar("work", default=None)


@contextmanager
def work_on(spark: SparkSession, name: str) -> Iterator[Staging]:
    """A scope for the tables that `staged` writes: they go when it ends, but for those it keeps.

    What an inner scope keeps belongs to the outer one.
    """
    outer = _WORK.get()
    with Staging(spark, shared_base(spark), f"llm-{name}") as work:
        token = _WORK.set(work)
        try:
            yield work
        finally:
            _WORK.reset(token)
    if outer is not None:
        outer.adopt(work)


def staged(df: DataFrame, name: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Write `df` and go on from there: a lost executor costs a re-read. The table belongs to the
    scope of `work_on`, or without one to the owner of the shared folder."""
    work = _WORK.get()
    return stage(df, scratch(df.sparkSession, name), partitions) if work is None else work.stage(df, name, partitions)


def discard(*tables: DataFrame, shuffles: bool = True) -> None:
    """Delete tables of the scope that nothing reads any more. With `shuffles`, let Spark drop the
    shuffle files behind them too, which it does when the driver collects garbage."""
    work = _WORK.get()
    if work is not None:
        work.release(*tables)
        if shuffles:
            gc.collect()
            work.spark.sparkContext._jvm.System.gc()


def key_range(key: Column) -> Column:
    """The range (0 to 65,535) of a signed 64-bit key; ranges order as keys do."""
    return (F.shiftright(key, RANGES_SHIFT) + 32768).cast("int")


def with_rank(df: DataFrame, key: str, tie: str, within: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Add the gapless rank (from 0) by `key`, then `tie`, within groups of any size.

    Rows are counted by range of the hash-random key, the counts are summed up over at most
    65,536 ranges of a group, and only rows of one range are sorted together.
    """
    within = list(within)
    ranged = df.withColumn("_range", key_range(F.col(key)))
    counts = ranged.groupBy(*within, "_range").agg(F.count("*").alias("_count"))
    # A constant group is spelled out so that the engine does not warn of a missing one.
    order = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_range")
    before = counts.select(
        *within,
        "_range",
        (F.sum("_count").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_count")).alias("_before"),
    )
    inside = Window.partitionBy(*within, "_range").orderBy(key, tie)
    return (
        ranged.join(before, [*within, "_range"])
        .withColumn(name, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_range", "_before")
    )


def span_text(spans: Column) -> Column:
    """`kind:start:end` of each span in order, comma-joined."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def text_portions(
    batches: Iterator[pa.RecordBatch], most_bytes: int, column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches, with their texts, that hold at most so much text, or one row.

    Python workers go on to other tasks and stages; what Arrow holds unused is given back at the end.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
        start = held = 0
        for i, n in enumerate([*sizes.tolist(), most_bytes]):
            if i > start and (held + n > most_bytes or i == len(sizes)):
                yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
                start, held = i, 0
            held += n
    pa.default_memory_pool().release_unused()
