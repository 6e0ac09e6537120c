"""Counts answered by file footers instead of rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cashwatch.operators.quality import count_columns
from cashwatch.sources.tables import read_parquet

# Session options that choose the Parquet reader which answers counts from footers.
_READERS = "spark.sql.sources.useV1SourceList"
_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def footer_counts(spark: SparkSession) -> Iterator[None]:
    """Plain counts of Parquet tables that are read and run inside come from the files' footers.

    They do where no filter on rows stands before them; else the rows are read as usual.
    """
    before = {key: spark.conf.get(key, None) for key in (_READERS, _PUSHDOWN)}
    others = [x for x in (before[_READERS] or "").split(",") if x and x != "parquet"]
    spark.conf.set(_READERS, ",".join(others))
    spark.conf.set(_PUSHDOWN, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def counts_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and known values per column, as the checks take them: the plan of one row."""
    return df.agg(*count_columns(columns))


def table_counts(spark: SparkSession, path: str, columns: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """One row of counts of a Parquet table, read from its footers now; for `df_counts` of the checks."""
    with footer_counts(spark):
        row = counts_of(read_parquet(spark, path, schema), columns).first()
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in row.asDict().items()])
