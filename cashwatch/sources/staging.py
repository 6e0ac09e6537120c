"""Intermediate tables that belong to one piece of work and go with it."""

from __future__ import annotations

from collections.abc import Sequence
from types import TracebackType
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from cashwatch.sources.tables import shared_folder, stage


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever storage it lies; a missing one is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class Staging:
    """Owner of staged tables: a folder of its own that is deleted when the work ends.

    A table may go earlier, with `release`, once what was made from it is written. `keep` hands
    tables that a returned frame still reads over to the caller; only they survive the scope,
    and the owner of the folder above deletes them.

        with Staging(spark) as work:
            sums = work.stage(grouped, "sums")
            ...
            return work.keep(work.stage(result, "result"))
    """

    def __init__(self, spark: SparkSession, base: str | None = None, name: str = "staging"):
        """`base` is storage that all executors share; the session's checkpoint folder if not given."""
        self.spark = spark
        self.path = f"{(base or shared_folder(spark)).rstrip('/')}/{name}-{uuid4().hex}"
        self._tables: dict[int, tuple[DataFrame, str]] = {}  # by the frame's identity, which it is kept alive for
        self._kept: set[str] = set()

    def stage(self, df: DataFrame, name: str, partitions: Sequence[str] = ()) -> DataFrame:
        """Write `df` and go on from the written table."""
        path = f"{self.path}/{name}-{uuid4().hex[:8]}"
        table = stage(df, path, partitions)
        self._tables[id(table)] = (table, path)
        return table

    def keep(self, *tables: DataFrame) -> DataFrame:
        """Let tables of this scope survive it; returns the first."""
        self._kept.update(self._tables[id(t)][1] for t in tables)
        return tables[0]

    def adopt(self, other: Staging) -> None:
        """Take over the tables that another scope kept."""
        for key, (table, path) in other._tables.items():
            if path in other._kept:
                self._tables[key] = (table, path)

    def release(self, *tables: DataFrame) -> None:
        """Delete tables of this scope that nothing will read again; others are left alone."""
        for table in tables:
            _, path = self._tables.pop(id(table), (None, None))
            if path is not None:
                delete_folder(self.spark, path)

    def close(self) -> None:
        """Delete all tables that are not kept."""
        if self._kept:
            self.release(*[t for t, path in self._tables.values() if path not in self._kept])
        else:
            self.release(*[t for t, _ in self._tables.values()])
            delete_folder(self.spark, self.path)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if kind is not None:
            self._kept.clear()
        self.close()
