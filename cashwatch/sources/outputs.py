"""Where a run's output tables go: plain folders, or versions that switch all tables at once.

Both write a table partitioned by its date first, and both give back what a run wrote and what
readers see. Plain folders replace each date as it is written. `VersionedOutputs` writes to
folders of the run, which no reader looks at, and then adds one small file that lists, for every
table and date, the folder that counts from now on. The file appears with a single rename, so
readers see all tables of the old version or all of the new one. One run may write at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from cashwatch.sources.staging import delete_folder
from cashwatch.sources.tables import read_parquet, write_parquet, write_parquet_partitioned

COMMITS = "commits"
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a NULL partition value


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class FolderOutputs:
    """A folder per table. Dates that a run writes replace those that are there; others stay."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, df: DataFrame, table: str, partitions: Sequence[str] = (), small_groups: bool = False) -> None:
        if partitions:
            write_parquet_partitioned(df, f"{self.path}/{table}", partitions, small_groups)
        else:
            write_parquet(df, f"{self.path}/{table}")

    def written(self, table: str, schema: StructType, days: DataFrame) -> DataFrame:
        """Rows of the dates `days` (`value_date`), which this run has written."""
        own = days.withColumnRenamed("value_date", "_day")
        out = read_parquet(self.spark, f"{self.path}/{table}", schema)
        return out.join(own, F.col("value_date").eqNullSafe(F.col("_day")), "left_semi")

    def current(self, table: str, schema: StructType | None = None) -> DataFrame | None:
        """The table as readers see it; None if there is none yet."""
        try:
            return read_parquet(self.spark, f"{self.path}/{table}", schema)
        except AnalysisException as error:
            if _missing(error):
                return None
            raise

    def commit(self, dates: Sequence[date] | None = None) -> None:
        """Nothing to do: every write took effect on its own."""


class VersionedOutputs:
    """Folders of this run under each table, and the list of folders that count.

    `commit` without dates lists this run's folders alone, so dates that left the input are gone.
    With dates it takes those from this run and all others from the version before.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.run = uuid4().hex
        self._tables: dict[str, str | None] = {}  # table -> its date column

    def _folder(self, table: str) -> str:
        return f"{self.path}/{table}/run={self.run}"

    def write(self, df: DataFrame, table: str, partitions: Sequence[str] = (), small_groups: bool = False) -> None:
        if partitions:
            write_parquet_partitioned(df, self._folder(table), partitions, small_groups)
        else:
            write_parquet(df, self._folder(table))
        self._tables[table] = partitions[0] if partitions else None

    def written(self, table: str, schema: StructType, days: DataFrame | None = None) -> DataFrame:
        """Rows that this run has written."""
        return read_parquet(self.spark, self._folder(table), schema)

    def versions(self) -> list[Row]:
        """The committed versions, oldest first: `version, run`."""
        try:
            commits = self.spark.read.parquet(f"{self.path}/{COMMITS}")
        except AnalysisException as error:
            if _missing(error):
                return []
            raise
        return commits.select("version", "run").distinct().orderBy("version", "run").collect()

    def _list_of(self, at: Row) -> DataFrame:
        folder = f"{self.path}/{COMMITS}/version={at.version:08d}/run={at.run}"
        return self.spark.read.schema("table string, day string, folder string").parquet(folder)

    def current(self, table: str, schema: StructType | None = None) -> DataFrame | None:
        """The table as of the newest version: only folders that count are listed and read."""
        versions = self.versions()
        if not versions:
            return None
        folders = self._list_of(versions[-1]).filter(F.col("table") == table).select("folder").collect()
        if not folders:
            return None if schema is None else self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", f"{self.path}/{table}")
        reader = reader if schema is None else reader.schema(schema)
        found = reader.parquet(*[f"{self.path}/{r.folder}" for r in folders]).drop("run")
        return found if schema is None else found.select(*schema.fieldNames())

    def _own_list(self) -> DataFrame:
        lists = []
        for table, column in self._tables.items():
            folder = f"{table}/run={self.run}"
            if column is None:
                lists.append(self.spark.sql("SELECT CAST(NULL AS STRING) AS day").withColumn("folder", F.lit(folder)))
            else:
                days = self.spark.read.schema(f"{column} string").parquet(f"{self.path}/{folder}").select(column).distinct()
                day = F.coalesce(F.col(column), F.lit(_NO_DATE))
                lists.append(days.select(day.alias("day"), F.concat(F.lit(f"{folder}/{column}="), day).alias("folder")))
            lists[-1] = lists[-1].select(F.lit(table).alias("table"), "day", "folder")
        return reduce(DataFrame.unionAll, lists)

    def commit(self, dates: Sequence[date] | None = None) -> None:
        """Let readers see this run: all of it from one moment on."""
        own, versions = self._own_list(), self.versions()
        if dates is not None and versions:
            kept = self._list_of(versions[-1]).filter(~F.coalesce(F.col("day"), F.lit("")).isin([str(d) for d in dates]))
            again = own.select("table", F.col("day").alias("_day"))
            same = (kept["table"] == again["table"]) & F.col("day").eqNullSafe(F.col("_day"))
            own = own.unionAll(kept.join(again, same, "left_anti"))
        number = versions[-1].version + 1 if versions else 1
        folder = f"{self.path}/{COMMITS}/version={number:08d}/run={self.run}"
        own.coalesce(1).write.parquet(folder)

    def expire(self, keep: int = 2) -> int:
        """Delete what none of the newest `keep` versions lists, runs that never committed
        included; returns the number of folders deleted. Readers of older versions lose them."""
        versions = self.versions()
        if keep < 1 or not versions:
            raise ValueError("keep at least one version, after a first commit")
        listed = {r.folder for v in versions[-keep:] for r in self._list_of(v).select("folder").collect()}
        jvm = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        root = jvm.Path(self.path)
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        base = files.getFileStatus(root).getPath().toString()

        def folders(pattern: str) -> list[str]:
            found = files.globStatus(jvm.Path(f"{self.path}/{pattern}")) or []
            return [f.getPath().toString()[len(base) + 1 :] for f in found if f.isDirectory()]

        dead = []
        for run in folders("*/run=*"):
            inside = folders(f"{run}/*=*")
            dead += [] if run in listed else [x for x in inside if x not in listed] if any(x in listed for x in inside) else [run]
        dead += [f"{COMMITS}/version={v.version:08d}" for v in versions[:-keep]]
        for folder in dead:
            delete_folder(self.spark, f"{self.path}/{folder}")
        return len(dead)


def read_output(spark: SparkSession, out_path: str, table: str, schema: StructType | None = None) -> DataFrame:
    """An output table as of now, whether its folder holds versions or not."""
    versioned = VersionedOutputs(spark, out_path)
    outputs = versioned if versioned.versions() else FolderOutputs(spark, out_path)
    found = outputs.current(table, schema)
    if found is None:
        raise ValueError(f"no output {table!r} under {out_path}")
    return found
