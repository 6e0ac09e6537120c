"""Data-quality checks as one-row tables `(check_name, passed, details)`.

Nothing is collected: a check is a lazy DataFrame like any other, recorded and not enforced.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _check(name: str, passed: Column, details: Column) -> list[Column]:
    return [F.lit(name).alias("check_name"), passed.alias("passed"), details.alias("details")]


def count_columns(cols: Sequence[str]) -> list[Column]:
    """Aggregates that the checks on NULLs and row counts need."""
    # Plain counts, not counts of a condition: sources that push aggregates down answer
    # them from file statistics without reading a row.
    return [F.count("*").alias("_rows"), *[F.count(c).alias(f"_known_{i}") for i, c in enumerate(cols)]]


def _null_verdict(cols: Sequence[str], name: str) -> list[Column]:
    found = []
    for i, c in enumerate(cols):
        nulls = F.col("_rows") - F.col(f"_known_{i}")
        found.append(F.when(nulls > 0, F.concat(F.lit(f"'{c}': "), nulls.cast("string"))))
    bad = F.array_compact(F.array(*found))
    clean = F.size(bad) == 0
    text = F.concat(F.lit("null_counts={"), F.array_join(bad, ", "), F.lit("}"))
    return _check(name, clean, F.when(clean, F.lit("ok")).otherwise(text))


def _rowcount_verdict(low: int, high: int, name: str) -> list[Column]:
    n = F.col("_rows")
    text = F.concat(F.lit("rowcount="), n.cast("string"), F.lit(f", expected=[{low},{high}]"))
    return _check(name, n.between(low, high), text)


def check_no_nulls(df: DataFrame, cols: Sequence[str], check_name: str) -> DataFrame:
    """Passes when no listed column has a NULL; an empty table passes."""
    return df.agg(*count_columns(cols)).select(*_null_verdict(cols, check_name))


def check_rowcount_between(
    df: DataFrame, low: int, high: int, check_name: str, df_counts: DataFrame | None = None
) -> DataFrame:
    """Passes when the row count is within the inclusive bounds.

    `df_counts`, one row of counts (`cashwatch.sources.statistics.table_counts`), spares the scan."""
    counts = df.agg(F.count("*").alias("_rows")) if df_counts is None else df_counts
    return counts.select(*_rowcount_verdict(low, high, check_name))


def check_files_complete(df: DataFrame, cols: Sequence[str], check_name: str) -> DataFrame:
    """Passes when every file of `df`, a Parquet table as it is read, holds each listed column.

    Under a declared schema a column that a file lacks reads as NULL in all its rows, and sums
    pass over it in silence. Files are told apart by their path; each task counts its own first.
    `details` has the number of files without a value, by column.
    """
    known = [F.count(c).alias(f"_known_{i}") for i, c in enumerate(cols)]
    per_file = df.groupBy(F.col("_metadata.file_path").alias("_file")).agg(*known)
    without = [F.count_if(F.col(f"_known_{i}") == 0).alias(f"_without_{i}") for i, _ in enumerate(cols)]
    found = [
        F.when(F.col(f"_without_{i}") > 0, F.concat(F.lit(f"'{c}': "), F.col(f"_without_{i}").cast("string")))
        for i, c in enumerate(cols)
    ]
    bad = F.array_compact(F.array(*found))
    clean = F.size(bad) == 0
    text = F.concat(F.lit("files_without={"), F.array_join(bad, ", "), F.lit("}"))
    return per_file.agg(*without).select(*_check(check_name, clean, F.when(clean, F.lit("ok")).otherwise(text)))


def check_no_duplicates(df: DataFrame, key_cols: Sequence[str], check_name: str) -> DataFrame:
    """Passes when no key occurs twice. `details` counts every row of a repeated key; NULL
    keys are equal to each other. A hot key shrinks to one row per task before the shuffle."""
    repeated = (
        df.groupBy(*key_cols)
        .agg(F.count("*").alias("_copies"))
        .filter(F.col("_copies") > 1)
        .agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("_rows"))
    )
    n = F.col("_rows")
    clean = n == 0
    text = F.concat(F.lit("duplicate_rows="), n.cast("string"))
    return repeated.select(*_check(check_name, clean, F.when(clean, F.lit("ok")).otherwise(text)))


# The columns of transactions that must be known.
_TX_KNOWN = ["tx_id", "event_ts", "value_date", "account_id", "currency", "direction", "amount"]


def transaction_counts() -> list[Column]:
    """Row and non-NULL counts of transactions, to be observed on a scan made for something else."""
    return count_columns(_TX_KNOWN)


def check_nulls_and_rowcount(
    df: DataFrame,
    cols: Sequence[str],
    nulls_name: str,
    low: int,
    high: int,
    rowcount_name: str,
    df_counts: DataFrame | None = None,
) -> DataFrame:
    """`check_no_nulls` and `check_rowcount_between` from one scan, one row each.

    `df_counts`, one row of counts of the same columns, spares the scan."""
    verdicts = [
        F.struct(*_null_verdict(cols, nulls_name)),
        F.struct(*_rowcount_verdict(low, high, rowcount_name)),
    ]
    counts = df.agg(*count_columns(cols)) if df_counts is None else df_counts
    return counts.select(F.inline(F.array(*verdicts)))


def dq_suite(
    tx: DataFrame,
    cf: DataFrame,
    bal: DataFrame,
    col: DataFrame,
    lim: DataFrame,
    max_tx_rows: int = 10_000_000,
    tx_counts: DataFrame | None = None,
) -> DataFrame:
    """The eleven standard checks. Each table is read once for NULLs and once for its key.

    `tx_counts`, one row of `transaction_counts`, spares the read of `tx` for NULLs."""
    # Check names and the columns each check reads.
    checks = [
        check_nulls_and_rowcount(
            tx,
            _TX_KNOWN,
            "tx_no_nulls",
            1,
            max_tx_rows,
            "tx_volume_sanity",
            tx_counts,
        ),
        check_no_duplicates(tx, ["tx_id"], "tx_pk_unique"),
        check_no_nulls(
            cf,
            ["cf_id", "as_of_date", "maturity_date", "counterparty_id", "currency", "direction", "amount"],
            "cf_no_nulls",
        ),
        check_no_duplicates(cf, ["cf_id"], "cf_pk_unique"),
        check_no_nulls(bal, ["as_of_date", "account_id", "currency", "balance"], "bal_no_nulls"),
        check_no_duplicates(bal, ["as_of_date", "account_id", "currency"], "bal_key_unique"),
        check_no_nulls(
            col,
            ["as_of_date", "collateral_id", "counterparty_id", "currency", "market_value"],
            "col_no_nulls",
        ),
        check_no_duplicates(col, ["collateral_id"], "col_pk_unique"),
        check_no_nulls(
            lim,
            ["as_of_date", "counterparty_id", "limit_type", "currency", "limit_amount"],
            "lim_no_nulls",
        ),
        check_no_duplicates(
            lim, ["as_of_date", "counterparty_id", "limit_type", "currency"], "lim_key_unique"
        ),
    ]
    return reduce(DataFrame.unionByName, checks)
