"""Calendar spine: every key on every date, for filling gaps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F


def calendar_spine(df_keys: DataFrame, start: date, days: int, name: str = "value_date") -> DataFrame:
    """Repeat each row of `df_keys` for `days` dates from `start` forward.

    The dates are an array exploded in place, so there is no join and no shuffle, and the
    keys keep their partitioning. No days give no rows.
    """
    first = F.lit(start)
    # A sequence to an earlier date would run backwards.
    dates = F.sequence(first, F.date_add(first, days - 1)) if days > 0 else F.array().cast("array<date>")
    return df_keys.select(F.explode(dates).alias(name), *df_keys.columns)


def observed_spine(df_keys: DataFrame, df_dates: DataFrame, name: str = "value_date") -> DataFrame:
    """Repeat each row of `df_keys` for every date from the first to the last `name` of `df_dates`.

    The bounds are one row, found in the same job; NULL dates do not count, and no dates give
    no rows.
    """
    bounds = df_dates.agg(F.min(name).alias("_first"), F.max(name).alias("_last"))
    dates = bounds.select(F.sequence("_first", "_last").alias("_dates"))
    return df_keys.select(F.explode(dates.scalar()).alias(name), *df_keys.columns)


def with_each(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Repeat each row for each of a short list of literal values, as column `name`."""
    options = F.array(*[F.lit(v) for v in values])
    return df.select(*df.columns, F.explode(options).alias(name))


def fill_gaps(df_spine: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join measures to a spine; dates without data keep their row with NULL measures."""
    return df_spine.join(df, list(keys), "left")


def carry_forward(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "value_date", range_days: int = 32
) -> DataFrame:
    """Replace NULLs of `columns` by the key's last known value before them, in order of the date
    `name`. Before the first known value they stay NULL, and so do rows without a date.

    A key's dates are cut into ranges of `range_days`. The last known value of every range is one
    row, these are carried on from range to range, and then each range is filled for itself. So no
    window holds a key's whole history, but its ranges or one range's rows. Of several rows with one
    key and date, a NULL may take the value of the other; give each date one row.
    """
    keys, columns = list(keys), list(columns)
    cut = df.withColumn("_range", F.floor(F.unix_date(name) / F.lit(float(range_days))))
    known = [F.max_by(F.struct(c), F.when(F.col(c).isNotNull(), F.col(name))).alias(f"_last_{i}") for i, c in enumerate(columns)]
    ranges = cut.filter(F.col(name).isNotNull()).groupBy(*keys, "_range").agg(*known)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.last(f"_last_{i}", ignorenulls=True).over(earlier)[c].alias(f"_before_{i}") for i, c in enumerate(columns)]
    renamed = [F.col(k).alias(f"_key_{i}") for i, k in enumerate([*keys, "_range"])]
    carried = ranges.select(*renamed, *before)
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate([*keys, "_range"])]
    within = Window.partitionBy(*keys, "_range").orderBy(name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(within), F.col(f"_before_{i}")) for i, c in enumerate(columns)}
    undated = {c: F.when(F.col(name).isNull(), F.col(c)).otherwise(value) for c, value in filled.items()}
    return cut.join(carried, same, "left").select(*[undated.get(c, F.col(c)).alias(c) for c in df.columns])
