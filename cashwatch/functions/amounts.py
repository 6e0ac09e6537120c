"""Amounts, guarded ratios, threshold flags and the maturity bucket."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Direction codes, maturity labels with their last day, flag names.
INFLOW = "IN"
OUTFLOW = "OUT"
MATURITY_LADDER = [
    (-1, "past_due"),
    (0, "t0"),
    (7, "t1_7d"),
    (30, "t8_30d"),
    (90, "t31_90d"),
]
BEYOND_LADDER = "t90d_plus"
CONCENTRATION = "CONCENTRATION"
LIQUIDITY_DROP = "LIQUIDITY_DROP"
LIMIT_BREACH = "LIMIT_BREACH"


def signed_amount(direction: str = "direction", amount: str = "amount") -> Column:
    """Positive for IN. Every other direction, NULL and unknown codes included, is negative."""
    value = F.col(amount)
    return F.when(F.col(direction) == INFLOW, value).otherwise(-value)


def amount_if(code: str, direction: str = "direction", amount: str = "amount") -> Column:
    """The amount of rows with direction `code`, zero for all others."""
    return F.when(F.col(direction) == code, F.col(amount)).otherwise(F.lit(0))


def net_value(value: str = "market_value", haircut: str = "haircut_pct") -> Column:
    """Value after the haircut fraction."""
    return F.col(value) * (F.lit(1.0) - F.col(haircut))


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """NULL unless the denominator is positive; never divides by zero under ANSI mode."""
    return F.when(denominator > 0, numerator / denominator)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """0.0 unless the denominator is positive. A NULL numerator stays NULL."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def at_least(metric: Column, threshold: float) -> Column:
    """Inclusive upper-threshold flag; NULL in, NULL out."""
    return metric >= F.lit(float(threshold))


def at_most_negative(metric: Column, threshold: float) -> Column:
    """True at or below minus the size of `threshold`; NULL in, NULL out."""
    return metric <= F.lit(-abs(float(threshold)))


def maturity_bucket_expr(col_maturity_date: str, col_as_of_date: str) -> Column:
    """Ladder label by days to maturity. A NULL date lands in the open-ended last bucket."""
    days = F.date_diff(F.col(col_maturity_date), F.col(col_as_of_date))
    (first_day, first_label), *later = MATURITY_LADDER
    label = F.when(days <= first_day, F.lit(first_label))
    for last_day, name in later:
        label = label.when(days <= last_day, F.lit(name))
    return label.otherwise(F.lit(BEYOND_LADDER))


def anomaly_list(**raised: Column) -> Column:
    """Names of the flags that are true, in argument order; empty when none is."""
    return F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in raised.items()]))


def known_keys(*names: str) -> Column:
    """True when no key is NULL, i.e. when an equi-join on the keys could match."""
    present = F.col(names[0]).isNotNull()
    for name in names[1:]:
        present = present & F.col(name).isNotNull()
    return present
