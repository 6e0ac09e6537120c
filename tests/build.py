"""Small input frames."""

from __future__ import annotations

from datetime import date, datetime

DAY = date(2026, 1, 23)
NEXT_DAY = date(2026, 1, 24)

TX = (
    "tx_id string, event_ts timestamp, value_date date, account_id string, counterparty_id string, "
    "currency string, direction string, amount double, product string, channel string"
)
SNAPSHOT = "value_date date, currency string, bucket_start_ts timestamp, cum_net_cashflow double"


def at(hour: int, minute: int = 0, day: date = DAY) -> datetime:
    return datetime(day.year, day.month, day.day, hour, minute)


def transactions(spark, rows):
    """Rows of (event_ts, counterparty, direction, amount[, value_date[, currency]])."""
    full = []
    for i, (ts, counterparty, direction, amount, *rest) in enumerate(rows):
        value_date = rest[0] if rest else DAY
        currency = rest[1] if len(rest) > 1 else "THB"
        full.append(
            (f"t{i}", ts, value_date, "A1", counterparty, currency, direction, amount, "payment", "RTGS")
        )
    return spark.createDataFrame(full, TX)


def snapshot(spark, rows):
    """Rows of (value_date, currency, bucket, cum_net_cashflow)."""
    return spark.createDataFrame(rows, SNAPSHOT)


def dicts(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
