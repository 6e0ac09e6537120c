"""Input table schemas and conformance of a frame to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TEXT, _DATE, _TIME, _REAL, _INT = StringType(), DateType(), TimestampType(), DoubleType(), IntegerType()


# Table names, column names and types are the data contract.


def _columns(**types: DataType) -> StructType:
    return StructType([StructField(name, kind, nullable=False) for name, kind in types.items()])


TRANSACTIONS = _columns(
    tx_id=_TEXT,
    event_ts=_TIME,
    value_date=_DATE,
    account_id=_TEXT,
    counterparty_id=_TEXT,
    currency=_TEXT,
    direction=_TEXT,
    amount=_REAL,
    product=_TEXT,
    channel=_TEXT,
)

BALANCES = _columns(
    as_of_date=_DATE,
    account_id=_TEXT,
    currency=_TEXT,
    balance=_REAL,
    customer_segment=_TEXT,
)

CASHFLOWS = _columns(
    cf_id=_TEXT,
    as_of_date=_DATE,
    maturity_date=_DATE,
    counterparty_id=_TEXT,
    currency=_TEXT,
    direction=_TEXT,
    amount=_REAL,
    source=_TEXT,
)

# haircut_pct is a fraction (0.05 means five percent), eligible_lcr is 0 or 1.
COLLATERAL = _columns(
    as_of_date=_DATE,
    collateral_id=_TEXT,
    counterparty_id=_TEXT,
    currency=_TEXT,
    market_value=_REAL,
    haircut_pct=_REAL,
    eligible_lcr=_INT,
)

LIMITS = _columns(
    as_of_date=_DATE,
    counterparty_id=_TEXT,
    limit_type=_TEXT,
    limit_amount=_REAL,
    currency=_TEXT,
)

# table name -> (schema, partition column)
INPUT_TABLES = {
    "transactions": (TRANSACTIONS, "value_date"),
    "balances": (BALANCES, "as_of_date"),
    "cashflows": (CASHFLOWS, "as_of_date"),
    "collateral": (COLLATERAL, "as_of_date"),
    "limits": (LIMITS, "as_of_date"),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the columns of `schema` in order, cast to their types.

    Nullability is left alone: it does not survive a Parquet round trip, and the
    quality checks report NULLs as data.
    """
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])
