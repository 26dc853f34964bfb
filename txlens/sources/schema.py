"""Transaction schema, optional-column resolution and validation."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# The expected raw columns, in the reference's order.
EXPECTED_COLUMNS = [
    "user_id", "transaction_id", "transaction_date",
    "product_category", "product_amount", "transaction_fee",
    "cashback", "loyalty_points", "payment_method",
    "device_type", "location",
]

NUMERIC_COLUMNS = ["product_amount", "transaction_fee", "cashback", "loyalty_points"]
CATEGORICAL_COLUMNS = ["product_category", "payment_method", "device_type", "location"]

TX_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("transaction_id", T.StringType(), True),
    T.StructField("transaction_date", T.StringType(), True),
    T.StructField("product_category", T.StringType(), True),
    T.StructField("product_amount", T.DoubleType(), True),
    T.StructField("transaction_fee", T.DoubleType(), True),
    T.StructField("cashback", T.DoubleType(), True),
    T.StructField("loyalty_points", T.DoubleType(), True),
    T.StructField("payment_method", T.StringType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("location", T.StringType(), True),
])

_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                  T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric_type(dt: T.DataType) -> bool:
    """Numeric in the pandas ``select_dtypes(include=number)`` sense.

    Booleans are *not* numeric (pandas >= 2 dummies are bool and get dropped).
    """
    return isinstance(dt, _NUMERIC_TYPES)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Schema-driven numeric projection list."""
    return [f.name for f in df.schema.fields
            if is_numeric_type(f.dataType) and f.name not in exclude]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def missing_columns(df: DataFrame, expected: list[str] = EXPECTED_COLUMNS) -> list[str]:
    present = set(df.columns)
    return [c for c in expected if c not in present]


def validate_dataframe(df: DataFrame, expected: list[str] = EXPECTED_COLUMNS,
                       mode: str = "strict") -> bool:
    """A4: raise on missing columns (``strict``) or only log them (``warn``).

    Pure plan-time check of the schema; no data is read.
    """
    missing = missing_columns(df, expected)
    if missing:
        if mode == "strict":
            raise ValueError(f"missing columns: {sorted(missing)}")
        if mode != "warn":
            raise ValueError(f"unknown validation mode: {mode}")
        log.warning("missing columns: %s", sorted(missing))
        return False
    return True


def has(df: DataFrame, *cols: str) -> bool:
    """Optional-column plan (B16): true when every column exists."""
    present = set(df.columns)
    return all(c in present for c in cols)
