"""Column expressions: string cleansing, audit stamps, the bar conform casts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StringType, TimestampType


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cleanse_string(c: Column | str) -> Column:
    """Trimmed value; blank or null becomes null (CMP-1).

    ``trim`` removes spaces only, as in SQL.
    """
    return F.nullif(F.trim(_as_col(c)), F.lit(""))


def to_float32(c: Column | str) -> Column:
    """Narrow to FLOAT, the storage type of prices, volume and metrics (D12)."""
    return _as_col(c).cast(FloatType())


def audit_columns(load_dttm: datetime | str) -> tuple[Column, Column]:
    """(load_dttm, load_prdt) literals for one batch.

    The date derives from the one timestamp (D13), so a batch at midnight cannot
    get a time from one day and a date from the next. The value is a job argument
    so tests can pin it.
    """
    ts = F.lit(load_dttm).cast(TimestampType())
    return ts, F.to_date(ts)


def stamp(df: DataFrame, load_dttm: datetime | str, with_date: bool = False) -> DataFrame:
    """Add the batch audit columns (PRJ-8): load_dttm, and load_prdt for bronze."""
    ts, day = audit_columns(load_dttm)
    out = df.withColumn("load_dttm", ts)
    return out.withColumn("load_prdt", day) if with_date else out


# Vendor bar column -> silver column, in table order.
BAR_COLUMNS = [
    ("Ticker", "ticker"),
    ("Datetime", "datetime"),
    ("Open", "open"),
    ("High", "high"),
    ("Low", "low"),
    ("Close", "close"),
    ("Volume", "volume"),
    ("Dividends", "dividends"),
    ("Stock Splits", "stock_splits"),
]


def conform_bars_columns() -> list[Column]:
    """Vendor bar columns renamed to snake case and cast (PRJ-1, PRJ-3, PRJ-4):
    the ticker stays a string, the bar time a timestamp, every number is FLOAT."""
    casts = {"ticker": StringType(), "datetime": TimestampType()}
    return [
        F.col(f"`{vendor}`").cast(casts.get(name, FloatType())).alias(name) for vendor, name in BAR_COLUMNS
    ]

