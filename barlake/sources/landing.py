"""Landing-zone reads that replace the vendor API fetch (SRC-1, SRC-2).

The reference pulls one ticker at a time on the driver and concatenates pandas
frames; here the vendor's files sit in a landing folder and one distributed scan
with a declared schema reads them all. The ticker list and the period bound are
predicates that reach the scan.
"""

from __future__ import annotations

import calendar
import re
from collections.abc import Iterable
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlake.operators.relational import typed_bound
from barlake.schemas import LANDING_BARS, LANDING_INFO


# Period words accepted for the bar download window (vendor style), fixed values:
# <n>d days, <n>wk weeks, <n>mo calendar months, <n>y calendar years, ytd, max.
_PERIOD = re.compile(r"^(\d+)(d|wk|mo|y)$")


def period_start(period: str, as_of: datetime) -> datetime | None:
    """Earliest bar time of a download ``period`` ending at ``as_of``; None for max."""
    if period == "max":
        return None
    if period == "ytd":
        return datetime(as_of.year, 1, 1)
    m = _PERIOD.match(period)
    if m is None:
        raise ValueError(f"unknown period {period!r}")
    n, unit = int(m.group(1)), m.group(2)
    if unit in ("d", "wk"):
        return as_of - timedelta(days=n * (7 if unit == "wk" else 1))
    months = as_of.year * 12 + as_of.month - 1 - n * (12 if unit == "y" else 1)
    year, month = months // 12, months % 12 + 1
    # The same day of the earlier month, or its last day where it is shorter.
    return as_of.replace(year=year, month=month, day=min(as_of.day, calendar.monthrange(year, month)[1]))


def read_landing(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Read landing files of one format with a declared schema (no inference).

    ``options`` go to the reader as they are (e.g. a ``timestampFormat`` for text
    files); CSV files are read with a header line unless told otherwise.
    """
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load(path)


def read_landing_bars(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    tickers: Iterable[str] | None = None,
    since: Any = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Minute bars for ``tickers`` (all when None) at or after ``since``."""
    df = read_landing(spark, path, LANDING_BARS, fmt, options)
    if tickers is not None:
        df = df.filter(F.col("Ticker").isin(list(tickers)))
    if since is not None:
        df = df.filter(F.col("Datetime") >= typed_bound(df, "Datetime", since))
    return df


def read_landing_info(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    tickers: Iterable[str] | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One raw JSON document per ticker; ``info`` stays an unparsed string."""
    df = read_landing(spark, path, LANDING_INFO, fmt, options)
    if tickers is not None:
        df = df.filter(F.col("ticker").isin(list(tickers)))
    return df
