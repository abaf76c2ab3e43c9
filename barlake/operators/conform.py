"""Bronze to silver conform chains (CMP-5, CMP-6)."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.columns import conform_bars_columns, stamp
from barlake.functions.json import parse_profile, profile_columns
from barlake.operators.ranking import latest_record


def conform_bars(
    bronze: DataFrame,
    load_dttm: datetime | str,
    start: Any = None,
    end: Any = None,
    dedupe: bool = False,
) -> DataFrame:
    """Latest load per (Ticker, Datetime), renamed and cast, stamped.

    The whole-row distinct of the reference is redundant here: both key columns
    survive the (injective) casts, so rank-1 rows are already unique. ``dedupe``
    keeps it for callers that project the keys away.
    """
    latest = latest_record(
        bronze, ["Ticker", "Datetime"], ["load_dttm"], start, end, date_partition_col=_part(bronze)
    )
    out = latest.select(*conform_bars_columns())
    if dedupe:
        out = out.distinct()
    return stamp(out, load_dttm)


def conform_profile(
    bronze_info: DataFrame,
    load_dttm: datetime | str,
    start: Any = None,
    end: Any = None,
) -> DataFrame:
    """Latest JSON document per ticker, parsed with the narrow schema, cleansed,
    deduplicated, stamped. Trimming can merge two raw tickers into one (D11); the
    distinct collapses identical results and the upsert rejects differing ones
    that hit an existing row."""
    latest = latest_record(
        bronze_info, ["ticker"], ["load_dttm"], start, end, date_partition_col=_part(bronze_info)
    )
    parsed = latest.select(F.col("ticker"), parse_profile("info").alias("parsed_info"))
    out = parsed.select(*profile_columns()).distinct()
    return stamp(out, load_dttm)


def _part(df: DataFrame) -> str | None:
    return "load_prdt" if "load_prdt" in df.columns else None
