"""Bronze, silver and gold jobs (JOB-1..5).

Each job reads, transforms, stages its result once in the shared folder (the
merge reads it several times) and merges it into the target table. Range arguments are required (D7):
a missing bound is an error, not an empty run.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.columns import stamp, to_float32
from barlake.operators.conform import conform_bars, conform_profile
from barlake.operators.metrics import daily_metrics
from barlake.operators.relational import filter_between, typed_bound
from barlake.operators.skew import planned_bytes
from barlake.schemas import BARS_KEYS, METRICS_KEYS, PROFILE_KEYS
from barlake.sinks.append import append_partitioned
from barlake.sinks.tables import folder_bytes, overwrite_table, staged, upsert_table
from barlake.sources.catalog import (
    BARS_BRONZE,
    BARS_PARTITION,
    BARS_SILVER,
    BUCKET_BYTES,
    INFO_BRONZE,
    METRICS_GOLD,
    METRICS_PARTITION,
    PROFILE_PARTITION,
    PROFILE_SILVER,
    Lake,
    bucket_count,
    profile_bucket,
)
from barlake.sources.landing import read_landing_bars, read_landing_info

log = logging.getLogger(__name__)


def _require_range(start: Any, end: Any) -> None:
    if start is None or end is None:
        raise ValueError("start and end are both required")


def bronze_bars_job(
    lake: Lake,
    landing: str,
    load_dttm: datetime | str,
    tickers: Iterable[str] | None = None,
    since: Any = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> None:
    """Landing minute bars -> stamped append to bronze.market_data_1m."""
    bars = read_landing_bars(lake.spark, landing, fmt, tickers, since, options)
    append_partitioned(
        stamp(bars, load_dttm, with_date=True),
        lake.table("bronze", BARS_BRONZE),
        "load_prdt",
        lake.location("bronze", BARS_BRONZE),
    )
    log.info("appended bars to %s", lake.table("bronze", BARS_BRONZE))


def bronze_info_job(
    lake: Lake,
    landing: str,
    load_dttm: datetime | str,
    tickers: Iterable[str] | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> None:
    """Landing JSON documents -> stamped append to bronze.ticker_info."""
    info = read_landing_info(lake.spark, landing, fmt, tickers, options)
    append_partitioned(
        stamp(info, load_dttm, with_date=True),
        lake.table("bronze", INFO_BRONZE),
        "load_prdt",
        lake.location("bronze", INFO_BRONZE),
    )


def silver_bars_job(lake: Lake, start: Any, end: Any, load_dttm: datetime | str) -> None:
    """Latest load per (ticker, minute) with load time in [start, end] -> upsert
    into silver.ticker_ohlcv_1m, rewriting only the days the load touches."""
    _require_range(start, end)
    conformed = conform_bars(lake.scan("bronze", BARS_BRONZE), load_dttm, start, end)
    with staged(conformed.withColumn(BARS_PARTITION, F.to_date("datetime")), "silver_bars") as source:
        upsert_table(
            lake.table("silver", BARS_SILVER), source, BARS_KEYS, partition_col=BARS_PARTITION, stage_source=False
        )


def profile_buckets(lake: Lake) -> int:
    """The number of ticker buckets of the stored profile table, from its partition names."""
    table = lake.table("silver", PROFILE_SILVER)
    names = [r["partition"] for r in lake.spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return bucket_count([int(n.split("=")[1]) for n in names if not n.endswith("__HIVE_DEFAULT_PARTITION__")])


def fit_profile_buckets(lake: Lake, added_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The number of buckets, doubled until one holds about ``bucket_bytes`` at most.

    When it grows, the table is dealt anew once; the cost of that is spread over the growth, which
    at least doubled the table. The whole table is staged before it is overwritten.
    """
    table = lake.table("silver", PROFILE_SILVER)
    stored = buckets = profile_buckets(lake)
    size = added_bytes + folder_bytes(lake.spark, lake.location("silver", PROFILE_SILVER))
    while size > bucket_bytes * buckets:
        buckets *= 2
    if buckets > stored:
        rows = lake.spark.table(table).withColumn(PROFILE_PARTITION, profile_bucket(buckets))
        with staged(rows, "profile_buckets", keep_on_error=True) as dealt:
            overwrite_table(table, dealt.hint("rebalance", PROFILE_PARTITION))
    return buckets


def silver_profile_job(
    lake: Lake, start: Any, end: Any, load_dttm: datetime | str, bucket_bytes: int = BUCKET_BYTES
) -> None:
    """Latest JSON per ticker with load time in [start, end] -> parsed profile ->
    upsert into silver.ticker_profile, rewriting only the ticker buckets of the load."""
    _require_range(start, end)
    source = conform_profile(lake.scan("bronze", INFO_BRONZE), load_dttm, start, end)
    with staged(source, "silver_profile") as rows:
        buckets = fit_profile_buckets(lake, planned_bytes(rows), bucket_bytes)
        rows = rows.withColumn(PROFILE_PARTITION, profile_bucket(buckets))
        upsert_table(lake.table("silver", PROFILE_SILVER), rows, PROFILE_KEYS, PROFILE_PARTITION, stage_source=False)


def gold_metrics_frame(bars: DataFrame, start: Any, end: Any, load_dttm: datetime | str) -> DataFrame:
    """Daily metrics of bars with ``datetime`` in [start, end], as stored in gold.

    A range that cuts a day gives that day partial metrics, which then replace the
    stored full-day row (D9): pass whole days.
    """
    _require_range(start, end)
    metrics = daily_metrics(filter_between(bars, "datetime", start, end))
    out = metrics.select(
        "ticker",
        "date",
        to_float32("daily_returns").alias("daily_returns"),
        to_float32("daily_volatility").alias("daily_volatility"),
    )
    return stamp(out, load_dttm)


def _day_range(df: DataFrame, start: Any, end: Any) -> tuple[Column, Column]:
    lo, hi = typed_bound(df, "datetime", start), typed_bound(df, "datetime", end)
    return F.to_date(lo), F.to_date(hi)


def gold_source(lake: Lake, start: Any, end: Any) -> DataFrame:
    """Silver bars of the days in [start, end]: the bar-date predicate prunes
    partitions, the time predicate (applied by the metrics frame) trims the ends."""
    silver = lake.scan("silver", BARS_SILVER)
    first_day, last_day = _day_range(silver, start, end)
    return silver.filter(F.col(BARS_PARTITION).between(first_day, last_day))


def gold_metrics_job(lake: Lake, start: Any, end: Any, load_dttm: datetime | str) -> None:
    """silver.ticker_ohlcv_1m in [start, end] -> daily metrics -> upsert into
    gold.ticker_daily_metrics. Silver is read for the days of the range only; gold is read
    and written for the days that have metrics."""
    _require_range(start, end)
    source = gold_source(lake, start, end)
    frame = gold_metrics_frame(source, start, end, load_dttm)
    upsert_table(lake.table("gold", METRICS_GOLD), frame, METRICS_KEYS, METRICS_PARTITION)
