"""The registered queries: each operator and job run over the driver's tables.

Every callable takes (spark, sf_dir) and returns a DataFrame whose columns match
the SQL twin in :mod:`barlake.oracles`. Derived doubles are rounded to 6 places.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import testdata as td
from barlake.functions.columns import cleanse_string, conform_bars_columns, stamp
from barlake.functions.json import parse_json
from barlake.operators import (
    conform_bars,
    conform_profile,
    daily_avg_close,
    daily_metrics,
    daily_metrics_join,
    daily_returns,
    daily_returns_join,
    daily_sse,
    daily_volatility,
    distinct_rows,
    filter_between,
    first_per_group,
    last_per_group,
    latest_record,
    row_number_by,
    upsert,
)
from barlake.plans import (
    bronze_bars_job,
    bronze_info_job,
    gold_metrics_job,
    silver_bars_job,
    silver_profile_job,
)
from barlake.schemas import METRICS_KEYS
from barlake.session import pin_session, scratch_path, shared_dir
from barlake.sinks.append import append_partitioned
from barlake.sources.catalog import BARS_PARTITION, PROFILE_PARTITION, Lake
from barlake.sources.landing import period_start
from barlake.streaming import ingest_landing

Query = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters shared with the SQL oracles.
RANGE_LO, RANGE_HI = "2024-01-10 00:00:00", "2024-01-12 12:00:00"
LATEST_LO, LATEST_HI = "2024-01-29 00:00:00", "2024-01-30 00:00:00"
UPSERT_SPLIT_LO, UPSERT_SPLIT_HI = "2024-01-15", "2024-01-20"
APPEND_SPLIT = "2024-01-16 00:00:00"
NULL_KEY_EVERY = 17
SELECTED_TICKERS = [str(n) for n in range(0, 500, 3)]
NULL_KEY_SPLIT_LO, NULL_KEY_SPLIT_HI = "2024-01-10 00:00:00", "2024-01-20 00:00:00"


def _r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    return td.table(spark, sf_dir, "events")


def _metric_cols(df: DataFrame) -> DataFrame:
    return df.select(
        "ticker", "date", _r6("daily_returns").alias("daily_returns"), _r6("daily_volatility").alias("daily_volatility")
    )


# --- projections, filters, column functions -------------------------------------------


def scan_cast_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.vendor_bars(_events(spark, sf_dir)).select(*conform_bars_columns())


def filter_between_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_between(td.bars(_events(spark, sf_dir)), "datetime", RANGE_LO, RANGE_HI)


def cleanse_string_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    raw = (
        F.when(F.col("event_id") % 13 == 0, F.lit(""))
        .when(F.col("event_id") % 7 == 0, F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")))
        .when(F.col("event_id") % 5 == 0, F.lit("   "))
        .otherwise(F.col("event_type"))
    )
    return e.select("event_id", raw.alias("raw")).select("event_id", "raw", cleanse_string("raw").alias("cleansed"))


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.select("event_id", parse_json("props", "k int").alias("p")).select(
        "event_id", F.col("p").getField("k").alias("k")
    )


def audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(_events(spark, sf_dir).select("event_id", "user_id"), td.LOAD_1, with_date=True)


# --- windows, top-k, latest record -------------------------------------------------------


def _event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", "user_id", "ts", "value", F.to_date("ts").alias("day"))


def row_number_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = row_number_by(_event_days(spark, sf_dir), ["user_id", "day"], ["ts"], "asc")
    return ranked.select("event_id", "user_id", "day", "row_number")


def row_number_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = row_number_by(_event_days(spark, sf_dir), ["user_id", "day"], ["ts"], "desc")
    return ranked.select("event_id", "user_id", "day", "row_number")


def first_record_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_group(_event_days(spark, sf_dir), ["user_id", "day"], ["ts"])


def last_record_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_per_group(_event_days(spark, sf_dir), ["user_id", "day"], ["ts"])


def latest_record_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_record(_events(spark, sf_dir), ["user_id"], ["ts"], time_col="ts")


def latest_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_record(_events(spark, sf_dir), ["user_id"], ["ts"], LATEST_LO, LATEST_HI, time_col="ts")


def distinct_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = td.table(spark, sf_dir, "lineitem")
    days = li.select("l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("ship_date"))
    return distinct_rows(days)


# --- daily metrics -----------------------------------------------------------------------


def _bars_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.bars(_events(spark, sf_dir), td.NULL_CLOSE_EVERY)


def daily_avg_close_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = daily_avg_close(_bars_nulls(spark, sf_dir))
    return out.select("ticker", "date", _r6("avg_close").alias("avg_close"))


def daily_sse_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = daily_sse(_bars_nulls(spark, sf_dir))
    return out.select("ticker", "date", _r6("sum_squared_errors").alias("sum_squared_errors"), "n")


def daily_returns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = daily_returns(_bars_nulls(spark, sf_dir))
    return out.select("ticker", "date", _r6("daily_returns").alias("daily_returns"))


def daily_volatility_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = daily_volatility(_bars_nulls(spark, sf_dir))
    return out.select("ticker", "date", _r6("daily_volatility").alias("daily_volatility"))


def daily_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_cols(daily_metrics(_bars_nulls(spark, sf_dir)))


def daily_returns_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = daily_returns_join(_bars_nulls(spark, sf_dir))
    return out.select("ticker", "date", _r6("daily_returns").alias("daily_returns"))


def daily_metrics_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_cols(daily_metrics_join(_bars_nulls(spark, sf_dir)))


def daily_metrics_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    # Lineitem bars can share a time within a supplier-day: break ties by value.
    return _metric_cols(daily_metrics(td.lineitem_bars(td.table(spark, sf_dir, "lineitem")), tie_break=True))


def monthly_metrics_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    bars = td.lineitem_month_bars(td.table(spark, sf_dir, "lineitem"))
    return _metric_cols(daily_metrics(bars, tie_break=True))


def sql_over_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"bars_{uuid.uuid4().hex[:8]}"
    _bars_nulls(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(
        f"""SELECT ticker, to_date(datetime) AS date, count(*) AS n_bars,
                   count(close) AS n_closes, round(max(close), 6) AS high_close
            FROM {view} GROUP BY ticker, to_date(datetime)"""
    )


# --- upsert and append ---------------------------------------------------------------------


def upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of days 1-20 as the target, days 15-30 with doubled values as the source.

    Both sides and every branch of the merge read the same metrics, so they are
    computed once and checkpointed to the shared folder.
    """
    shared_dir(spark)
    metrics = daily_metrics(_bars_nulls(spark, sf_dir)).checkpoint()
    target = stamp(metrics.filter(F.col("date") <= F.lit(UPSERT_SPLIT_HI).cast("date")), td.LOAD_1)
    source = stamp(
        metrics.filter(F.col("date") >= F.lit(UPSERT_SPLIT_LO).cast("date")).select(
            "ticker", "date", (F.col("daily_returns") * 2).alias("daily_returns"),
            (F.col("daily_volatility") * 2).alias("daily_volatility"),
        ),
        td.LOAD_2,
    )
    merged = upsert(target, source, METRICS_KEYS)
    return merged.select(
        "ticker", "date", _r6("daily_returns").alias("daily_returns"),
        _r6("daily_volatility").alias("daily_volatility"), "load_dttm",
    )


def _keyed_events(events: DataFrame) -> DataFrame:
    # Every NULL_KEY_EVERY-th event has no ticker: such rows can never match (D10).
    ticker = F.when(F.col("event_id") % NULL_KEY_EVERY == 0, F.lit(None).cast("string")).otherwise(
        F.col("user_id").cast("string")
    )
    return events.select(ticker.alias("ticker"), F.col("ts").alias("datetime"), F.col("value").alias("v"))


def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars before day 20 as the target, bars from day 10 with doubled values as
    the source, keyed on (ticker, datetime) with some tickers null on both sides."""
    keyed = _keyed_events(_events(spark, sf_dir))
    target = keyed.filter(F.col("datetime") < F.lit(NULL_KEY_SPLIT_HI).cast("timestamp_ntz"))
    source = keyed.filter(F.col("datetime") >= F.lit(NULL_KEY_SPLIT_LO).cast("timestamp_ntz")).withColumn(
        "v", F.col("v") * 2
    )
    return upsert(target, source, ["ticker", "datetime"])


def _scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    db = f"scratch_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    return f"{db}.{name}", scratch_path(spark, "queries", name)


def append_partitioned_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type", "value")
    name, loc = _scratch_table(spark, "events_history")
    split = F.lit(APPEND_SPLIT).cast("timestamp_ntz")
    append_partitioned(stamp(e.filter(F.col("ts") < split), td.LOAD_1, with_date=True), name, location=loc)
    append_partitioned(stamp(e.filter(F.col("ts") >= split), td.LOAD_2, with_date=True), name, location=loc)
    return spark.table(name)


def append_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).select("event_id", "user_id", "ts", "value", "event_type")
    name, loc = _scratch_table(spark, "events_evolved")
    split = F.lit(APPEND_SPLIT).cast("timestamp_ntz")
    first = e.filter(F.col("ts") < split).drop("event_type")
    second = e.filter(F.col("ts") >= split).drop("value").withColumn("props_len", F.length("event_type"))
    append_partitioned(stamp(first, td.LOAD_1, with_date=True), name, location=loc)
    append_partitioned(stamp(second, td.LOAD_2, with_date=True), name, location=loc)
    return spark.table(name)


def append_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load whose columns are wider (bigint, double) and named in another case."""
    e = _events(spark, sf_dir)
    name, loc = _scratch_table(spark, "events_widened")
    split = F.lit(APPEND_SPLIT).cast("timestamp_ntz")
    first = e.filter(F.col("ts") < split).select(
        F.col("event_id").cast("int").alias("Event_Id"), "user_id", F.col("value").cast("float").alias("value")
    )
    second = e.filter(F.col("ts") >= split).select(
        (F.col("event_id") + 3_000_000_000).alias("EVENT_ID"), "user_id", F.col("value").alias("Value")
    )
    append_partitioned(stamp(first, td.LOAD_1, with_date=True), name, location=loc)
    append_partitioned(stamp(second, td.LOAD_2, with_date=True), name, location=loc)
    return spark.table(name)


# --- conform chains ------------------------------------------------------------------------


def _bronze_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return stamp(td.vendor_bars(e), td.LOAD_1, with_date=True).unionByName(
        stamp(td.corrected_bars(e), td.LOAD_2, with_date=True)
    )


def _bronze_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    customer, nation = td.table(spark, sf_dir, "customer"), td.table(spark, sf_dir, "nation")
    second = td.profile_docs(
        customer.filter(F.col("c_mktsegment") == td.UPDATED_SEGMENT), nation, renamed=True
    )
    return stamp(td.profile_docs(customer, nation), td.LOAD_1, with_date=True).unionByName(
        stamp(second, td.LOAD_2, with_date=True)
    )


def bars_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_bars(_bronze_bars(spark, sf_dir), td.LOAD_3, td.LOAD_1, td.LOAD_3)


def profile_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_profile(_bronze_info(spark, sf_dir), td.LOAD_3, td.LOAD_1, td.LOAD_3)


# --- jobs, end to end in a scratch lake ------------------------------------------------------


def _lake(spark: SparkSession) -> Lake:
    tag = uuid.uuid4().hex[:10]
    dbs = {layer: f"{layer}_{tag}" for layer in ("bronze", "silver", "gold")}
    # Names qualified by the session catalog (DDL-1).
    return Lake(spark, scratch_path(spark, "lake"), dbs, catalog="spark_catalog", temporary=True).create()


def _landing(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, "landing", name)
    df.write.parquet(path)
    return path


def _bars_landings(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    e = _events(spark, sf_dir)
    return _landing(td.vendor_bars(e), "bars_1"), _landing(td.corrected_bars(e), "bars_2")


def bronze_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bar deliveries appended to bronze as two loads."""
    first, second = _bars_landings(spark, sf_dir)
    lake = _lake(spark)
    bronze_bars_job(lake, first, td.LOAD_1)
    bronze_bars_job(lake, second, td.LOAD_2)
    return lake.scan("bronze", "market_data_1m")


def bronze_bars_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON landing, loaded for a ticker list and a one-month period ending at the load time."""
    e = _events(spark, sf_dir)
    path = scratch_path(spark, "landing", "bars_json")
    td.vendor_bars(e).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    since = period_start("1mo", datetime.fromisoformat(td.LOAD_1))
    lake = _lake(spark)
    bronze_bars_job(lake, path, td.LOAD_1, tickers=SELECTED_TICKERS, since=since, fmt="json")
    return lake.scan("bronze", "market_data_1m")


def bronze_bars_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bar landing folder, in at least four files, ingested by the incremental stream with one file per
    micro-batch and one load time for all of them, then read back."""
    path = scratch_path(spark, "landing", "bars_files")
    td.vendor_bars(_events(spark, sf_dir)).repartition(4).write.parquet(path)
    lake = _lake(spark)
    ingest_landing(lake, path, "bars", clock=lambda _batch: td.LOAD_1, max_files_per_trigger=1).awaitTermination()
    return lake.scan("bronze", "market_data_1m")


def sql_over_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over a layer table in the catalog, after two bronze loads."""
    first, second = _bars_landings(spark, sf_dir)
    lake = _lake(spark)
    bronze_bars_job(lake, first, td.LOAD_1)
    bronze_bars_job(lake, second, td.LOAD_2)
    return lake.sql(
        f"""SELECT Ticker AS ticker, load_prdt, count(*) AS n_rows, max(Close) AS max_close,
                   min(Datetime) AS first_bar
            FROM {lake.table("bronze", "market_data_1m")}
            GROUP BY Ticker, load_prdt"""
    )


def _info_landings(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    pin_session(spark)
    customer, nation = td.table(spark, sf_dir, "customer"), td.table(spark, sf_dir, "nation")
    updated = td.profile_docs(customer.filter(F.col("c_mktsegment") == td.UPDATED_SEGMENT), nation, renamed=True)
    return _landing(td.profile_docs(customer, nation), "info_1"), _landing(updated, "info_2")


def bronze_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _info_landings(spark, sf_dir)
    lake = _lake(spark)
    bronze_info_job(lake, first, td.LOAD_1)
    bronze_info_job(lake, second, td.LOAD_2)
    return lake.scan("bronze", "ticker_info")


def silver_bars_job_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load 1 -> silver; load 2 (corrected bars) -> silver: the corrected bars are
    updated and stamped anew, the others keep their first stamp."""
    first, second = _bars_landings(spark, sf_dir)
    lake = _lake(spark)
    bronze_bars_job(lake, first, td.LOAD_1)
    silver_bars_job(lake, td.LOAD_1, td.LOAD_1, td.LOAD_1)
    bronze_bars_job(lake, second, td.LOAD_2)
    silver_bars_job(lake, td.LOAD_2, td.LOAD_2, td.LOAD_3)
    return lake.scan("silver", "ticker_ohlcv_1m").drop(BARS_PARTITION)


def silver_profile_job_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load 1 -> silver; load 2 (renamed automobile customers) -> silver."""
    first, second = _info_landings(spark, sf_dir)
    lake = _lake(spark)
    bronze_info_job(lake, first, td.LOAD_1)
    silver_profile_job(lake, td.LOAD_1, td.LOAD_1, td.LOAD_1)
    bronze_info_job(lake, second, td.LOAD_2)
    silver_profile_job(lake, td.LOAD_2, td.LOAD_2, td.LOAD_3)
    return lake.scan("silver", "ticker_profile").drop(PROFILE_PARTITION)


def gold_metrics_job_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold for days 1-20 after load 1; gold for days 15-30 after the corrected
    load 2 reached silver. Days 15-20 are overwritten with corrected metrics."""
    first, second = _bars_landings(spark, sf_dir)
    lake = _lake(spark)
    bronze_bars_job(lake, first, td.LOAD_1)
    silver_bars_job(lake, td.LOAD_1, td.LOAD_1, td.LOAD_1)
    gold_metrics_job(lake, "2024-01-01 00:00:00", "2024-01-20 23:59:59.999999", td.LOAD_1)
    bronze_bars_job(lake, second, td.LOAD_2)
    silver_bars_job(lake, td.LOAD_2, td.LOAD_2, td.LOAD_2)
    gold_metrics_job(lake, "2024-01-15 00:00:00", "2024-01-30 23:59:59.999999", td.LOAD_3)
    gold = lake.scan("gold", "ticker_daily_metrics")
    return gold.select(
        "ticker",
        "date",
        _r6(F.col("daily_returns").cast("double")).alias("daily_returns"),
        _r6(F.col("daily_volatility").cast("double")).alias("daily_volatility"),
        "load_dttm",
    )


QUERIES: dict[str, Query] = {
    "daily_metrics": daily_metrics_q,
    "scan_cast_bars": scan_cast_bars,
    "filter_between": filter_between_q,
    "cleanse_string": cleanse_string_q,
    "json_extract": json_extract,
    "audit_stamp": audit_stamp,
    "row_number_asc": row_number_asc,
    "row_number_desc": row_number_desc,
    "first_record_per_day": first_record_per_day,
    "last_record_per_day": last_record_per_day,
    "latest_record": latest_record_q,
    "latest_in_range": latest_in_range,
    "distinct_rows": distinct_rows_q,
    "daily_avg_close": daily_avg_close_q,
    "daily_sse": daily_sse_q,
    "daily_returns": daily_returns_q,
    "daily_volatility": daily_volatility_q,
    "daily_returns_join": daily_returns_join_q,
    "daily_metrics_join": daily_metrics_join_q,
    "daily_metrics_lineitem": daily_metrics_lineitem,
    "monthly_metrics_lineitem": monthly_metrics_lineitem,
    "sql_over_view": sql_over_view,
    "sql_over_tables": sql_over_tables,
    "upsert_metrics": upsert_metrics,
    "upsert_null_keys": upsert_null_keys,
    "append_partitioned": append_partitioned_q,
    "append_evolved": append_evolved,
    "append_widened": append_widened,
    "bars_conform": bars_conform,
    "profile_conform": profile_conform,
    "bronze_bars": bronze_bars,
    "bronze_bars_selected": bronze_bars_selected,
    "bronze_bars_stream": bronze_bars_stream,
    "bronze_info": bronze_info,
    "silver_bars_job": silver_bars_job_q,
    "silver_profile_job": silver_profile_job_q,
    "gold_metrics_job": gold_metrics_job_q,
}
