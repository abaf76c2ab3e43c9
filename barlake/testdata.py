"""How the driver's tables stand in for bars, vendor files and profile documents.

``events`` rows become minute bars (user = ticker, ts = bar time, value = price);
``customer`` joined to ``nation`` becomes one JSON profile per customer; ``lineitem``
becomes a larger bar set for the benchmark. Every mapping is a projection or join
that Spark runs over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values shared with the SQL oracles.
LOAD_1 = "2024-02-01 06:30:00"
LOAD_2 = "2024-02-02 07:45:00"
LOAD_3 = "2024-02-03 09:00:00"
NULL_CLOSE_EVERY = 11  # every 11th event's close is null (nulls inside a day, D5)
CORRECTED_TYPE = "click"  # the second bar load re-delivers these bars corrected
CORRECTION = 0.25
UPDATED_SEGMENT = "AUTOMOBILE"  # the second profile load renames these customers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars(events: DataFrame, null_close_every: int | None = None) -> DataFrame:
    """(ticker, datetime, open, close): open = close = value as FLOAT, with every
    ``null_close_every``-th close set null when given."""
    price = F.col("value").cast("float")
    close = price
    if null_close_every:
        close = F.when(F.col("event_id") % null_close_every == 0, F.lit(None).cast("float")).otherwise(price)
    return events.select(
        F.col("user_id").cast("string").alias("ticker"),
        F.col("ts").alias("datetime"),
        price.alias("open"),
        close.alias("close"),
    )


def _seconds(n: Column) -> Column:
    # Interval arithmetic keeps the zone-free timestamp type (no per-row zone work).
    return F.expr("INTERVAL '1' SECOND") * n


def _month_start(c: str) -> Column:
    return F.trunc(F.col(c).cast("date"), "month").cast("timestamp_ntz")


def lineitem_bars(lineitem: DataFrame) -> DataFrame:
    """Bars per supplier: ship date plus a minute offset from order and line number;
    open = extended price, close = discounted price."""
    offset = (F.col("l_orderkey") % 1440) * 60 + F.col("l_linenumber")
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        (F.col("l_shipdate") + _seconds(offset)).alias("datetime"),
        F.col("l_extendedprice").cast("float").alias("open"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("float").alias("close"),
    )


def lineitem_month_bars(lineitem: DataFrame) -> DataFrame:
    """Lineitem bars with one trading "day" per supplier-month: every bar of a
    month is placed on the month's first day, in ship-date order (day of month,
    then a minute and second offset from order and line number)."""
    offset = (
        (F.dayofmonth("l_shipdate") - 1) * 2760 + (F.col("l_orderkey") % 46) * 60 + F.col("l_linenumber")
    )
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        (_month_start("l_shipdate") + _seconds(offset)).alias("datetime"),
        F.col("l_extendedprice").cast("float").alias("open"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("float").alias("close"),
    )


def vendor_bars(events: DataFrame) -> DataFrame:
    """Events as the vendor's minute-bar files (landing schema)."""
    return events.select(
        F.col("user_id").cast("string").alias("Ticker"),
        F.col("ts").cast("timestamp").alias("Datetime"),
        F.col("value").alias("Open"),
        (F.col("value") + 1).alias("High"),
        (F.col("value") - 1).alias("Low"),
        F.col("value").alias("Close"),
        (F.col("event_id") * 100).alias("Volume"),
        F.when(F.col("event_type") == "purchase", F.lit(0.5)).otherwise(F.lit(0.0)).alias("Dividends"),
        F.lit(0.0).alias("Stock Splits"),
    )


def corrected_bars(events: DataFrame) -> DataFrame:
    """A second delivery: the bars of one event type again, close corrected."""
    again = vendor_bars(events.filter(F.col("event_type") == CORRECTED_TYPE))
    return again.withColumn("Close", F.col("Close") + F.lit(CORRECTION))


def profile_docs(customer: DataFrame, nation: DataFrame, renamed: bool = False) -> DataFrame:
    """(ticker, info): one JSON document per customer, encoded by ``to_json`` (FN-8).

    The ticker is padded with spaces (trimmed by the cleanse); the summary is
    padded; building-segment industries are blank (-> null); household ones are a
    bare number (kept as its text); machinery market caps are text (-> null).
    With ``renamed`` the automobile customers' names are upper-cased.
    """
    seg = F.col("c_mktsegment")
    name = F.upper("c_name") if renamed else F.col("c_name")
    name = F.when(seg == UPDATED_SEGMENT, name).otherwise(F.col("c_name"))
    cap = F.col("c_custkey") * 1000003

    def doc(market_cap: Column, industry: Column) -> Column:
        fields = F.struct(
            name.alias("longName"),
            F.concat(F.lit("  "), seg, F.lit(" segment customer ")).alias("longBusinessSummary"),
            F.col("n_name").alias("currency"),
            market_cap.alias("marketCap"),
            industry.alias("industry"),
        )
        return F.to_json(fields, {"ignoreNullFields": "false"})

    encoded = (
        F.when(seg == "MACHINERY", doc(F.lit("n/a"), seg))
        .when(seg == "BUILDING", doc(cap, F.lit("   ")))
        .when(seg == "HOUSEHOLD", doc(cap, F.lit(42)))
        .otherwise(doc(cap, seg))
    )
    joined = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")
    ticker = F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" "))
    return joined.select(ticker.alias("ticker"), encoded.alias("info"))
