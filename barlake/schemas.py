"""Declared schemas of the five tables and of the narrow profile JSON."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Vendor minute bars as they land (bronze.market_data_1m without the stamps); the
# column names are the vendor's (fixed values, see functions.columns.BAR_COLUMNS).
LANDING_BARS = StructType(
    [
        StructField("Ticker", StringType()),
        StructField("Datetime", TimestampType()),
        StructField("Open", DoubleType()),
        StructField("High", DoubleType()),
        StructField("Low", DoubleType()),
        StructField("Close", DoubleType()),
        StructField("Volume", LongType()),
        StructField("Dividends", DoubleType()),
        StructField("Stock Splits", DoubleType()),
    ]
)

# One raw JSON document per ticker (bronze.ticker_info without the stamps).
LANDING_INFO = StructType(
    [
        StructField("ticker", StringType(), nullable=False),
        StructField("info", StringType()),
    ]
)

AUDIT = [StructField("load_dttm", TimestampType()), StructField("load_prdt", DateType())]

BRONZE_BARS = StructType(LANDING_BARS.fields + AUDIT)
BRONZE_INFO = StructType(LANDING_INFO.fields + AUDIT)

SILVER_BARS = StructType(
    [
        StructField("ticker", StringType()),
        StructField("datetime", TimestampType()),
        StructField("open", FloatType()),
        StructField("high", FloatType()),
        StructField("low", FloatType()),
        StructField("close", FloatType()),
        StructField("volume", FloatType()),
        StructField("dividends", FloatType()),
        StructField("stock_splits", FloatType()),
        StructField("load_dttm", TimestampType()),
    ]
)

# All seven columns the profile job produces (the DDL's two would drop five, D4).
SILVER_PROFILE = StructType(
    [
        StructField("ticker", StringType()),
        StructField("company_name", StringType()),
        StructField("business_summary", StringType()),
        StructField("currency", StringType()),
        StructField("market_cap", FloatType()),
        StructField("industry", StringType()),
        StructField("load_dttm", TimestampType()),
    ]
)

GOLD_METRICS = StructType(
    [
        StructField("ticker", StringType()),
        StructField("date", DateType()),
        StructField("daily_returns", FloatType()),
        StructField("daily_volatility", FloatType()),
        StructField("load_dttm", TimestampType()),
    ]
)

# Profile JSON field -> silver column, and the field's JSON type.
PROFILE_FIELDS = [
    ("longName", "company_name"),
    ("longBusinessSummary", "business_summary"),
    ("currency", "currency"),
    ("marketCap", "market_cap"),
    ("industry", "industry"),
]
_PROFILE_FIELD_TYPES = {"marketCap": LongType()}

# Only the five fields the profile job reads: parsing 144 fields to keep five
# costs CPU per record and gives the same values (schema pruning does not reach
# inside from_json when several fields are read).
PROFILE_JSON = StructType(
    [StructField(field, _PROFILE_FIELD_TYPES.get(field, StringType())) for field, _ in PROFILE_FIELDS]
)

# Business keys.
BARS_KEYS = ["ticker", "datetime"]
PROFILE_KEYS = ["ticker"]
METRICS_KEYS = ["ticker", "date"]
