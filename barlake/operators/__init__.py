"""DataFrame operators: ranking, latest record, daily metrics, upsert, relational."""

from barlake.operators.conform import conform_bars, conform_profile
from barlake.operators.metrics import (
    daily_avg_close,
    daily_metrics,
    daily_metrics_join,
    daily_returns,
    daily_returns_join,
    daily_sse,
    daily_volatility,
    join_back,
    with_trading_date,
)
from barlake.operators.ranking import (
    first_per_group,
    last_per_group,
    latest_record,
    row_number_by,
)
from barlake.operators.relational import distinct_rows, filter_between
from barlake.operators.upsert import upsert

__all__ = [
    "conform_bars",
    "conform_profile",
    "daily_avg_close",
    "daily_metrics",
    "daily_metrics_join",
    "daily_returns",
    "daily_returns_join",
    "daily_sse",
    "daily_volatility",
    "distinct_rows",
    "filter_between",
    "first_per_group",
    "join_back",
    "last_per_group",
    "latest_record",
    "row_number_by",
    "upsert",
    "with_trading_date",
]
