"""Daily returns and daily volatility per ticker.

The production path (:func:`daily_metrics`) is one ``groupBy(ticker, date)``: one
shuffle with map-side partial aggregation, so a ticker-day holding a third of all
bars still shuffles one partial row per map task. The join-shaped operators keep
the first/last, aggregate join-back and result-join forms as separate building
blocks; they compute the same numbers.

Definitions (bars ordered by ``datetime`` within a ticker-day):

* daily return = (close of the last bar - open of the first bar) / open of the
  first bar; null when either value is null at its extreme bar (D18) or the open
  is zero (D6).
* daily volatility = sqrt(sum over bars of (close - mean close)^2 / number of
  bars), nulls in ``close`` included in the count (D5). Since the sum of squared
  deviations equals ``var_pop(close) * count(close)``, it is a single aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.operators.ranking import first_per_group, last_per_group
from barlake.operators.skew import BROADCAST_KEYS, PART, ROWS_PER_PART, any_null, spread
from barlake.session import shared_dir

DAY_KEYS = ["ticker", "date"]


def with_trading_date(bars: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Add ``date`` = calendar day of the bar in the session zone (FN-1, D14)."""
    return bars.withColumn("date", F.to_date(F.col(time_col)))


def _keyed_day_groups(bars: DataFrame, time_col: str, *aggs: Column) -> DataFrame:
    """``aggs`` per (ticker, date), plus ``_n`` = count(ticker).

    A null ticker or bar time never survives the reference's inner join of first
    and last bars, so such groups make no row. They are dropped after the
    aggregation, by their counts: a row filter would be pushed below the bar
    projection and, for a computed bar time, evaluate it twice per row.
    """
    days = with_trading_date(bars, time_col)
    grouped = days.groupBy(*DAY_KEYS).agg(
        *aggs, F.count("ticker").alias("_n"), F.count(time_col).alias("_n_timed")
    )
    return grouped.filter((F.col("_n") > 0) & (F.col("_n_timed") > 0))


def _return(first_open: Column, last_close: Column) -> Column:
    # close - open is a FLOAT subtraction; the division is DOUBLE (D12).
    return F.try_divide((last_close - first_open).cast("double"), first_open.cast("double"))


def _volatility(sse: Column, n: Column) -> Column:
    return F.sqrt(F.try_divide(sse, n))


def _sse(close: Column) -> Column:
    return F.var_pop(close) * F.count(close)


def daily_metrics(bars: DataFrame, time_col: str = "datetime", tie_break: bool = False) -> DataFrame:
    """(ticker, date, daily_returns, daily_volatility) in one aggregate (CMP-4).

    Bars with a null ticker or time have no row (see ``_keyed_day_groups``). Bars sharing
    the extreme time are picked arbitrarily, as by the reference's row number (D2); with
    ``tie_break`` the result depends on values only: time and value are packed into one number
    that keeps their order, so ties break inside the one aggregate (see ``_tied_ends``).
    """
    agg = _keyed_day_groups(bars, time_col, *_ends(time_col, tie_break), _sse(F.col("close")).alias("_sse"))
    return agg.select(
        *DAY_KEYS,
        _return(F.col("_first_open"), F.col("_last_close")).alias("daily_returns"),
        _volatility(F.col("_sse"), F.col("_n")).alias("daily_volatility"),
    )


def _value_rank(value: Column) -> Column:
    """A whole number in the order of a FLOAT column's values (null lowest, NaN highest), below 2^38 in size.

    Neighbouring floats differ in their logarithm by 2^-25 at least, so 2^28 times the logarithm
    keeps them apart and in order; an offset beyond its range makes room for the sign.
    """
    x = value.cast("float").cast("double")
    size = F.floor(F.ln(F.abs(x)) * float(1 << 28)) + F.lit(1 << 36)
    most = F.lit((1 << 37) + 1)
    return (
        F.when(x.isNull(), F.lit(-(1 << 38)))
        .when(F.isnan(x), most + 1)
        .when(F.abs(x) == float("inf"), F.signum(x).cast("long") * most)
        .when(x == 0.0, F.lit(0))
        .otherwise(F.signum(x).cast("long") * size.cast("long"))
    )


def _time_then_value(time_col: str, value_col: str) -> Column:
    """One number ordered by time, then by value: an aggregate on it breaks ties in a primitive buffer."""
    micros = F.unix_micros(F.col(time_col).cast("timestamp")).cast("decimal(20,0)")
    return micros * F.lit(1 << 40).cast("decimal(14,0)") + _value_rank(F.col(value_col)).cast("decimal(13,0)")


def _tied_ends(time_col: str) -> list[Column]:
    """First open and last close of bars that may share a time: the smallest open (nulls lowest)
    of the first time, the largest close of the last."""
    return [
        F.min_by("open", _time_then_value(time_col, "open")).alias("_first_open"),
        F.max_by("close", _time_then_value(time_col, "close")).alias("_last_close"),
    ]


def _ends(time_col: str, tie_break: bool) -> list[Column]:
    if tie_break:
        return _tied_ends(time_col)
    return [F.min_by("open", time_col).alias("_first_open"), F.max_by("close", time_col).alias("_last_close")]


def daily_returns(bars: DataFrame, time_col: str = "datetime", tie_break: bool = False) -> DataFrame:
    """(ticker, date, daily_returns) (CMP-2) via ``min_by``/``max_by``."""
    agg = _keyed_day_groups(bars, time_col, *_ends(time_col, tie_break))
    return agg.select(*DAY_KEYS, _return(F.col("_first_open"), F.col("_last_close")).alias("daily_returns"))


def daily_volatility(bars: DataFrame, time_col: str = "datetime") -> DataFrame:
    """(ticker, date, daily_volatility) (CMP-3).

    Groups with a null ticker count zero tickers and get a null volatility, as in
    the reference's non-ANSI division.
    """
    days = with_trading_date(bars, time_col)
    agg = days.groupBy(*DAY_KEYS).agg(_sse(F.col("close")).alias("_sse"), F.count("ticker").alias("_n"))
    return agg.select(*DAY_KEYS, _volatility(F.col("_sse"), F.col("_n")).alias("daily_volatility"))


def daily_avg_close(bars: DataFrame, time_col: str = "datetime") -> DataFrame:
    """(ticker, date, avg_close) (AGG-1)."""
    days = with_trading_date(bars, time_col)
    return days.groupBy(*DAY_KEYS).agg(F.avg("close").alias("avg_close"))


def join_back(
    rows: DataFrame, groups: DataFrame, keys: list[str], count_col: str, spread_by: Column, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """Attach per-group aggregates to each row with a left equi-join (JN-2); adds ``_part``.

    ``groups`` has one row per key and the key's number of rows in ``count_col``. A key of more
    than ``rows_per_part`` rows is cut into parts by the hash of ``spread_by`` and its group row is repeated once per
    part, so a task of the join gets about ``rows_per_part`` rows of one key however large it grows; all
    other keys stay in one part. Rows with a null key match nothing and are spread as well. Adaptive splitting would not do: it
    needs a shuffle right below both sides, and the aggregate side ends in an aggregate.

    The groups are checkpointed while the query is built, to learn which keys are hot. Their list is broadcast up to
    ``BROADCAST_KEYS`` keys; a longer one is joined by shuffle, which adaptive execution can split.
    """
    shared_dir(groups.sparkSession)
    groups = groups.checkpoint()
    parts = F.ceil(F.col(count_col) / rows_per_part).cast("int")
    hot = groups.where(F.col(count_col) > rows_per_part).select(*keys, parts.alias("_parts"))
    n_hot = hot.count()
    null_parts = F.when(any_null(keys), F.lit(1024)).otherwise(F.lit(1))
    if n_hot:
        rows = rows.join(F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot, on=keys, how="left")
        groups = groups.withColumn(PART, F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    else:
        rows = rows.withColumn("_parts", F.lit(None).cast("int"))
        groups = groups.withColumn(PART, F.lit(0))
    dealt = rows.withColumn(PART, spread(spread_by, F.coalesce("_parts", null_parts))).drop("_parts")
    return dealt.join(groups, on=[*keys, PART], how="left")


def daily_sse(bars: DataFrame, time_col: str = "datetime", rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """(ticker, date, sum_squared_errors, n) by joining each bar to its day's mean
    close (AGG-1..3, JN-2, FN-2). ``n`` counts bars with a non-null ticker (AGG-3).

    The sums are taken per part of the join first, then per day."""
    days = with_trading_date(bars, time_col)
    means = days.groupBy(*DAY_KEYS).agg(F.avg("close").alias("_avg_close"), F.count(F.lit(1)).alias("_bars"))
    joined = join_back(days, means, DAY_KEYS, "_bars", F.struct(time_col, "open", "close"), rows_per_part)
    squared = joined.withColumn("_sq", F.pow(F.col("close") - F.col("_avg_close"), 2))
    parts = squared.groupBy(*DAY_KEYS, PART).agg(F.sum("_sq").alias("_sq"), F.count("ticker").alias("_n"))
    return parts.groupBy(*DAY_KEYS).agg(F.sum("_sq").alias("sum_squared_errors"), F.sum("_n").alias("n"))


def daily_returns_join(bars: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Daily returns as first-of-day joined to last-of-day (TOP-1, TOP-2, JN-1).

    Both sides come out of a window partitioned and sorted on (ticker, date), so
    the inner join needs no further shuffle.
    """
    days = with_trading_date(bars, time_col)
    first = first_per_group(days, DAY_KEYS, [time_col]).select(*DAY_KEYS, F.col("open").alias("_first_open"))
    last = last_per_group(days, DAY_KEYS, [time_col]).select(*DAY_KEYS, F.col("close").alias("_last_close"))
    joined = last.join(first, on=DAY_KEYS, how="inner")
    return joined.select(*DAY_KEYS, _return(F.col("_first_open"), F.col("_last_close")).alias("daily_returns"))


def daily_metrics_join(bars: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Returns left-joined to volatility on (ticker, date) (JN-3).

    Null tickers fall out at the inner join of :func:`daily_returns_join`.
    """
    returns = daily_returns_join(bars, time_col)
    vol = daily_volatility(bars, time_col)
    return returns.join(vol, on=DAY_KEYS, how="left")
