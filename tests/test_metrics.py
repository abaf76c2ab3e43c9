from datetime import date, datetime, timedelta

import pytest

from barlake.operators import daily_metrics, daily_metrics_join, daily_returns, daily_sse, daily_volatility

SCHEMA = "ticker string, datetime timestamp, open float, close float"
T0 = datetime(2024, 1, 2, 9, 30)


def _f(x):
    return None if x is None else float(x)


def bars(ticker, pairs, start=T0):
    return [(ticker, start + timedelta(minutes=i), _f(o), _f(c)) for i, (o, c) in enumerate(pairs)]


CASES = {
    "plain": ([(100, 101), (101, 103), (103, 102)], 0.02, 0.816497),
    "null_close_inside": ([(100, 101), (101, None), (102, 103)], 0.03, 0.816497),
    "null_last_close": ([(100, 101), (101, None)], None, 0.0),
    "null_first_open": ([(None, 101), (101, 103)], None, 1.0),
    "one_bar": ([(100, 110)], 0.1, 0.0),
    "zero_first_open": ([(0, 1), (1, 3)], None, 1.0),
    "all_closes_null": ([(100, None), (101, None)], None, None),
}


def _approx(x):
    return None if x is None else pytest.approx(x, abs=1e-6)


@pytest.mark.parametrize("shape", [daily_metrics, daily_metrics_join])
@pytest.mark.parametrize("case", list(CASES))
def test_hand_cases(spark, shape, case):
    pairs, ret, vol = CASES[case]
    rows = shape(spark.createDataFrame(bars(case, pairs), SCHEMA)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.ticker, r.date) == (case, date(2024, 1, 2))
    assert r.daily_returns == _approx(ret)
    assert r.daily_volatility == _approx(vol)


def test_null_ticker_has_no_row(spark):
    df = spark.createDataFrame(bars(None, [(1, 2), (2, 3)]) + bars("A", [(1, 2)]), SCHEMA)
    assert [r.ticker for r in daily_metrics(df).collect()] == ["A"]
    assert [r.ticker for r in daily_metrics_join(df).collect()] == ["A"]
    assert [r.ticker for r in daily_returns(df).collect()] == ["A"]


def test_null_ticker_volatility_is_null_not_error(spark):
    df = spark.createDataFrame(bars(None, [(1, 2), (2, 3)]), SCHEMA)
    assert daily_volatility(df).first().daily_volatility is None


def test_two_days_do_not_carry_over(spark):
    day1 = bars("A", [(10, 11), (11, 12)])
    day2 = bars("A", [(20, 22)], start=T0 + timedelta(days=1))
    out = {r.date: r.daily_returns for r in daily_metrics(spark.createDataFrame(day1 + day2, SCHEMA)).collect()}
    assert out == {date(2024, 1, 2): _approx(0.2), date(2024, 1, 3): _approx(0.1)}


def test_sse_counts_rows_with_ticker(spark):
    pairs = [(100, 101), (101, None), (102, 103)]
    r = daily_sse(spark.createDataFrame(bars("A", pairs), SCHEMA)).first()
    assert r.n == 3
    assert r.sum_squared_errors == pytest.approx(2.0)


def test_midnight_bar_is_its_own_day(spark):
    rows = bars("A", [(1, 2)], start=datetime(2024, 1, 2, 23, 59)) + bars("A", [(5, 6)], start=datetime(2024, 1, 3))
    assert daily_metrics(spark.createDataFrame(rows, SCHEMA)).count() == 2


def test_value_rank_keeps_the_order_of_floats(spark):
    """Neighbouring floats of every size get different ranks, in order; null lowest, NaN highest."""
    import random

    import numpy as np
    from pyspark.sql import functions as F

    from barlake.operators.metrics import _value_rank

    r = random.Random(4)
    tiny, most = np.float32(1.4e-45), np.float32(3.4028235e38)
    values = [np.float32(0.0), tiny, most, -tiny, -most, np.float32("inf"), np.float32("-inf"), np.float32(1.0)]
    for _ in range(2_000):
        x = np.array([r.getrandbits(32)], np.uint32).view(np.float32)[0]
        if np.isfinite(x):
            values += [x, np.nextafter(x, np.float32("inf")), np.nextafter(x, np.float32("-inf"))]
    rows = [(None,), (float("nan"),), (-0.0,)] + [(float(v),) for v in values]
    df = spark.createDataFrame(rows, "v float").select("v", _value_rank(F.col("v")).alias("r"))
    got = df.collect()
    finite = sorted({float(x.v): x.r for x in got if x.v is not None and x.v == x.v}.items())
    ranks = [rank for _, rank in finite]
    assert ranks == sorted(set(ranks))
    assert {x.r for x in got if x.v == 0} == {0}
    assert next(x.r for x in got if x.v is None) < ranks[0] and next(x.r for x in got if x.v is not None and x.v != x.v) > ranks[-1]
    assert all(abs(x.r) <= 1 << 38 for x in got)
