"""Seeded random inputs: the rewrites equal the reference dataflow."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barlake.operators import daily_metrics, daily_metrics_join, upsert

SCHEMA = "ticker string, datetime timestamp, open float, close float"


def _bars(seed: int, n: int):
    rng = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows, used = [], set()
    for _ in range(n):
        ticker = rng.choice(["A", "B", "C", None])
        ts = t0 + timedelta(minutes=rng.randrange(0, 3 * 1440))
        if (ticker, ts) in used:  # bars are unique per (ticker, minute)
            continue
        used.add((ticker, ts))
        price = lambda: None if rng.random() < 0.1 else round(rng.uniform(0, 200), 2)
        rows.append((ticker, ts, price(), price()))
    return rows


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), n=st.integers(1, 120))
def test_single_aggregate_equals_join_shape(spark, seed, n):
    df = spark.createDataFrame(_bars(seed, n), SCHEMA)
    a = {(r.ticker, r.date): (r.daily_returns, r.daily_volatility) for r in daily_metrics(df).collect()}
    b = {(r.ticker, r.date): (r.daily_returns, r.daily_volatility) for r in daily_metrics_join(df).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None and y is None) or x == pytest.approx(y, rel=1e-9, abs=1e-9)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_upsert_twice_equals_once(spark, seed):
    rng = random.Random(seed)
    target = [(rng.randrange(20), rng.randrange(3), rng.random()) for _ in range(30)]
    source = {(rng.randrange(25), rng.randrange(3)): rng.random() for _ in range(20)}
    t = spark.createDataFrame(target, "k long, d long, v double")
    s = spark.createDataFrame([(k, d, v) for (k, d), v in source.items()], "k long, d long, v double")
    once = upsert(t, s, ["k", "d"])
    twice = upsert(once, s, ["k", "d"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), lo=st.integers(1, 20), span=st.integers(0, 10))
def test_lower_bound_pushdown_never_changes_latest_record(spark, seed, lo, span):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from barlake.operators import latest_record

    rng = random.Random(seed)
    rows = [
        (f"K{rng.randrange(6)}", i, None if rng.random() < 0.05 else datetime(2024, 1, rng.randrange(1, 28), rng.randrange(24)))
        for i in range(80)
    ]
    df = spark.createDataFrame(rows, "k string, v int, load_dttm timestamp")
    start, end = f"2024-01-{lo:02d}", f"2024-01-{min(lo + span, 28):02d} 23:59:59"
    pushed = latest_record(df, ["k"], ["load_dttm", "v"], start, end)
    w = Window.partitionBy("k").orderBy(F.col("load_dttm").desc(), F.col("v").desc())
    bounds = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    reference = (
        df.withColumn("rn", F.row_number().over(w)).filter(F.col("load_dttm").between(*bounds)).filter("rn = 1").drop("rn")
    )
    assert sorted(map(tuple, pushed.collect())) == sorted(map(tuple, reference.collect()))

    # And a plain-Python model of D1: newest load per key (nulls last, then v), kept
    # only when its load time lies in the range.
    lo, hi = datetime(2024, 1, lo), datetime(2024, 1, min(lo + span, 28), 23, 59, 59)
    newest = {}
    for k, v, t in rows:
        rank = (t is not None, t or datetime.min, v)
        if k not in newest or rank > newest[k][0]:
            newest[k] = (rank, (k, v, t))
    model = sorted(r for _, r in newest.values() if r[2] is not None and lo <= r[2] <= hi)
    assert sorted(map(tuple, pushed.collect())) == model


def _brute_force_metrics(rows):
    """Direct computation of the definitions, in plain Python (prices as float32)."""
    import math
    import struct
    from collections import defaultdict

    def f32(x):
        return None if x is None else struct.unpack("f", struct.pack("f", x))[0]

    groups = defaultdict(list)
    for ticker, ts, open_, close in rows:
        if ticker is not None and ts is not None:
            groups[(ticker, ts.date())].append((ts, open_, close))
    out = {}
    for key, bars in groups.items():
        bars.sort(key=lambda b: b[0])
        fo, lc = f32(bars[0][1]), f32(bars[-1][2])
        ret = None if fo is None or lc is None or fo == 0 else f32(lc - fo) / fo
        closes = [f32(b[2]) for b in bars if b[2] is not None]
        if closes:
            mean = sum(closes) / len(closes)
            vol = math.sqrt(sum((c - mean) ** 2 for c in closes) / len(bars))
        else:
            vol = None
        out[key] = (ret, vol)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), n=st.integers(1, 150))
def test_daily_metrics_equals_brute_force(spark, seed, n):
    rows = _bars(seed, n)
    got = {(r.ticker, r.date): (r.daily_returns, r.daily_volatility)
           for r in daily_metrics(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = _brute_force_metrics(rows)
    assert got.keys() == want.keys()
    for k in want:
        for x, y in zip(got[k], want[k]):
            assert (x is None and y is None) or x == pytest.approx(y, rel=1e-6, abs=1e-6)


def _merge_model(target, source):
    """MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *, row by row.
    Rows are (k, d, v); keys (k, d). Returns the rows, or None for the error case."""
    from collections import defaultdict

    def key(r):
        return (r[0], r[1])

    def null_key(r):
        return r[0] is None or r[1] is None

    by_key = defaultdict(list)
    for s in source:
        if not null_key(s):
            by_key[key(s)].append(s)
    target_keys = {key(t) for t in target if not null_key(t)}
    if any(len(rows) > 1 and k in target_keys for k, rows in by_key.items()):
        return None
    out = [t if null_key(t) or key(t) not in by_key else by_key[key(t)][0] for t in target]
    out += [s for s in source if null_key(s) or key(s) not in target_keys]
    return sorted(out, key=str)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_upsert_equals_row_by_row_merge(spark, seed):
    from pyspark.errors import PySparkException

    rng = random.Random(seed)

    def row():
        k = None if rng.random() < 0.1 else rng.choice("abcdef")
        return (k, rng.randrange(2), rng.randrange(100))

    target = [row() for _ in range(rng.randrange(0, 25))]
    source = [row() for _ in range(rng.randrange(0, 15))]
    schema = "k string, d int, v int"
    want = _merge_model(target, source)
    merged = upsert(spark.createDataFrame(target, schema), spark.createDataFrame(source, schema), ["k", "d"])
    if want is None:
        with pytest.raises(PySparkException):
            merged.collect()
    else:
        assert sorted(map(tuple, merged.collect()), key=str) == want
