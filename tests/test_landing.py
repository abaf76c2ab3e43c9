import pytest
from pyspark.sql import functions as F

from barlake import testdata as td
from barlake.session import scratch_path
from barlake.sources import read_landing_bars, read_landing_info

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_landing_bars_formats(spark, fmt):
    events = td.table(spark, SF, "events")
    bars = td.vendor_bars(events)
    path = scratch_path(spark, "landing-" + fmt)
    micros = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    writer = bars.write.format(fmt).options(**micros)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
    got = read_landing_bars(spark, path, fmt, options=micros if fmt != "parquet" else None)
    assert got.schema.names[-1] == "Stock Splits"
    assert got.exceptAll(bars).count() == 0 and bars.exceptAll(got).count() == 0


def test_tickers_and_since_reach_the_scan(spark):
    path = scratch_path(spark, "landing-filter")
    td.vendor_bars(td.table(spark, SF, "events")).write.parquet(path)
    got = read_landing_bars(spark, path, tickers=["8", "46"], since="2024-01-15 00:00:00")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "In(Ticker, [46,8])" in plan and "GreaterThanOrEqual(Datetime," in plan
    rows = got.collect()
    assert rows and all(r.Ticker in ("8", "46") and r.Datetime.day >= 15 for r in rows)


def test_landing_info_keeps_raw_json(spark):
    path = scratch_path(spark, "landing-info")
    docs = td.profile_docs(td.table(spark, SF, "customer"), td.table(spark, SF, "nation"))
    docs.write.json(path)
    got = read_landing_info(spark, path, "json")
    assert got.count() == docs.count()
    assert got.filter(F.col("info").startswith('{"longName":')).count() == docs.count()


def test_period_start():
    from datetime import datetime

    from barlake.sources.landing import period_start

    now = datetime(2024, 3, 10, 12, 0)
    assert period_start("5d", now) == datetime(2024, 3, 5, 12, 0)
    assert period_start("1wk", now) == datetime(2024, 3, 3, 12, 0)
    assert period_start("ytd", now) == datetime(2024, 1, 1)
    assert period_start("max", now) is None
    # Calendar months and years; a shorter month gives its last day.
    assert period_start("1mo", datetime(2024, 3, 31, 12, 0)) == datetime(2024, 2, 29, 12, 0)
    assert period_start("3mo", datetime(2024, 2, 10)) == datetime(2023, 11, 10)
    assert period_start("1y", datetime(2025, 1, 1)) == datetime(2024, 1, 1)
    assert period_start("1y", datetime(2024, 2, 29)) == datetime(2023, 2, 28)
    with pytest.raises(ValueError):
        period_start("5x", now)
