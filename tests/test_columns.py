from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barlake.functions import audit_columns, cleanse_string, parse_profile, profile_columns, stamp, to_float32


def test_cleanse_string(spark):
    df = spark.createDataFrame([(" a ",), ("",), ("  ",), (None,), ("b",)], "s string")
    got = [r[0] for r in df.select(cleanse_string("s")).collect()]
    assert got == ["a", None, None, None, "b"]


def test_float32_narrowing(spark):
    df = spark.createDataFrame([(16777217,)], "v bigint")
    assert df.select(to_float32("v")).first()[0] == 16777216.0


def test_audit_date_from_one_timestamp(spark):
    ts, day = audit_columns("2024-03-01 23:59:59")
    row = spark.range(1).select(ts.alias("t"), day.alias("d")).first()
    assert row.t == datetime(2024, 3, 1, 23, 59, 59)
    assert row.d == date(2024, 3, 1)


def test_stamp_adds_columns(spark):
    out = stamp(spark.range(2), "2024-01-01 00:00:00", with_date=True)
    assert out.columns == ["id", "load_dttm", "load_prdt"]


@pytest.mark.parametrize(
    "doc, expected",
    [
        (
            '{"longName": " Acme ", "longBusinessSummary": "x", "currency": "USD", "marketCap": 5, "industry": "Tools"}',
            ("Acme", "x", "USD", 5.0, "Tools"),
        ),
        ('{"longName": "A", "marketCap": "big"}', ("A", None, None, None, None)),
        ('{"longName": "A", "marketCap": NaN}', ("A", None, None, None, None)),
        ('{"longName": "A", "marketCap": 1.5e12}', ("A", None, None, None, None)),
        ('{"longName": 42, "industry": {"a": 1}}', ("42", None, None, None, '{"a":1}')),
        ('{"longName": "A", ', (None, None, None, None, None)),
        ("", (None, None, None, None, None)),
        (None, (None, None, None, None, None)),
        ('{"LongName": "A"}', (None, None, None, None, None)),
    ],
)
def test_profile_json(spark, doc, expected):
    df = spark.createDataFrame([("T", doc)], "ticker string, info string")
    row = df.select("ticker", parse_profile("info").alias("parsed_info")).select(*profile_columns()).first()
    assert tuple(row)[1:] == expected


def test_quoted_column_name(spark):
    df = spark.createDataFrame([(1.5,)], "`Stock Splits` double")
    assert df.select(to_float32(F.col("`Stock Splits`"))).first()[0] == 1.5
