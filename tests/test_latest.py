from datetime import datetime

from barlake.operators import first_per_group, last_per_group, latest_record, row_number_by

SCHEMA = "k string, v string, load_dttm timestamp"


def _latest(spark, rows, start=None, end=None):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(r.v for r in latest_record(df, ["k"], start=start, end=end).collect())


def d(day, hour=0):
    return datetime(2024, 1, day, hour)


def test_newest_in_range(spark):
    assert _latest(spark, [("K", "v1", d(1)), ("K", "v2", d(5))], "2024-01-01", "2024-01-06") == ["v2"]


def test_newest_after_range_gives_no_row(spark):
    assert _latest(spark, [("K", "v1", d(1)), ("K", "v2", d(5))], "2024-01-01", "2024-01-02") == []


def test_newest_before_range(spark):
    assert _latest(spark, [("K", "v1", d(1))], "2024-01-02", "2024-01-06") == []


def test_bound_inclusive(spark):
    assert _latest(spark, [("K", "v1", d(2))], "2024-01-01", "2024-01-02") == ["v1"]


def test_date_only_end_is_midnight(spark):
    assert _latest(spark, [("K", "v1", d(2, 5))], "2024-01-01", "2024-01-02") == []


def test_null_load_time_ranks_last(spark):
    assert _latest(spark, [("K", "v1", None), ("K", "v2", d(1))]) == ["v2"]


def test_one_bound_is_an_error(spark):
    import pytest

    with pytest.raises(ValueError):
        _latest(spark, [("K", "v1", d(1))], "2024-01-01", None)


def test_helper_column_dropped(spark):
    df = spark.createDataFrame([("K", "v1", d(1))], SCHEMA)
    assert latest_record(df, ["k"]).columns == ["k", "v", "load_dttm"]


def test_row_number_directions(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), ("b", 5)], "k string, t int")
    asc = {(r.t): r.row_number for r in row_number_by(df, ["k"], ["t"], "asc").collect() if r.k == "a"}
    desc = {(r.t): r.row_number for r in row_number_by(df, ["k"], ["t"], "desc").collect() if r.k == "a"}
    assert asc == {None: 1, 1: 2, 2: 3}  # ascending puts nulls first
    assert desc == {2: 1, 1: 2, None: 3}  # descending puts nulls last


def test_first_and_last_per_group(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 7, "z")], "k string, t int, v string")
    assert sorted((r.k, r.v) for r in first_per_group(df, ["k"], ["t"]).collect()) == [("a", "x"), ("b", "z")]
    assert sorted((r.k, r.v) for r in last_per_group(df, ["k"], ["t"]).collect()) == [("a", "y"), ("b", "z")]


def test_lower_bound_pushdown_equals_plain_rank(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rows = [("K%d" % (i % 7), str(i), d(1 + i % 20, i % 24)) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    pushed = latest_record(df, ["k"], ["load_dttm"], "2024-01-05", "2024-01-15")
    w = Window.partitionBy("k").orderBy(F.col("load_dttm").desc())
    lo, hi = (F.lit(v).cast("timestamp") for v in ("2024-01-05", "2024-01-15"))
    reference = (
        df.withColumn("rn", F.row_number().over(w))
        .filter(F.col("load_dttm").between(lo, hi))
        .filter("rn = 1")
        .drop("rn")
    )
    assert sorted(map(tuple, pushed.collect())) == sorted(map(tuple, reference.collect()))


def _check_numbering(spark, rows):
    """Row numbers must be 1..n per group, in order, ties in any order."""
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(5)
    for order in ("asc", "desc"):
        out = row_number_by(df, ["k"], ["t"], order).collect()
        assert len(out) == len(rows)
        groups = {}
        for r in out:
            groups.setdefault(r.k, []).append((r.row_number, r.t))
        for got in groups.values():
            got.sort()
            assert [n for n, _ in got] == list(range(1, len(got) + 1))
            ts = [(t is not None, t or 0) for _, t in got]
            assert ts == sorted(ts, reverse=order == "desc")


def test_one_hot_group_is_numbered_over_many_slices(spark):
    rows = [("hot", i, 0.0) for i in range(3000)] + [(None, i, 0.0) for i in range(1200)] + [(f"k{i % 40}", i, 0.0) for i in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check_numbering(spark, rows)
        _check_numbering(spark, [("hot", 7, float(i)) for i in range(2000)] + [("a", None, 0.0)])  # one repeated order value
        df = spark.createDataFrame(rows, "k string, t int, v double")
        spread = row_number_by(df, ["k"], ["t"]).groupBy("k").count().where("k = 'hot'").first()["count"]
        assert spread == 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_two_thousand_groups_on_the_same_path(spark):
    _check_numbering(spark, [(f"g{i % 2000}", i // 2000, 0.0) for i in range(9000)])


def test_row_numbers_of_an_empty_table(spark):
    assert row_number_by(spark.createDataFrame([], "k string, t int"), ["k"], ["t"]).count() == 0


def test_malformed_bound_raises(spark):
    """D6: ANSI stays on, so a malformed range argument is an error, not an empty result."""
    import pytest
    from pyspark.errors import PySparkException

    from barlake.operators import filter_between

    df = spark.createDataFrame([("K", "v1", d(1))], SCHEMA)
    with pytest.raises(PySparkException):
        filter_between(df, "load_dttm", "not-a-date", "2024-01-02").collect()


def test_duplicate_rows_in_one_load_give_one_latest_row(spark):
    """D17: a bar delivered twice in one load appears twice in bronze, once after ranking."""
    df = spark.createDataFrame([("K", "v1", d(1)), ("K", "v1", d(1))], SCHEMA)
    assert latest_record(df, ["k"]).count() == 1
