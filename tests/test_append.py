import uuid

from pyspark.sql import functions as F

from barlake.functions import stamp
from barlake.session import scratch_path
from barlake.sinks import append_partitioned
from barlake.sinks.append import aligned


def _table(spark):
    db = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    return f"{db}.h", scratch_path(spark, "test-append")


def test_create_then_append_keeps_history(spark):
    name, loc = _table(spark)
    batch = spark.createDataFrame([("A", 1.0)], "Ticker string, v double")
    append_partitioned(stamp(batch, "2024-01-01 10:00:00", with_date=True), name, location=loc)
    append_partitioned(stamp(batch, "2024-01-02 10:00:00", with_date=True), name, location=loc)
    out = spark.table(name)
    assert out.count() == 2
    assert sorted(str(r.load_prdt) for r in out.select("load_prdt").collect()) == ["2024-01-01", "2024-01-02"]
    parts = spark.sql(f"SHOW PARTITIONS {name}").count()
    assert parts == 2


def test_new_column_and_missing_column(spark):
    name, loc = _table(spark)
    first = spark.createDataFrame([("A", 1.0)], "Ticker string, v double")
    append_partitioned(stamp(first, "2024-01-01 10:00:00", with_date=True), name, location=loc)
    wider = spark.createDataFrame([("B", "x")], "Ticker string, extra string")  # new `extra`, no `v`
    append_partitioned(stamp(wider, "2024-01-02 10:00:00", with_date=True), name, location=loc)
    rows = {r.Ticker: r for r in spark.table(name).collect()}
    assert rows["A"].extra is None and rows["A"].v == 1.0
    assert rows["B"].extra == "x" and rows["B"].v is None
    assert spark.table(name).columns[-1] == "load_prdt"


def test_batch_stamp_is_constant(spark):
    name, loc = _table(spark)
    batch = spark.range(50).select(F.col("id").cast("string").alias("Ticker"))
    append_partitioned(stamp(batch, "2024-01-01 10:00:00", with_date=True), name, location=loc)
    assert spark.table(name).select("load_dttm").distinct().count() == 1


def test_widening_changes_the_entry_in_place(spark, monkeypatch):
    """No statement drops the table or lists its partitions, and a crash right after leaves it readable."""
    name = f"wide_{uuid.uuid4().hex[:8]}"
    first = spark.createDataFrame([(1, 1.5, "a")], "n int, x float, load_prdt string")
    append_partitioned(first, name, location=scratch_path(spark, "wide"))
    statements, plain = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (statements.append(text), plain(self, text, *a, **k))[1])
    aligned(spark.createDataFrame([(2**40, 2.5, "b")], "N long, X double, load_prdt string"), name, "load_prdt")  # a crash follows
    assert spark.table(name).dtypes == [("n", "bigint"), ("x", "double"), ("load_prdt", "string")]
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, 1.5, "a")]
    append_partitioned(spark.createDataFrame([(2**40, 2.5, "b")], "N long, X double, load_prdt string"), name)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, 1.5, "a"), (2**40, 2.5, "b")]
    assert not [s for s in statements if "DROP" in s or "RECOVER" in s or "CREATE" in s]
