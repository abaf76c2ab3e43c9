import os
import uuid

import pytest

from barlake.session import scratch_path
from barlake.sinks import tables, upsert_table


def _table(spark, rows, tag="t"):
    name, root = f"{tag}_{uuid.uuid4().hex[:8]}", scratch_path(spark, "o'tables")
    quoted = root.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} (k STRING, v INT, p STRING) USING parquet PARTITIONED BY (p) LOCATION '{quoted}'")
    rows = spark.createDataFrame(rows, "k string, v int, p string")
    rows.write.insertInto(name)
    return name, root


def _files(root):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_upsert_rewrites_only_touched_partitions(spark):
    table, root = _table(spark, [("k1", 1, "a'b"), ("k2", 2, "x"), ("k3", 3, None), ("k4", 4, "a'b"), ("k6", 6, "b")])
    before = _files(root)
    source = spark.createDataFrame([("k1", 10, "a'b"), ("k3", 30, None), ("k5", 50, "new")], "k string, v int, p string")
    upsert_table(table, source, ["k", "p"], partition_col="p")
    rows = sorted(map(tuple, spark.table(table).select("k", "v", "p").collect()), key=str)
    # A null key part never matches (D10): k3 is inserted again.
    want = [("k1", 10, "a'b"), ("k2", 2, "x"), ("k3", 3, None), ("k3", 30, None), ("k4", 4, "a'b"), ("k5", 50, "new"), ("k6", 6, "b")]
    assert rows == sorted(want, key=str)
    after = _files(root)
    untouched = {f: t for f, t in before.items() if "p=x" in f or "p=b/" in f}
    assert len(untouched) == 2 and untouched.items() <= after.items()
    assert not [f for f in before if "p=a" in f and f in after]


def test_only_null_partition(spark):
    table, _ = _table(spark, [("k1", 1, None), ("k2", 2, "x")])
    upsert_table(table, spark.createDataFrame([("k9", 9, None)], "k string, v int, p string"), ["k"], partition_col="p")
    assert sorted(r.v for r in spark.table(table).collect()) == [1, 2, 9]


def test_empty_source_leaves_table_alone(spark):
    table, root = _table(spark, [("k1", 1, "x")])
    before = _files(root)
    upsert_table(table, spark.createDataFrame([], "k string, v int, p string"), ["k", "p"], partition_col="p")
    assert _files(root) == before and spark.table(table).count() == 1


def test_overwrite_mode_is_restored_and_failed_rows_are_kept(spark, monkeypatch, caplog):
    table, _ = _table(spark, [("k1", 1, "x")])
    mode = spark.conf.get(tables.OVERWRITE_MODE, "static")

    def fail(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr(tables, "overwrite_partitions", fail)
    with pytest.raises(RuntimeError):
        upsert_table(table, spark.createDataFrame([("k1", 5, "x")], "k string, v int, p string"), ["k"], partition_col="p")
    kept = [r.getMessage().rsplit(" ", 1)[1] for r in caplog.records if "kept in" in r.getMessage()]
    assert [tuple(r) for r in spark.read.parquet(kept[0]).select("k", "v").collect()] == [("k1", 5)]
    assert spark.conf.get(tables.OVERWRITE_MODE, "static") == mode
