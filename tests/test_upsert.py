import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from barlake.operators import upsert

SCHEMA = "k string, d int, v string"


def _run(spark, target, source, source_schema=SCHEMA):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, source_schema)
    return sorted(upsert(t, s, ["k", "d"]).collect(), key=lambda r: (str(r.k), str(r.d), str(r.v)))


def test_matched_unmatched(spark):
    out = _run(spark, [("a", 1, "old"), ("b", 1, "keep")], [("a", 1, "new"), ("c", 1, "ins")])
    assert [tuple(r) for r in out] == [("a", 1, "new"), ("b", 1, "keep"), ("c", 1, "ins")]


def test_null_keys_never_match(spark):
    out = _run(spark, [(None, 1, "t")], [(None, 1, "s")])
    assert sorted(r.v for r in out) == ["s", "t"]


def test_two_target_rows_one_source_row(spark):
    out = _run(spark, [("a", 1, "x"), ("a", 1, "y")], [("a", 1, "new")])
    assert [r.v for r in out] == ["new", "new"]


def test_two_source_rows_one_target_row_is_an_error(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        _run(spark, [("a", 1, "x")], [("a", 1, "p"), ("a", 1, "q")])


def test_two_source_rows_no_target_row(spark):
    out = _run(spark, [("b", 1, "x")], [("a", 1, "p"), ("a", 1, "q")])
    assert sorted(r.v for r in out) == ["p", "q", "x"]


def test_extra_source_column_ignored(spark):
    out = _run(spark, [("a", 1, "x")], [("a", 1, "y", 9)], SCHEMA + ", extra int")
    assert [tuple(r) for r in out] == [("a", 1, "y")]


def test_missing_source_column_is_an_error(spark):
    t = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    s = spark.createDataFrame([("a", 1)], "k string, d int")
    with pytest.raises(ValueError):
        upsert(t, s, ["k", "d"])


def test_idempotent_for_non_null_keys(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], SCHEMA)
    s = spark.createDataFrame([("a", 1, "z"), ("c", 3, "w")], SCHEMA)
    once = upsert(t, s, ["k", "d"])
    twice = upsert(once, s, ["k", "d"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_hot_key_third_of_target(spark):
    from pyspark.sql import functions as F

    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.lit(1).alias("d"), F.col("id").cast("string").alias("v"))
    cold = spark.range(6000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("d"), F.lit("c").alias("v"))
    source = spark.createDataFrame([("hot", 1, "new"), ("x", 9, "ins")], SCHEMA)
    out = upsert(hot.unionByName(cold), source, ["k", "d"])
    counts = {r.v: r["count"] for r in out.groupBy("v").count().collect()}
    assert counts == {"new": 3000, "c": 6000, "ins": 1}


@pytest.mark.parametrize("side", ["target", "source"])
def test_hot_key_is_cut_into_parts(spark, side):
    """Half of one side on one key: no task of the join holds more than about two parts of it."""
    from pyspark.sql import functions as F

    hot_or_own = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    many = spark.range(40_000).select(hot_or_own.alias("k"), F.lit(1).alias("d"), F.col("id").cast("string").alias("v"))
    few = spark.createDataFrame([("hot" if side == "target" else "h", 1, "new"), ("1", 1, "one"), ("x", 9, "ins")], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = upsert(many, few, ["k", "d"], rows_per_part=2_000) if side == "target" else upsert(few, many, ["k", "d"], rows_per_part=2_000)
        per_task = [r["count"] for r in out.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
        counts = {r.v: r["count"] for r in out.where("v in ('new', 'one', 'ins', '1')").groupBy("v").count().collect()}
        total = out.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per_task) == 20_000 and len(per_task) >= 6 and max(per_task) < 8_000
    if side == "target":
        assert counts == {"new": 20_000, "one": 1, "ins": 1} and total == 40_001
    else:
        assert counts == {"new": 1, "1": 1, "ins": 1} and total == 40_002


@pytest.mark.parametrize("target", [[("hot", 1, "t")], [("hot", 1, str(i)) for i in range(3_000)]])
def test_hot_source_key_in_the_target_is_an_error(spark, target):
    from pyspark.sql import functions as F

    source = spark.range(3_000).select(F.lit("hot").alias("k"), F.lit(1).alias("d"), F.col("id").cast("string").alias("v"))
    merged = upsert(spark.createDataFrame(target, SCHEMA), source, ["k", "d"], rows_per_part=1_000)
    for action in (merged.count, merged.select("v").collect):
        with pytest.raises(Exception, match="several source rows"):
            action()


def test_sampled_keys_are_the_hot_ones(spark):
    from pyspark.sql import functions as F

    from barlake.operators.skew import sampled_hot_keys

    key = F.when(F.col("id") < 50_000, F.lit("a")).when(F.col("id") < 60_000, F.lit(None)).otherwise(F.col("id").cast("string"))
    df = spark.range(100_000).select(key.alias("k"))
    found = sampled_hot_keys(df, ["k"], rows_per_part=5_000)
    assert [k for k, _ in found] == ["a"] and 7 <= found[0][1] <= 14
    assert sampled_hot_keys(df, ["k"]) == []  # small: not even read


def test_conflict_raises_under_every_action(spark):
    """Column pruning must not drop the conflict (D11): counts and one-column reads raise too."""
    target = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    source = spark.createDataFrame([("a", 5), ("a", 6)], "k string, v int")
    merged = upsert(target, source, ["k"])
    for action in (merged.count, merged.isEmpty, merged.select("v").collect, merged.agg({"*": "count"}).collect):
        with pytest.raises(Exception, match="several source rows"):
            action()
    lone = upsert(target, spark.createDataFrame([("z", 5), ("z", 6)], "k string, v int"), ["k"])
    assert lone.count() == 5 and lone.select("v").count() == 5
