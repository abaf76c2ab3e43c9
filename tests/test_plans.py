"""The plans we want: checked on the physical plan text."""

import re

from pyspark.sql import functions as F

from barlake import queries as q
from barlake import testdata as td
from barlake.operators import conform_bars, daily_metrics, upsert
from barlake.plans import gold_source
from barlake.sources import Lake
from barlake.session import scratch_path

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_is_one_shuffle_with_partial_aggregation(spark):
    p = plan(daily_metrics(td.bars(td.table(spark, SF, "events"), td.NULL_CLOSE_EVERY)))
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_min_by" in p and "partial_var_pop" in p
    assert "SortMergeJoin" not in p and "Window" not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(daily_metrics(td.bars(td.table(spark, SF, "events"))))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_latest_record_limits_before_the_shuffle(spark):
    p = plan(q.latest_record_q(spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_lower_bound_reaches_the_scan(spark):
    p = plan(q.latest_in_range(spark, SF))
    assert "GreaterThanOrEqual(ts," in p
    assert "LessThanOrEqual(ts," not in p.split("PushedFilters")[1].split("]")[0]


def test_range_filter_pushed(spark):
    p = plan(q.filter_between_q(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


def test_bronze_lower_bound_prunes_load_partitions(spark):
    lake = Lake(spark, scratch_path(spark, "plan-lake"), {"bronze": "pb", "silver": "ps", "gold": "pg"}).create()
    path = lake.location("bronze", "market_data_1m")
    bronze = q._bronze_bars(spark, SF)
    bronze.write.partitionBy("load_prdt").parquet(path)
    p = plan(conform_bars(spark.read.parquet(path), td.LOAD_3, td.LOAD_2, td.LOAD_3))
    assert re.search(r"PartitionFilters: \[[^\]]*\(load_prdt#\d+ >= 2024-02-02\)", p), p


def test_gold_reads_only_the_range_days(spark):
    lake = Lake(spark, scratch_path(spark, "plan-lake"), {"bronze": "qb", "silver": "qs", "gold": "qg"}).create()
    p = plan(gold_source(lake, "2024-01-10 00:00:00", "2024-01-12 23:59:59"))
    assert re.search(r"PartitionFilters: \[[^\]]*bar_date#\d+ >= 2024-01-10", p), p


def test_no_python_evaluation_in_registered_queries(spark):
    """Every expression stays in the JVM: no Python UDF nodes in any plan."""
    writes = ("bronze_", "silver_", "gold_", "append_", "sql_over_tables")
    for name, query in q.QUERIES.items():
        if name.startswith(writes):
            continue  # these run jobs eagerly and return a table scan
        p = plan(query(spark, SF))
        assert "EvalPython" not in p and "PythonUDF" not in p and "MapInPandas" not in p, name


def test_lineitem_metrics_use_hash_aggregates_only(spark):
    for query in (q.daily_metrics_lineitem, q.monthly_metrics_lineitem):
        p = plan(query(spark, SF))
        assert "HashAggregate" in p and "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_upsert_reads_and_shuffles_little(spark, tmp_path):
    """Scans and exchanges of a plain keyed merge of stored tables."""
    t, s = str(tmp_path / "t"), str(tmp_path / "s")
    spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(t)
    spark.range(50, 150).select(F.col("id").alias("k"), F.lit(2).alias("v")).write.parquet(s)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(upsert(spark.read.parquet(t), spark.read.parquet(s), ["k"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert p.count("FileScan") == 2 and p.count("Exchange") == 2 and p.count("SortMergeJoin") == 1


def test_table_merge_reads_each_touched_partition_once(spark, monkeypatch):
    """The frame that an upsert stages: one scan of the source, one of the touched partitions only."""
    import uuid

    from barlake.sinks import tables

    name, root = f"once_{uuid.uuid4().hex[:8]}", scratch_path(spark, "once")
    spark.sql(f"CREATE TABLE {name} (k BIGINT, v INT, p INT) USING parquet PARTITIONED BY (p) LOCATION '{root}'")
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"), (F.col("id") % 10).cast("int").alias("p"))
    rows.write.insertInto(name)
    plans, plain = [], tables.upsert

    def kept(target, source, keys):
        out = plain(target, source, keys)
        plans.append(plan(out))
        return out

    monkeypatch.setattr(tables, "upsert", kept)
    tables.upsert_table(name, rows.where("p in (3, 5)").withColumn("v", F.lit(2)), ["k"], "p")
    p = plans[0]
    assert p.count("FileScan") == 2 and p.count("Exchange") == 2
    assert re.search(r"PartitionFilters: \[[^\]]*p#\d+ IN \(3,5\)\]|PartitionFilters: \[[^\]]*p#\d+ IN \(5,3\)\]", p), p
    assert {r.v: r["count"] for r in spark.table(name).groupBy("v").count().collect()} == {1: 80, 2: 20}
    monkeypatch.setattr(tables, "LISTED", 1)  # more partitions than are listed
    tables.upsert_table(name, rows.where("p in (3, 5)").withColumn("v", F.lit(3)), ["k"], "p")
    assert {r.v: r["count"] for r in spark.table(name).groupBy("v").count().collect()} == {1: 80, 3: 20}


def test_create_on_an_existing_lake_runs_no_job(spark):
    root = scratch_path(spark, "idle-lake")
    names = {"bronze": "ib", "silver": "is_", "gold": "ig"}
    Lake(spark, root, names, catalog="spark_catalog").create()
    spark.sparkContext.setJobGroup("create-again", "")
    Lake(spark, root, names, catalog="spark_catalog").create()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("create-again")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not list(jobs)


def test_hot_day_of_the_join_back_is_spread(spark):
    """Rows per task of the join stay bounded when the hot day grows tenfold; other keys are not repeated."""
    from barlake.operators.metrics import join_back

    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "256")
    most = {}
    try:
        for n in (10_000, 100_000):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            hot = spark.range(n).select(F.lit("hot").alias("ticker"), F.col("id").alias("t"))
            cold = spark.range(5_000).select(F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("ticker"), F.col("id").alias("t"))
            bars = hot.unionByName(cold)
            means = bars.groupBy("ticker").agg(F.avg("t").alias("m"), F.count(F.lit(1)).alias("n"))
            joined = join_back(bars, means, ["ticker"], "n", F.col("t"), rows_per_part=1_000)
            per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(per_task) == n + 5_000
            assert joined.where("ticker = 'hot'").select("m").distinct().count() == 1
            assert joined.where("m IS NULL").count() == 2_500  # null keys match nothing
            assert joined.where("ticker <> 'hot' AND _part > 0").count() == 0
            most[n] = max(per_task)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert most[10_000] < 4_000 and most[100_000] < 8_000


def test_tied_metrics_are_one_aggregate(spark):
    for query in (q.daily_metrics_lineitem, q.monthly_metrics_lineitem):
        p = plan(query(spark, SF))
        assert p.count("Exchange") == 1 and "Window" not in p
