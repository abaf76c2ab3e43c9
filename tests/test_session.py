from pyspark.sql import functions as F

from barlake.session import SCALE_DEFAULTS, pin_session, scratch_path, shared_dir, tune_for_scale


def test_scratch_paths_live_in_the_configured_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(configured.rstrip("/") + "/barlake/x/")


def test_tune_for_scale_sets_unsubmitted_keys_and_honours_overrides(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {k: spark.conf.get(k, None) for k in SCALE_DEFAULTS}
    try:
        tune_for_scale(spark, {key: "128m"})
        assert spark.conf.get(key) == "128m"
        tune_for_scale(spark)
        assert spark.conf.get(key) == SCALE_DEFAULTS[key]
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_pin_session_uses_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    pin_session(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_cluster_without_shared_folder_is_an_error():
    """On a cluster an unset spark.checkpoint.dir must not fall back to a local temp folder."""
    import pytest

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class _Session:
        conf = _Conf()
        sparkContext = _Context()

    with pytest.raises(RuntimeError):
        shared_dir(_Session())


def test_cluster_with_an_in_memory_catalog_is_refused(spark, monkeypatch):
    """Naming the session catalog does not make it persistent."""
    import pytest

    from barlake.sources import Lake, catalog

    monkeypatch.setattr(catalog, "is_local", lambda _spark: False)
    for name in (None, "spark_catalog"):
        with pytest.raises(RuntimeError, match="persistent"):
            Lake(spark, scratch_path(spark, "refused"), catalog=name).create()
    names = {k: f"tmp_{k}" for k in ("bronze", "silver", "gold")}
    Lake(spark, scratch_path(spark, "temporary"), names, catalog="spark_catalog", temporary=True).create().drop()


def test_attach_registers_single_partitions(spark):
    import uuid

    from barlake.schemas import BRONZE_BARS
    from barlake.sources import Lake

    tag = uuid.uuid4().hex[:8]
    lake = Lake(spark, scratch_path(spark, "attach"), {k: f"{k}_{tag}" for k in ("bronze", "silver", "gold")}).create()
    path = lake.location("bronze", "market_data_1m")
    for day in ("2024-01-01", "2024-01-02"):
        rows = spark.createDataFrame([], BRONZE_BARS).drop("load_prdt").union(
            spark.range(2).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE_BARS.fields if f.name != "load_prdt"])
        )
        rows.write.parquet(f"{path}/load_prdt={day}")
    lake.attach("bronze", "market_data_1m", ["2024-01-02"])
    lake.attach("bronze", "market_data_1m", ["2024-01-02"])
    assert [str(r[0]) for r in lake.scan("bronze", "market_data_1m").select("load_prdt").distinct().collect()] == ["2024-01-02"]
