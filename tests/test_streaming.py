import os
import uuid

import pytest

from barlake import testdata as td
from barlake.session import scratch_path
from barlake.sources import Lake
from barlake.streaming import ingest_landing

SF = "/root/testdata/sf0.001"


def test_stream_ingests_only_new_files(spark):
    tag = uuid.uuid4().hex[:8]
    lake = Lake(spark, scratch_path(spark, "stream-lake"), {k: f"{k}_{tag}" for k in ("bronze", "silver", "gold")})
    lake.create()
    landing = scratch_path(spark, "stream-landing")
    events = td.table(spark, SF, "events")
    td.vendor_bars(events).coalesce(2).write.parquet(f"{landing}/delivery=1")
    loads = iter(["2024-02-01 06:30:00", "2024-02-02 06:30:00", "2024-02-03 06:30:00"])
    stamp_for = {}

    def clock(batch_id):
        return stamp_for.setdefault(batch_id, next(loads))

    ingest_landing(lake, landing, "bars", clock=clock).awaitTermination()
    bronze = lake.table("bronze", "market_data_1m")
    assert spark.table(bronze).count() == events.count()

    # A second run with nothing new appends nothing.
    ingest_landing(lake, landing, "bars", clock=clock).awaitTermination()
    assert spark.table(bronze).count() == events.count()

    # A new delivery is picked up, as a new load.
    td.corrected_bars(events).write.parquet(f"{landing}/delivery=2")
    ingest_landing(lake, landing, "bars", clock=clock).awaitTermination()
    spark.catalog.refreshTable(bronze)
    corrected = events.filter("event_type = 'click'").count()
    assert spark.table(bronze).count() == events.count() + corrected
    assert spark.table(bronze).select("load_dttm").distinct().count() == 2


def test_batch_timestamp_is_the_load_time(spark):
    tag = uuid.uuid4().hex[:8]
    lake = Lake(spark, scratch_path(spark, "stream-lake"), {k: f"{k}_{tag}" for k in ("bronze", "silver", "gold")})
    lake.create()
    landing = scratch_path(spark, "stream-landing")
    td.vendor_bars(td.table(spark, SF, "events")).coalesce(1).write.parquet(landing)
    ingest_landing(lake, landing, "bars").awaitTermination()
    bronze = spark.table(lake.table("bronze", "market_data_1m"))
    stamps = bronze.select("load_dttm", "load_prdt").distinct().collect()
    assert len(stamps) == 1 and stamps[0].load_prdt == stamps[0].load_dttm.date()


def test_stream_ingests_profile_documents_from_json(spark):
    tag = uuid.uuid4().hex[:8]
    lake = Lake(spark, scratch_path(spark, "stream-lake"), {k: f"{k}_{tag}" for k in ("bronze", "silver", "gold")})
    lake.create()
    landing = scratch_path(spark, "stream-landing")
    docs = td.profile_docs(td.table(spark, SF, "customer"), td.table(spark, SF, "nation"))
    docs.write.json(landing)
    ingest_landing(lake, landing, "info", fmt="json", clock=lambda _b: "2024-02-01 06:30:00").awaitTermination()
    bronze = spark.table(lake.table("bronze", "ticker_info"))
    assert bronze.count() == docs.count()
    assert bronze.select("info").exceptAll(docs.select("info")).count() == 0


def _lake_and_landing(spark, files):
    tag = uuid.uuid4().hex[:8]
    lake = Lake(spark, scratch_path(spark, "stream-lake"), {k: f"{k}_{tag}" for k in ("bronze", "silver", "gold")}).create()
    landing = scratch_path(spark, "stream-landing")
    td.vendor_bars(td.table(spark, SF, "events")).repartition(files).write.parquet(landing)
    return lake, landing


def _ingest(lake, landing, checkpoint):
    query = ingest_landing(
        lake, landing, "bars", checkpoint=checkpoint, clock=lambda _b: "2024-02-01 06:30:00", max_files_per_trigger=1
    )
    query.awaitTermination()


def _rows(spark, lake):
    table = lake.table("bronze", "market_data_1m")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def test_batches_of_one_load_time_and_replays(spark):
    """Four files, one a trigger, one load time: all rows; a replayed batch: none twice."""
    lake, landing = _lake_and_landing(spark, 4)
    checkpoint = scratch_path(spark, "stream-checkpoint")
    _ingest(lake, landing, checkpoint)
    want = td.vendor_bars(td.table(spark, SF, "events"))
    assert _rows(spark, lake).count() == want.count()
    assert len(os.listdir(f"{checkpoint}/commits")) >= 4
    for name in os.listdir(f"{checkpoint}/commits"):
        if name.lstrip(".").startswith("3"):
            os.remove(f"{checkpoint}/commits/{name}")  # the last batch was written, its commit was not
    _ingest(lake, landing, checkpoint)
    got = _rows(spark, lake)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_crash_between_two_files_of_a_batch(spark, monkeypatch):
    from barlake.sinks.ledger import Ledger

    lake, landing = _lake_and_landing(spark, 2)
    checkpoint = scratch_path(spark, "stream-checkpoint")
    # Two partitions, so that a batch has several files to move.
    plain, moved = Ledger._move, []

    def fail_once(self, *args):
        if len(moved) == 1:
            moved.append("crash")
            raise OSError("lost")
        moved.append("file")
        plain(self, *args)

    monkeypatch.setattr(Ledger, "_move", fail_once)
    with pytest.raises(Exception, match="lost"):
        _ingest(lake, landing, checkpoint)
    _ingest(lake, landing, checkpoint)
    want = td.vendor_bars(td.table(spark, SF, "events"))
    assert "crash" in moved
    assert _rows(spark, lake).count() == want.count()
    # A stream that starts over with an empty checkpoint loads its files again, under new names.
    _ingest(lake, landing, scratch_path(spark, "stream-checkpoint"))
    assert _rows(spark, lake).count() == 2 * want.count()
