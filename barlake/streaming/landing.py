"""Bronze ingestion as an incremental file stream (JOB-1/JOB-2, run repeatedly).

The batch jobs read a landing folder the caller names per run. Here a file-source
stream watches one landing folder; its checkpoint (in the shared folder) records
which files were already loaded, so each run appends only new deliveries.
``availableNow`` processes what is there and stops, so the job runs on a schedule
like the batch jobs. Each micro-batch is one load: it gets one load time and is
appended once, with column evolution.

The load time is ``current_timestamp()`` in the stream, which Structured Streaming
fixes per micro-batch and records in the checkpoint's offset log: a micro-batch
replayed after a failure carries the same load time. A replay is told by its batch id in
the ledger next to the checkpoint (:mod:`barlake.sinks.ledger`), not by its load time, so batches that share one are
all loaded, and a replayed one is loaded once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.functions.columns import stamp
from barlake.schemas import LANDING_BARS, LANDING_INFO
from barlake.sinks.ledger import Ledger
from barlake.sources.catalog import BARS_BRONZE, INFO_BRONZE, Lake

KINDS = {"bars": (LANDING_BARS, BARS_BRONZE), "info": (LANDING_INFO, INFO_BRONZE)}


def ingest_landing(
    lake: Lake,
    landing: str,
    kind: str = "bars",
    fmt: str = "parquet",
    checkpoint: str | None = None,
    clock: Callable[[int], datetime | str] | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; the caller waits with ``awaitTermination()``.

    ``clock`` maps a batch id to its load time instead of the batch timestamp
    (tests pin it).
    """
    schema, name = KINDS[kind]
    table, location = lake.table("bronze", name), lake.location("bronze", name)
    reader = lake.spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing)
    if clock is None:
        stream = stream.withColumn("load_dttm", F.current_timestamp()).withColumn("load_prdt", F.to_date("load_dttm"))

    # One checkpoint per (kind, landing folder): it records which files of that folder were loaded.
    landing_id = hashlib.sha1(landing.encode()).hexdigest()[:16]
    checkpoint = checkpoint or f"{lake.root.rstrip('/')}/_streams/{kind}/{landing_id}"
    ledger = Ledger(lake.spark, f"{checkpoint.rstrip('/')}/ledger")

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        stamped = batch if clock is None else stamp(batch, clock(batch_id), with_date=True)
        ledger.append(stamped, batch_id, table, "load_prdt", location)

    return (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
