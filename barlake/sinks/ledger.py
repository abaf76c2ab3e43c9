"""Exactly-once appends of numbered batches: a ledger of (landing, batch id) kept with the load.

A stream hands the same batch over again after a failure, so an append must not add it twice, and
two batches must never be taken for one. A batch is written in three steps:

1. its rows are staged in the ledger, as the files of the table's partitions;
2. once the stage is complete, its files are renamed into the table under names made of the ledger's
   id, the batch id and a number: a repeated rename finds the name taken and leaves it;
3. the batch is marked as done.

A replay of a batch that is done does nothing. A batch that was staged completely is not computed again: the
files that are not in the table yet are moved. A batch whose stage is incomplete has moved nothing and is
staged afresh. The ledger's id is drawn once and lives in the ledger, so a stream that starts over
with an empty checkpoint has new names. The driver handles file names only, as many as one batch has.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from barlake.sinks.append import aligned, create_if_missing, sql_string, table_location
from barlake.sinks.tables import _fs_and_path, delete_path

# Fixed values of Spark's file layout.
DONE = "_SUCCESS"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Ledger:
    """The batches of one landing folder that a table holds."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.id = self._id()

    def _id(self) -> str:
        ids = self._names(f"{self.root}/id")
        if not ids:
            self._touch(f"{self.root}/id/{uuid.uuid4().hex}")
            ids = self._names(f"{self.root}/id")
        return min(ids)

    def _names(self, path: str) -> list[str]:
        fs, jpath = _fs_and_path(self.spark, path)
        return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []

    def _touch(self, path: str) -> None:
        fs, jpath = _fs_and_path(self.spark, path)
        fs.create(jpath, True).close()

    def holds(self, batch_id: int) -> bool:
        fs, jpath = _fs_and_path(self.spark, f"{self.root}/done/{batch_id}")
        return fs.exists(jpath)

    def append(self, batch: DataFrame, batch_id: int, table: str, partition_col: str, location: str) -> None:
        """Append the rows of ``batch`` to ``table`` once, however often the batch is handed over."""
        if self.holds(batch_id):
            return
        stage = f"{self.root}/staged/{batch_id}"
        if DONE not in self._names(stage):
            create_if_missing(batch, table, partition_col, location)
            # Kept in the ledger until the batch is done; the mark is written when all files are complete.
            aligned(batch, table, partition_col).write.partitionBy(partition_col).mode("overwrite").parquet(stage)
        self._publish(stage, batch_id, table, partition_col)
        self._touch(f"{self.root}/done/{batch_id}")
        delete_path(self.spark, stage)

    def _publish(self, stage: str, batch_id: int, table: str, partition_col: str) -> None:
        location = table_location(self.spark, table)  # where the catalog has it
        folders = [f for f in self._names(stage) if "=" in f]
        for folder in folders:
            for name in self._names(f"{stage}/{folder}"):
                if name.endswith(".parquet"):
                    self._move(f"{stage}/{folder}/{name}", f"{location.rstrip('/')}/{folder}", f"batch-{self.id}-{batch_id}-{name}")
        for folder in folders:
            value = unquote(folder.split("=", 1)[1])
            literal = "NULL" if value == NULL_PARTITION else sql_string(value)
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (`{partition_col}` = {literal})")
        self.spark.catalog.refreshTable(table)

    def _move(self, source: str, folder: str, name: str) -> None:
        fs, old = _fs_and_path(self.spark, source)
        _, into = _fs_and_path(self.spark, folder)
        _, new = _fs_and_path(self.spark, f"{folder}/{name}")
        fs.mkdirs(into)
        if not fs.rename(old, new) and not fs.exists(new):
            raise OSError(f"could not move {source} to {folder}")
