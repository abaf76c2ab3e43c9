"""Write an upsert back into a parquet table without rewriting all of it.

Parquet tables have no MERGE, so the merged rows replace what they came from: the
partitions that hold source rows are read, merged, staged in the shared folder and written
with Spark's dynamic partition overwrite; other partitions are not touched. The partition value must
derive from the key so that a row never changes partition. Single writer per table.

The staged copy is complete before the overwrite begins. If the overwrite fails, the copy is
kept and its path logged, so nothing is lost; running the upsert again is safe (it is
idempotent for non-null keys).
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.upsert import upsert
from barlake.session import scratch_path

log = logging.getLogger(__name__)

# Partition values that an upsert lists in its scan.
LISTED = 1_000
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _fs_and_path(spark: SparkSession, path: str):
    """The Hadoop file system serving ``path``, and the path as a Hadoop Path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete a folder through the Hadoop file system of the path."""
    fs, jpath = _fs_and_path(spark, path)
    fs.delete(jpath, True)


@contextmanager
def staged(df: DataFrame, name: str = "stage", keep_on_error: bool = False) -> Iterator[DataFrame]:
    """Write ``df`` to a fresh folder under the shared folder, yield it read back,
    and delete the folder afterwards (``keep_on_error``: unless the block failed).

    Cuts the lineage: a frame used several times is computed once, and a lost
    executor re-reads the files instead of recomputing the whole plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staging", name)
    schema = df.schema
    df.write.mode("errorifexists").parquet(path)
    try:
        yield spark.read.schema(schema).parquet(path)
    except BaseException:
        if keep_on_error:
            log.error("write failed; the complete rows are kept in %s", path)
        else:
            delete_path(spark, path)
        raise
    delete_path(spark, path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 if it is not there."""
    fs, jpath = _fs_and_path(spark, path)
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0


def _overwrite(table: str, rows: DataFrame, mode: str) -> None:
    spark = rows.sparkSession
    before = spark.conf.get(OVERWRITE_MODE, "static")
    spark.conf.set(OVERWRITE_MODE, mode)
    try:
        rows.select(*[F.col(f"`{c}`") for c in spark.table(table).columns]).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def overwrite_partitions(table: str, rows: DataFrame) -> None:
    """Replace the partitions of ``table`` that ``rows`` hold; leave the others."""
    _overwrite(table, rows, "dynamic")


def overwrite_table(table: str, rows: DataFrame) -> None:
    """Replace all partitions of ``table``."""
    _overwrite(table, rows, "static")


def touched(target: DataFrame, source: DataFrame, partition_col: str) -> DataFrame | None:
    """Rows of ``target`` in partitions that hold source rows; None when ``source`` is empty.

    Up to ``LISTED`` partition values become a list, which prunes the scan and needs no join.
    Beyond that the smallest and largest value prune it, and a null-safe semi-join
    against the distinct values does the rest.
    """
    values = source.select(F.col(partition_col).alias("_touched")).distinct()
    listed = [r[0] for r in values.limit(LISTED + 1).collect()]
    if not listed:
        return None
    kind, column = target.schema[partition_col].dataType, F.col(partition_col)
    if len(listed) <= LISTED:
        inside = column.isin([F.lit(v).cast(kind) for v in listed if v is not None])
        return target.where(inside | column.isNull() if None in listed else inside)
    lo, hi, nulls = values.agg(F.min("_touched"), F.max("_touched"), F.max(F.col("_touched").isNull())).first()
    inside = column.between(F.lit(lo).cast(kind), F.lit(hi).cast(kind))
    if nulls:
        inside = inside | column.isNull()
    return target.where(inside).join(values, column.eqNullSafe(F.col("_touched")), "left_semi")


def upsert_table(table: str, source: DataFrame, keys: list[str], partition_col: str, stage_source: bool = True) -> None:
    """MERGE ``source`` into ``table`` on ``keys`` (SNK-3), rewriting only partitions with source rows.

    The partitions to touch are read from the source before the merge reads it, so the source is staged
    first unless the caller already did (``stage_source=False``). The merge itself reads the
    source and every touched partition once.
    """
    if stage_source:
        with staged(source, "upsert_source") as frozen:
            upsert_table(table, frozen, keys, partition_col, stage_source=False)
        return
    spark = source.sparkSession
    target = touched(spark.table(table), source, partition_col)
    if target is None:
        return
    # Rebalance: adaptive execution sizes the files per partition value and splits a very
    # large day rather than writing it from one task.
    merged = upsert(target, source, keys).hint("rebalance", partition_col)
    with staged(merged, "upsert_merged", keep_on_error=True) as rows:
        overwrite_partitions(table, rows.hint("rebalance", partition_col))
