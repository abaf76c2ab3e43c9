"""Row numbering, first/last per group, and the latest record per business key."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.relational import typed_bound
from barlake.session import shared_dir

ROW_NUMBER = "row_number"


def _ordering(order_cols: list[str], order: str) -> list[Column]:
    if order not in ("asc", "desc"):
        raise ValueError(f"order must be 'asc' or 'desc', got {order!r}")
    return [F.col(c).asc() if order == "asc" else F.col(c).desc() for c in order_cols]


def row_number_by(
    df: DataFrame,
    partition_cols: list[str],
    order_cols: list[str],
    order: str = "asc",
    name: str = ROW_NUMBER,
) -> DataFrame:
    """Row number per partition, ascending (nulls first) or descending (nulls last)
    over every order column (WIN-1, WIN-2); ties in any order.

    One path for groups of every size. Range partitioning on (keys, order, a unique
    row number) cuts the sorted rows into slices of about equal size, so a group (or one repeated
    order value) that holds a third of the rows is spread over many tasks; adaptive execution sizes
    the slices from the shuffled bytes. A window numbers the rows
    of each (slice, group). Only the first group of a slice can have begun in an
    earlier slice, so there is one offset per slice: the group's rows before it.

    Range bounds come from a sample drawn per shuffle, so the slices are fixed once, by
    a checkpoint in the shared folder, before they are numbered.
    """
    ordering = _ordering(order_cols, order)
    keys = [F.col(c) for c in partition_cols]
    shared_dir(df.sparkSession)
    sort_keys = [k.asc() for k in keys] + ordering + [F.col("_row").asc()]
    sliced = (
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    within = Window.partitionBy("_slice", *keys).orderBy("_pos")
    numbered = sliced.withColumn("_in_slice", F.row_number().over(within))
    joined = numbered.join(F.broadcast(_slice_offsets(sliced, partition_cols)), "_slice", "left")
    begun = reduce(lambda a, b: a & b, [k.eqNullSafe(F.col(f"_key.k{i}")) for i, k in enumerate(keys)])
    before = F.when(begun, F.col("_before")).otherwise(0)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_in_slice") + before).cast("int").alias(name)
    )


def _slice_offsets(sliced: DataFrame, partition_cols: list[str]) -> DataFrame:
    """One row per slice: its first group (``_key``) and that group's rows in earlier slices.

    In every earlier slice that holds it, that group is the last one: its offset is the sum of
    its row counts there. The table has one row per slice, whatever the data.
    """
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(partition_cols)])
    ends = sliced.groupBy("_slice").agg(F.min("_pos").alias("_lo"), F.max("_pos").alias("_hi"))
    edge = sliced.join(F.broadcast(ends), "_slice")
    first = edge.where("_pos = _lo").select("_slice", key.alias("_key"))
    last = edge.where("_pos = _hi").select("_slice", key.alias("_last"))
    rows = sliced.join(F.broadcast(last), "_slice").where(key.eqNullSafe(F.col("_last")))
    held = rows.groupBy("_slice", F.col("_last").alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    both = held.select("_slice", "_key", "_n", F.lit(False).alias("_ask")).union(
        first.select("_slice", "_key", F.lit(0).cast("long"), F.lit(True))
    )
    earlier = Window.partitionBy("_key").orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    return (
        both.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .where("_ask")
        .select("_slice", "_key", "_before")
    )


def _rank_one(df: DataFrame, partition_cols: list[str], order_cols: list[str], order: str) -> DataFrame:
    # `row_number = 1` right above the window lets Catalyst insert a partial
    # WindowGroupLimit before the shuffle: each map task sends at most one row per
    # group, so a hot group cannot flood one reducer.
    ranked = df.withColumn("_rn", _plain_row_number(partition_cols, order_cols, order))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def _plain_row_number(partition_cols: list[str], order_cols: list[str], order: str) -> Column:
    """Row number by a window, for ranks that a filter right above limits to the first."""
    window = Window.partitionBy(*[F.col(c) for c in partition_cols]).orderBy(*_ordering(order_cols, order))
    return F.row_number().over(window)


def first_per_group(df: DataFrame, partition_cols: list[str], order_cols: list[str]) -> DataFrame:
    """First row per group in ascending order (TOP-1)."""
    return _rank_one(df, partition_cols, order_cols, "asc")


def last_per_group(df: DataFrame, partition_cols: list[str], order_cols: list[str]) -> DataFrame:
    """Last row per group: first in descending order (TOP-2)."""
    return _rank_one(df, partition_cols, order_cols, "desc")


def latest_record(
    df: DataFrame,
    keys: list[str],
    order_cols: list[str] | None = None,
    start: Any = None,
    end: Any = None,
    time_col: str = "load_dttm",
    date_partition_col: str | None = None,
) -> DataFrame:
    """Newest row per business key, optionally restricted to a load-time range (TOP-3).

    Rank first, filter after (D1): a key whose newest load lies after ``end`` yields
    no row rather than an older load. Only the lower bound is pushed below the
    window, which is exact when ``time_col`` leads the ordering: rows older than
    ``start`` can only win for keys that the outer filter drops anyway. On bronze,
    ``date_partition_col`` (the load date, derived from the load time, D13) lets
    the same bound prune whole partitions.
    """
    order_cols = order_cols or [time_col]
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    ranged = start is not None
    if ranged and order_cols[0] == time_col:
        lo = typed_bound(df, time_col, start)
        df = df.filter(F.col(time_col) >= lo)
        if date_partition_col is not None:
            df = df.filter(F.col(date_partition_col) >= F.to_date(lo))
    ranked = df.withColumn("_rn", _plain_row_number(keys, order_cols, "desc"))
    if ranged:
        ranked = ranked.filter(
            F.col(time_col).between(typed_bound(df, time_col, start), typed_bound(df, time_col, end))
        )
    # The helper column is dropped (D16): no caller reads it.
    return ranked.filter(F.col("_rn") == 1).drop("_rn")
