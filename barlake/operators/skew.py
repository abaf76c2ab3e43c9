"""Hot keys: found by measuring, then cut into parts so that no task holds a whole one.

A key is hot when it holds more rows than one task should (``ROWS_PER_PART``). The rows of a
hot key are dealt to ``parts`` parts; the other side of a join is repeated once per part, for
hot keys only. Ordinary keys have one part and are neither repeated nor moved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.session import shared_dir

ROWS_PER_PART = 1_000_000
# A table below this many bytes fits one task however its keys are spread.
SMALL_BYTES = 256 << 20
# Rows of a hot-key list that may be broadcast (a few tens of bytes each); a longer list is joined by shuffle.
BROADCAST_KEYS = 100_000
# Expected number of sampled rows of a key that just fills one part.
SAMPLED = 100
PART = "_part"


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size of a frame: bytes of the files that it reads, or a very large number if unknown."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def sampled_hot_keys(df: DataFrame, keys: list[str], rows_per_part: int = ROWS_PER_PART) -> list[tuple]:
    """(key values ..., parts) of the keys that hold more than about ``rows_per_part`` rows.

    Reads the key columns once and counts a sample in which such a key is met ``SAMPLED``
    times; a frame of at most ``SMALL_BYTES`` is not read at all. Only keys of at
    least a 65,536th of the rows count, so the list has at most 131,072 entries. Every
    listed key occurs in ``df``; a key that is missed costs time, never rows.
    """
    if planned_bytes(df) <= SMALL_BYTES and rows_per_part >= ROWS_PER_PART:
        return []
    fraction = min(1.0, SAMPLED / rows_per_part)
    shared_dir(df.sparkSession)
    sampled = df.where(~any_null(keys)).select(*keys).sample(fraction, seed=7)
    counts = sampled.groupBy(*keys).count().checkpoint()
    total = counts.agg(F.sum("count")).first()[0] or 0
    found = counts.where((F.col("count") >= SAMPLED / 2) & (F.col("count") >= total / 65_536))
    parts = F.greatest(F.lit(2), F.ceil(F.col("count") / SAMPLED)).cast("int")
    return [tuple(r) for r in found.select(*keys, parts).collect()]


def spread(by: Column, parts: Column) -> Column:
    """A part number from 0 to below ``parts``, by hash."""
    return F.pmod(F.xxhash64(by), parts.cast("long")).cast("int")
