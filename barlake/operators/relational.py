"""Typed range filters and whole-row distinct."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed_bound(df: DataFrame, column: str, value: Any) -> Column:
    """A literal cast to the column's own type, so the predicate compares like with
    like and reaches the parquet scan. Under ANSI a malformed bound raises (D6)."""
    return F.lit(value).cast(df.schema[column].dataType)


def filter_between(df: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    """Inclusive range on one column (FLT-1); nulls drop out."""
    return df.filter(F.col(column).between(typed_bound(df, column, low), typed_bound(df, column, high)))


def distinct_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Whole-row distinct after an optional projection (AGG-4).

    Partial aggregation collapses repeated rows before the shuffle, so a value
    repeated across a third of the input costs one row per map task.
    """
    return (df.select(*columns) if columns else df).distinct()
