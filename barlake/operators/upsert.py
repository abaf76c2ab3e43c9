"""Keyed upsert with MERGE semantics, as a DataFrame operator (SNK-3, JN-4).

``MERGE INTO t USING s ON t.k = s.k WHEN MATCHED UPDATE SET * WHEN NOT MATCHED
INSERT *`` means, row by row:

* a target row matched by one source row takes every column from it;
* a target row matched by several source rows is an error (D11);
* a target row with no match is kept; a source row with no match is inserted;
* keys compare with ``=``, so a null in any key column never matches (D10), and
  several target rows matched by one source row are each updated.

Both sides are read once and shuffled once. A full outer join on the key gives kept, updated and
inserted rows in one pass. How many source rows share a key is counted by a window over the
source's side of that same shuffle.

Hot keys. A full outer join cannot be split by adaptive execution, so hot keys are cut into parts
before the shuffle. A key that is hot in the target has its rows dealt to parts and its source row
repeated once per part; a key that is hot in the source has its rows dealt and the target rows
repeated. Which keys are hot is measured from a sample of the key columns of large inputs
(:func:`barlake.operators.skew.sampled_hot_keys`), while the merge is built. Rows with a
null key match nothing and are spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from barlake.operators.skew import BROADCAST_KEYS, PART, ROWS_PER_PART, any_null, sampled_hot_keys, spread

# Parts over which rows with a null key are spread.
NULL_PARTS = 1024


def align_to(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source columns by name in target order and type; extra columns are ignored,
    a missing one is an error (``UPDATE SET *`` / ``INSERT *`` expand over the
    target's columns)."""
    missing = [f.name for f in target.schema.fields if f.name not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def _dealt(df: DataFrame, keys: list[str], hot: DataFrame | None, own: str, other: str) -> DataFrame:
    """``df`` with the part of each row. ``hot`` lists the parts of hot keys per side: a side's
    own hot rows are dealt to one part each, and repeated in every part where only the other side is hot."""
    df = df.withColumn("_at", F.monotonically_increasing_id())
    null_part = spread(F.col("_at"), F.lit(NULL_PARTS))
    if hot is None:
        return df.withColumn(PART, F.when(any_null(keys), null_part).otherwise(F.lit(0)))
    df = df.join(hot, on=keys, how="left")
    one = F.array(F.when(any_null(keys), null_part).when(F.col(own).isNotNull(), spread(F.col("_at"), F.col(own))).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.col(other) - 1)
    repeated = F.when(F.col(own).isNull() & F.col(other).isNotNull(), every).otherwise(one)
    return df.withColumn(PART, F.explode(repeated))


def _hot_frame(target: DataFrame, source: DataFrame, keys: list[str], rows_per_part: int) -> DataFrame | None:
    """keys, _t (parts, if hot in the target), _s (parts, if hot in the source only); None if no key is hot."""
    in_target = sampled_hot_keys(target, keys, rows_per_part)
    in_source = sampled_hot_keys(source, keys, rows_per_part)
    known = {r[:-1] for r in in_target}
    rows = [(*r, None) for r in in_target] + [(*r[:-1], None, r[-1]) for r in in_source if r[:-1] not in known]
    if not rows:
        return None
    fields = [target.schema[k] for k in keys]
    schema = StructType([*fields, StructField("_t", IntegerType()), StructField("_s", IntegerType())])
    hot = target.sparkSession.createDataFrame(rows, schema)
    return F.broadcast(hot) if len(rows) <= BROADCAST_KEYS else hot


def upsert(target: DataFrame, source: DataFrame, keys: list[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The target after merging ``source`` into it on ``keys``; columns of ``target``."""
    if not keys:
        raise ValueError("upsert needs at least one key column")
    columns = target.columns
    source = align_to(target, source)
    hot = _hot_frame(target, source, keys, rows_per_part)
    left = _dealt(target, keys, hot, "_t", "_s").withColumn("_kept", F.lit(True))
    right = _dealt(source, keys, hot, "_s", "_t")
    # Counted on the join's own partitioning: no further exchange.
    right = right.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys, PART)))
    if hot is None:
        left = left.select(*columns, PART, "_kept", F.lit(False).alias("_many"))
        right = right.select(*columns, PART, "_rows", F.lit(False).alias("_held"))
    else:
        # A key that is hot in the source is repeated there for certain; one that is hot in
        # the target is there for certain, also where a part holds none of its rows.
        left = left.select(*columns, PART, "_kept", (F.col("_t").isNull() & F.col("_s").isNotNull()).alias("_many"))
        right = right.select(*columns, PART, "_rows", F.col("_t").isNotNull().alias("_held"))
    old = left.select(*[F.col(c).alias(f"_old_{c}") for c in columns], F.col(PART).alias("_old_part"), "_kept", "_many")
    match = [F.col(f"_old_{k}") == F.col(k) for k in keys] + [F.col("_old_part") == F.col(PART)]
    joined = old.join(right, on=match, how="full")
    # D11: the raise sits in a filter, which column pruning cannot drop: a count or a one-column
    # select raises as well.
    conflict = F.col("_kept") & F.col("_rows").isNotNull() & ((F.col("_rows") > 1) | F.col("_many"))
    error = F.raise_error(F.lit("upsert: several source rows match the same target row")).cast("boolean")
    # A source row repeated for a key that the target holds is no insert.
    lone = F.col("_kept").isNull() & F.coalesce("_held", F.lit(False))
    checked = joined.where(F.when(conflict, error).otherwise(~lone))
    # Target rows are repeated only where their key is hot in the source: matched, that is an error.
    updated = F.col("_rows").isNotNull()
    return checked.select(*[F.when(updated, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in columns])
