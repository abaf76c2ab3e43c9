"""Operator 7: line dedup over overlapping three-line windows.

A document's lines are its \\n-split lines with a visible character (blank lines are never
counted, and stay). Every run of ``window`` consecutive such lines is hashed (128 bits).
Of all equal windows in the whole table the first, by document id, text and line
number, stays; every later occurrence marks its lines, the marked positions of a document are
merged, and marked lines are removed.

Only windows are shuffled, as hashes. The first occurrence of a window comes from a partial
aggregate, so that a window held by a third of the table sends one row per task. The first
occurrences are written to the shared folder: the join that finds the later ones then has a plain
exchange on both sides, which adaptive execution splits where one window is hot.

Defined cases: null and empty texts and texts of fewer lines than ``window`` stay as they are; rows
with the same id and text are one document and get the same result; a null id sorts first;
other columns pass through, input columns with the output's names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm import common

WINDOW = 3
VISIBLE = r"[^\x00-\x20]"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row per window: key (id, text key), first position among the counted lines, hash."""
    text = F.col(f"`{text_col}`").cast("string")
    counted = F.filter(_lines(text), lambda x: x.rlike(VISIBLE))
    hashes = F.transform(counted, lambda x: F.struct(F.xxhash64(x).alias("a"), F.hash(x).cast("long").alias("b")))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        common.text_key(text).alias("t"),
        hashes.alias("h"),
    ).where(F.size("h") >= window)
    run = lambda part: [F.get("h", F.col("pos") + i)[part] for i in range(window)]
    # Consecutive lines are already hashed; a window mixes its lines' hashes.
    return rows.select("id", "t", "h", F.explode(F.sequence(F.lit(0), F.size("h") - window)).alias("pos")).select(
        "id", "t", "pos", F.xxhash64(*run("a"), *run("b")).alias("w1"), F.xxhash64(*run("b"), *run("a"), F.lit(7)).alias("w2")
    )


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, text key t and the sorted positions (among counted lines) that are removed."""
    common.require(docs, id_col, text_col)
    windows = _windows(docs, id_col, text_col, window)
    first = (
        windows.groupBy("w1", "w2")
        .agg(F.min(F.struct("id", "t", "pos")).alias("first"), F.max(F.struct("id", "t", "pos")).alias("last"))
        .where("NOT first <=> last")
        .select("w1", "w2", "first")
    )
    first = common.Scratch(docs.sparkSession).write(first)
    later = windows.join(first, ["w1", "w2"]).where(~F.struct("id", "t", "pos").eqNullSafe(F.col("first")))
    marked = F.flatten(F.transform(F.collect_set("pos"), lambda p: F.sequence(p, p + window - 1)))
    return later.groupBy("id", "t").agg(F.array_sort(F.array_distinct(marked)).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Every row with its text cleaned, and n_lines, n_removed (counted lines).

    A row whose counted lines are all removed keeps an empty text.
    """
    # All helper columns are fields of two structs whose names the input does not have.
    got, row = common.unused(docs, "removed"), common.unused(docs, "row")
    found = removed_lines(docs, id_col, text_col, window)
    removed = found.select(F.struct("id", "t", "removed").alias(got))
    text = F.col(f"`{text_col}`").cast("string")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(f"{got}.id")) & (common.text_key(text) == F.col(f"{got}.t"))
    joined = docs.join(removed, same, "left")
    blank = F.transform(_lines(text), lambda x: ~x.rlike(VISIBLE))
    counted = F.size(F.filter(blank, lambda b: ~b))
    hit = F.col(f"{got}.removed").isNotNull()
    # Line numbers of the counted lines: the marked positions point into this list.
    places = F.filter(F.transform(blank, lambda b, i: F.when(~b, i)), lambda i: i.isNotNull())
    out = joined.withColumn(
        row,
        F.struct(
            F.when(hit, places).alias("places"),
            F.when(text.isNull(), 0).otherwise(counted).cast("long").alias("n"),
            F.when(hit, F.size(f"{got}.removed")).otherwise(0).cast("long").alias("gone"),
        ),
    )
    gone = F.transform(F.col(f"{got}.removed"), lambda p: F.get(F.col(f"{row}.places"), p))
    kept = F.array_except(F.sequence(F.lit(0), F.size(_lines(text)) - 1), gone)
    lines = F.array_join(F.transform(kept, lambda i: F.get(_lines(text), i)), "\n")
    clean = F.when(~hit, text).when(F.col(f"{row}.gone") == F.col(f"{row}.n"), "").otherwise(lines)
    columns = []
    for c in docs.columns:
        if c.lower() not in ("n_lines", "n_removed"):
            columns.append(clean.alias(c) if c == text_col else F.col(f"`{c}`"))
    return out.select(*columns, F.col(f"{row}.n").alias("n_lines"), F.col(f"{row}.gone").alias("n_removed"))
