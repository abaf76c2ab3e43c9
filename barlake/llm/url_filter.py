"""Operator 10: URL filter by a temporal list join.

A list is a table of dated events: ``entry`` (a host, or host/path prefix), ``action``
(block or allow), ``op`` (add or remove), ``at``. Each entry's events become validity
intervals [at, next event). A capture is tested with all its keys (the host, each parent
domain of two labels or more, host/path prefixes) against the entries active at its fetch time.
Of several the longest key decides, then block before allow. Only keys with as many labels or
path steps as some entry has are written out, so a very long path costs no more than its list allows.

The as-of join is an equi-join on (key, month): an interval is written once for each month
that it shares with the captures' time range, so a capture meets only the entry states
of its month, however long the history. Adaptive execution may split a hot host or
broadcast a list that proves small.

Defined cases: a null or malformed URL or a null fetch time is never blocked; events
with a null entry, action, op or time are ignored; at equal times remove wins over add; repeated
events count once, repeated captures are judged alike; extra columns pass through,
input columns with the output's names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm import common

MONTH_S = 30 * 86_400
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host without a trailing dot and a leading www.; null if there is none."""
    found = F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"^www\.|\.$", "")
    return F.when(found != "", found)


def url_keys(url: Column, labels: list[int], steps: list[int]) -> Column:
    """The keys under which a list entry can name the URL, of those with so many host labels or path steps."""
    parts = F.split(host(url), r"\.", -1)
    path = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/", -1), lambda x: x != "")
    numbers = lambda ns: F.lit(ns) if ns else F.array().cast("array<int>")
    parents = F.transform(
        F.filter(numbers(labels), lambda n: (n <= F.size(parts)) & ((n > 1) | (F.size(parts) == 1))),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(numbers(steps), lambda n: n <= F.size(path)), lambda n: F.concat(host(url), F.lit("/"), F.array_join(F.slice(path, 1, n), "/"))
    )
    return F.concat(parents, prefixes)


def entry_shapes(entries: DataFrame) -> tuple[list[int], list[int]]:
    """The numbers of host labels of the entries without a path, and of path steps of those with one.

    Entries of k different lengths hold at least k * k / 2 parts, so these are short however long the list.
    """
    n_steps = F.size(F.split("entry", "/", -1)) - 1
    rows = entries.select(n_steps.alias("s"), F.when(n_steps == 0, F.size(F.split("entry", r"\.", -1))).alias("l")).distinct().collect()
    return sorted({r["l"] for r in rows if r["l"] is not None}), sorted({r["s"] for r in rows if r["s"]})


def validity(events: DataFrame) -> DataFrame:
    """entry, action, since, until (null: still valid) of every interval in which an entry is listed."""
    common.require(events, "entry", "action", "op", "at")
    by = Window.partitionBy("entry", "action").orderBy("at", "op")
    good = events.select("entry", "action", "op", "at").dropna().distinct()
    return (
        good.withColumn("until", F.lead("at").over(by))
        .where((F.col("op") == "add") & (F.col("until").isNull() | (F.col("until") > F.col("at"))))
        .select("entry", "action", F.col("at").alias("since"), "until")
    )


def _month(at: Column) -> Column:
    return F.floor(F.unix_timestamp(at) / MONTH_S)


def filter_urls(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """Every capture with blocked, entry (the deciding one), action and listed_since."""
    common.require(captures, id_col, url_col, time_col)
    cap = captures.select(
        F.col(f"`{id_col}`").alias("k1"), F.col(f"`{url_col}`").alias("k2"), F.col(f"`{time_col}`").cast("timestamp").alias("k3")
    )
    span = cap.agg(F.min(_month(F.col("k3"))).alias("a"), F.max(_month(F.col("k3"))).alias("b")).first()
    first, last = (0, -1) if span["a"] is None else (span["a"], span["b"])
    intervals = (
        validity(events)
        .withColumn("from", F.greatest(_month(F.col("since")), F.lit(first)))
        .withColumn("to", F.least(F.coalesce(_month(F.col("until")), F.lit(last)), F.lit(last)))
        .where("from <= to")
        .select("entry", "action", "since", "until", F.explode(F.sequence("from", "to")).alias("month"))
    )
    shapes = entry_shapes(intervals)
    keys = cap.where(F.col("k3").isNotNull() & host(F.col("k2")).isNotNull()).select(
        "k1", "k2", "k3", F.explode(url_keys(F.col("k2"), *shapes)).alias("entry"), _month(F.col("k3")).alias("month")
    )
    active = keys.join(intervals, ["entry", "month"]).where(
        (F.col("since") <= F.col("k3")) & (F.col("until").isNull() | (F.col("k3") < F.col("until")))
    )
    rank = F.struct(F.char_length("entry").alias("n"), (F.col("action") == "block").alias("b"), "since", "entry", "action")
    decided = active.groupBy("k1", "k2", "k3").agg(F.max(rank).alias("m"))
    rows = common.without(captures, "blocked", "entry", "action", "listed_since")
    out = rows.join(
        decided,
        F.col(f"`{id_col}`").eqNullSafe(F.col("k1")) & F.col(f"`{url_col}`").eqNullSafe(F.col("k2")) & (F.col(f"`{time_col}`").cast("timestamp") == F.col("k3")),
        "left",
    )
    return out.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.coalesce(F.col("m.action") == "block", F.lit(False)).alias("blocked"),
        F.col("m.entry").alias("entry"),
        F.col("m.action").alias("action"),
        F.col("m.since").alias("listed_since"),
    )
