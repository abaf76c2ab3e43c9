"""Operator 1: quality rules from a suffix array over each document's words.

A document's tokens are its words (maximal runs of characters other than space and
TAB..CR), whatever their length: one unit for every text. (Text without spaces has few words and fails
the base rule.) Suffixes are sorted by prefix doubling, the
longest common prefix of neighbours is read off the doubling levels, and every
suffix covers the longest prefix that it shares with a neighbour: the union over
all LCP intervals of ``min_repeat`` tokens or more. A document is kept while the
covered share of its tokens and its longest repeat stay within the limits.

Defined cases: null or empty text has no words and fails the base rule; repeated rows
and repeated ids are judged one by one; other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import common
from barlake.llm.common import blocks

common.ship(__name__)

MIN_REPEAT = 10
MAX_COVERED_PERCENT = 30
MAX_LONGEST = 200

_WORD = re.compile(common.WORD)
_SYMBOLS = "#*$%&|<>"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, covered_tokens long, longest_repeat long"
)


def doubling_levels(ids: np.ndarray, doc: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... tokens, until they are unique.

    ``end`` holds the end of each position's document. Equal ranks mean equal prefixes
    within one document; a shorter suffix sorts before its extensions. The last level is
    the inverse of the suffix array.
    """
    n = len(ids)
    key = doc * (int(ids.max()) + 1 if n else 1) + ids
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    size = np.diff(np.r_[first, n])
    rank = np.empty(n, np.int32 if n < 2**31 - 2 else np.int64)
    rank[order] = np.repeat(first, size)
    levels = [rank]
    active = order[np.repeat(size > 1, size)]
    width = 1
    while len(active):
        after = active + width
        inside = after < end[active]
        follow = np.where(inside, rank[np.where(inside, after, 0)].astype(np.int64) + 1, 0)
        base = rank[active].astype(np.int64)
        key = base * (n + 2) + follow
        by = np.argsort(key, kind="stable")
        active, key, base = active[by], key[by], base[by]
        new = np.r_[True, key[1:] != key[:-1]]
        group = np.r_[True, base[1:] != base[:-1]]
        at = np.arange(len(active))
        start = np.maximum.accumulate(np.where(group, at, 0))
        sub = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = base + sub - start
        levels.append(rank)
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(active)])
        active = active[np.repeat(size > 1, size)]
        width *= 2
    return levels


def longest_shared(levels: list[np.ndarray], doc: np.ndarray, end: np.ndarray, at_least: int) -> np.ndarray:
    """For each position, the longest prefix its suffix shares with a neighbour in the
    suffix array of its document, 0 where that is below ``at_least``."""
    n = len(doc)
    best = np.zeros(n, np.int64)
    # Only suffixes whose prefix of the largest level width <= at_least repeats can reach it.
    low = min(int(np.log2(max(at_least, 1))), len(levels) - 1)
    counts = np.bincount(levels[low], minlength=n)
    sa = np.empty(n, np.int64)
    sa[levels[-1]] = np.arange(n)
    left, right = sa[:-1], sa[1:]
    same = (levels[low][left] == levels[low][right]) & (counts[levels[low][left]] > 1)
    left, right = left[same], right[same]
    shared = np.zeros(len(left), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        width, rank = 1 << level, levels[level]
        a, b = left + shared, right + shared
        fits = (a + width <= end[left]) & (b + width <= end[right])
        equal = np.zeros(len(left), bool)
        equal[fits] = rank[a[fits]] == rank[b[fits]]
        shared += width * equal
    shared[shared < at_least] = 0
    np.maximum.at(best, left, shared)
    np.maximum.at(best, right, shared)
    return best


def _streams(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token ids, document number and document end of every token of a block."""
    seen: dict = defaultdict()
    seen.default_factory = seen.__len__
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    ids = np.fromiter((seen[w] for ws in words for w in ws), np.int64, total)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(words)), sizes)
    return ids, doc, ends[doc] if total else ends[:0]


def _spread(at: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Positions covered by any of the spans [at, at + length)."""
    steps = np.bincount(at, minlength=n + 1) - np.bincount(at + length, minlength=n + 1)
    return np.cumsum(steps)[:n] > 0


def _repeat_words(ids: np.ndarray, doc: np.ndarray, end: np.ndarray, docs: int) -> np.ndarray:
    """Words inside three-word windows found twice or more in their document."""
    n = len(ids)
    at = np.flatnonzero(np.arange(n) + 2 < end)
    if not len(at):
        return np.zeros(docs, np.int64)
    wide = int(ids.max()) + 1
    pair = ids[at] * wide + ids[at + 1]
    # Cheap necessary condition first: the window's hash bucket holds two windows or more.
    mixed = ((pair * wide + ids[at + 2]) * docs + doc[at]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (mixed >> np.uint64(42)).astype(np.int64)
    some = np.bincount(bucket, minlength=1 << 22)[bucket] > 1
    at, pair = at[some], pair[some]
    if not len(at):
        return np.zeros(docs, np.int64)
    order = np.lexsort((ids[at + 2], pair, doc[at]))
    at, pair = at[order], pair[order]
    same = (pair[1:] == pair[:-1]) & (ids[at[1:] + 2] == ids[at[:-1] + 2]) & (doc[at[1:]] == doc[at[:-1]])
    twice = np.r_[False, same] | np.r_[same, False]
    at = at[twice]
    covered = _spread(at, np.full(len(at), 3), n)
    return np.bincount(doc[covered], minlength=docs)


def _duplicate_lines(text: str) -> int:
    lines = text.split("\n")
    if len(lines) == 1:
        return 0
    lines = [x for x in lines if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def measure_block(texts: list[str], min_repeat: int) -> list[np.ndarray]:
    words = [_WORD.findall(t) for t in texts]
    docs = len(words)
    ids, doc, end = _streams(words)
    n_words = np.bincount(doc, minlength=docs)
    chars = np.fromiter((len("".join(ws)) for ws in words), np.int64, docs)
    symbols = np.fromiter((sum(t.count(c) for c in _SYMBOLS) for t in texts), np.int64, docs)
    lines = np.fromiter(map(_duplicate_lines, texts), np.int64, docs)
    repeats = _repeat_words(ids, doc, end, docs)
    n = len(ids)
    n_tokens = n_words
    covered, longest = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    if n:
        best = longest_shared(doubling_levels(ids, doc, end), doc, end, min_repeat)
        at = np.flatnonzero(best)
        inside = _spread(at, best[at], n)
        covered = np.bincount(doc[inside], minlength=docs)
        np.maximum.at(longest, doc[at], best[at])
    return [n_words, chars, symbols, lines, repeats, n_tokens, covered, longest]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT) -> DataFrame:
    """One row per input row: its id and the measures, from one pass without a shuffle."""
    common.require(docs, id_col, text_col)
    source = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, j in blocks(texts, len):
                out = measure_block(texts[i:j], min_repeat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *(pa.array(x, pa.int64()) for x in out)],
                    names=[id_col, *(m.split()[0] for m in MEASURES.split(", "))],
                )

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, {MEASURES}")


def judge(
    measures: DataFrame,
    max_covered_percent: int = MAX_COVERED_PERCENT,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """Add base_failed and kept."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    repeated = (100 * F.col("covered_tokens") > max_covered_percent * F.col("n_tokens")) | (
        F.col("longest_repeat") > max_longest
    )
    return measures.withColumn("base_failed", base).withColumn("kept", ~base & ~repeated)


def repetition_rules(docs: DataFrame, **params) -> DataFrame:
    """Measures, base_failed and kept for every row of ``docs``."""
    return judge(measure(docs, **params))
