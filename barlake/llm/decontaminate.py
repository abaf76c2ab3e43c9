"""Operator 4: benchmark decontamination with suffix arrays over the training text.

Each task takes its share of the documents as shards of bounded size. A shard's words
that occur in the benchmark get their ids, others zero. Its suffix array holds the
suffixes that can match: those that start with a benchmark item's word pair (a shorter
suffix for one-word items), sorted by their first words (the window, rounded up to fours), packed four to a 64-bit
number. Every benchmark suffix is binary-searched in every shard by its first ``window``
words (all its words in a shorter item), which gives a range of suffixes: all verbatim
occurrences. Neighbouring windows on one diagonal join to the longest match.

The benchmark is the stated query set. It is sent to the executors in blocks of at most
``BLOCK_WORDS`` words, so what is shipped has a proven bound; the passes' results are
summed per document. Words: A-Z lower-cased, then runs of characters outside the ASCII
punctuation and space.

Defined cases: null or empty texts have no words and are never contaminated; items
without words never occur; a null item id is reported as "null"; repeated items and
rows are matched alike; other columns pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm import common
from barlake.llm.common import blocks

common.ship(__name__)

WINDOW = 13
BLOCK_WORDS = 60_000  # word ids fit in 16 bits
CLEAN_CHARS = 500_000  # of remove_contaminated: code points at work at once, or one longer text
BORDERS = pa.list_(pa.struct([(x, pa.int64()) for x in ("item", "shift", "start", "stop")]))
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower())


class Queries:
    """The suffixes of a block of benchmark items, ready for the binary search."""

    def __init__(self, items: list[tuple[str, int, int, int, list[str]]], window: int):
        """``items``: name, number, place of the first word in the item, the item's length, words."""
        if window < 2:
            raise ValueError("window must be 2 or more")
        self.window = window
        self.depth = -(-window // 4) * 4  # words of a suffix that are sorted
        # Equal items are one, under several names; pieces of a longer item keep their place in it.
        same: dict[tuple, set] = {}
        for name, number, place, length, ws in items:
            cut = len(ws) < length
            same.setdefault((tuple(ws), number if cut else -1, place, length), set()).add(name)
        self.names = list(same.values())
        self.cuts = [(number, place, length - len(ws)) for ws, number, place, length in same]
        self.lengths = [len(ws) for ws, *_ in same]
        items = [(None, ws) for ws, *_ in same]
        vocab: dict[str, int] = {}
        found: dict[tuple, list[tuple[int, int]]] = {}
        for k, (_, ws) in enumerate(items):
            ids = tuple(vocab.setdefault(w, len(vocab) + 1) for w in ws)
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                found.setdefault(ids[i : i + size], []).append((k, i))
        if len(vocab) >= 1 << 16:
            raise ValueError("block of benchmark items has too many different words")
        self.vocab = vocab
        self.windows = list(found)
        self.places = [found[w] for w in self.windows]
        self.sizes = np.array([len(w) for w in self.windows], np.int64)
        flat = np.zeros((len(self.windows), self.depth), np.uint64)
        for i, w in enumerate(self.windows):
            flat[i, : len(w)] = w
        self.low = pack(flat)
        mask = np.arange(self.depth)[None, :] >= self.sizes[:, None]
        flat[mask] = 0xFFFF
        self.high = pack(flat)
        self.pairs = np.zeros(1 << 20, bool)
        starts = np.array([w[:2] for w in self.windows if len(w) > 1], np.uint64).reshape(-1, 2)
        self.pairs[pair_slot(starts[:, 0], starts[:, 1])] = True
        self.single = np.zeros(1 << 16, bool)
        self.single[[w[0] for w in self.windows if len(w) == 1]] = True


def pair_slot(a, b):
    with np.errstate(over="ignore"):
        return ((a * np.uint64(0x10001) + b) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)


def pack(tokens: np.ndarray) -> list[np.ndarray]:
    """Columns of four 16-bit words each."""
    four = np.uint64(16) * np.arange(3, -1, -1, dtype=np.uint64)
    return [(tokens[:, i : i + 4] << four).sum(axis=1, dtype=np.uint64) for i in range(0, tokens.shape[1], 4)]


def _bound(sa: list[np.ndarray], key: list[np.ndarray], upper: bool) -> np.ndarray:
    """Binary search of all keys at once: the first suffix not below (above, if upper) each key."""
    n, q = len(sa[0]), len(key[0])
    lo, hi = np.zeros(q, np.int64), np.full(q, n, np.int64)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = np.minimum((lo + hi) // 2, n - 1)
        less, equal = np.zeros(q, bool), np.ones(q, bool)
        for s, k in zip(sa, key):
            v = s[mid]
            less |= equal & (v < k)
            equal &= v == k
        right = less | equal if upper else less
        lo = np.where(open_ & right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)


def search_shard(ids: np.ndarray, end: np.ndarray, q: Queries) -> tuple[np.ndarray, np.ndarray]:
    """(position, window number) of every occurrence in a shard. ``end``: end of each word's document."""
    n = len(ids)
    at = np.arange(n)
    follows = np.zeros(n, np.uint64)
    follows[:-1] = ids[1:]
    follows[at + 1 >= end] = 0
    can = (ids > 0) & ((follows > 0) & q.pairs[pair_slot(ids, follows)] | q.single[ids.astype(np.int64)])
    at = at[can]
    if not len(at) or not len(q.windows):
        return at[:0], at[:0]
    tokens = np.zeros((len(at), q.depth), np.uint64)
    for k in range(q.depth):
        inside = at + k < end[at]
        tokens[inside, k] = ids[at[inside] + k]
    sa = pack(tokens)
    order = np.lexsort(sa[::-1])
    sa, at = [s[order] for s in sa], at[order]
    lo, hi = _bound(sa, q.low, False), _bound(sa, q.high, True)
    size = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(lo)), size)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    return at[np.repeat(lo, size) + offset], which


def match_block(texts: list[str], q: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """n_words of each text, and (text, position in it, window number) of every occurrence."""
    get, found = q.vocab.get, [words(t) for t in texts]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    total = int(sizes.sum())
    ids = np.fromiter((i for ws in found for i in map(get, ws, repeat(0))), np.uint64, total)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(found)), sizes)
    where, which = search_shard(ids, ends[doc], q)
    return sizes, doc[where], where - (ends - sizes)[doc[where]], which, q.sizes[which]


def benchmark_blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[Queries]:
    """Read the query set partition by partition, in blocks of at most BLOCK_WORDS words
    (items beyond that are cut into overlapping pieces under the same name)."""
    items, size = [], 0
    step = BLOCK_WORDS - window + 1
    rows = benchmark.select(
        F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t")
    )
    for number, r in enumerate(rows.toLocalIterator()):
        ws = words(r["t"] or "")
        name = "null" if r["i"] is None else r["i"]
        for k in range(0, max(len(ws) - window + 1, 1), step):
            part = ws[k : k + BLOCK_WORDS]
            if size and size + len(part) > BLOCK_WORDS:
                yield Queries(items, window)
                items, size = [], 0
            items.append((name, number, k, len(ws), part))
            size += len(part)
    yield Queries(items, window)


def _scan(docs: DataFrame, q: Queries, key: str, text_col: str) -> DataFrame:
    """One pass over all documents: words, runs of hit words and items per document."""
    source = docs.select(F.col(f"`{key}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, j in blocks(texts, len):
                sizes, doc, at, which, length = match_block(texts[i:j], q)
                order = np.lexsort((at, doc))
                doc, at, which, length = doc[order], at[order], which[order], length[order]
                spans: list[list] = [[] for _ in range(j - i)]
                items: list[set] = [set() for _ in range(j - i)]
                longest = np.zeros(j - i, np.int64)
                borders: list[list] = [[] for _ in range(j - i)]
                runs: dict = {}
                for d, p, w, n in zip(doc.tolist(), at.tolist(), which.tolist(), length.tolist()):
                    own = spans[d]
                    if own and p <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], p + n)
                    else:
                        own.append([p, p + n])
                    for item, k in q.places[w]:
                        items[d] |= q.names[item]
                        # Windows that follow each other in document and item are one match.
                        run_start = runs.pop((d, item, p - 1, k - 1), p)
                        runs[d, item, p, k] = run_start
                        longest[d] = max(longest[d], p + n - run_start)
                for (d, item, p, k), run_start in runs.items():
                    number, place, cut = q.cuts[item]
                    n = min(q.window, q.lengths[item])
                    # A match that reaches the cut end of a piece may go on in the next piece.
                    if cut and (k - (p - run_start) == 0 or k + n == q.lengths[item]):
                        borders[d].append({"item": number, "shift": p - k - place, "start": run_start, "stop": p + n})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array(sizes, pa.int64()),
                        pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], SPANS),
                        pa.array([sorted(s) for s in items], pa.list_(pa.string())),
                        pa.array(longest, pa.int64()),
                        pa.array(borders, BORDERS),
                    ],
                    names=[key, "n_words", "spans", "items", "longest_match", "borders"],
                )

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"`{key}` {kind}, n_words long, spans array<struct<start:long,stop:long>>, items array<string>, longest_match long, "
        "borders array<struct<item:long,shift:long,start:long,stop:long>>",
    )


def _longer(x: Column, b: Column) -> Column:
    """The state of the border matches read so far (the last joined match and the longest) after one more."""
    goes_on = (x["item"] == b["item"]) & (x["shift"] == b["shift"]) & (b["start"] <= x["stop"])
    start = F.when(goes_on, x["start"]).otherwise(b["start"])
    stop = F.when(goes_on, F.greatest(x["stop"], b["stop"])).otherwise(b["stop"])
    most = F.greatest(x["most"], stop - start)
    fields = [b["item"].alias("item"), b["shift"].alias("shift"), start.alias("start"), stop.alias("stop"), most.alias("most")]
    return F.struct(*fields)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Per row of ``docs``: id, n_words, spans (hit word ranges, the matches' locations),
    items (ids of occurring items), longest_match (words), n_hit and contaminated.

    One pass without a shuffle while the benchmark fits one block; more blocks are read and run one by
    one and summed per (id, text), with the same result. Contaminated: n_hit > 0 and 20 * n_hit >= n_words.
    """
    common.require(docs, id_col, text_col)
    common.require(benchmark, item_col, item_text_col)
    parts = benchmark_blocks(benchmark, window, item_col, item_text_col)
    first, second = next(parts), next(parts, None)
    if second is None:
        found = _scan(docs, first, id_col, text_col).drop("borders")
    else:
        # One block at a time on the driver and in a job; its results are written to the shared folder.
        scratch = common.Scratch(docs.sparkSession)
        keyed = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), common.text_key(F.col(f"`{text_col}`")).alias("t")).alias("_key"), F.col(f"`{text_col}`"))
        n_parts, union = 0, None
        for q in chain([first, second], parts):
            scan = scratch.write(_scan(keyed, q, "_key", text_col))
            union = scan if union is None else union.unionAll(scan)
            n_parts += 1
        # Repeated rows: as many results as rows, each block gives one per row.
        merged = union.groupBy("_key").agg(
            F.max("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            F.max("longest_match").alias("longest_match"),
            F.array_sort(F.flatten(F.collect_set("borders"))).alias("borders"),
            F.expr(f"CAST(count(*) / {n_parts} AS int)").alias("copies"),
        )
        merge = F.aggregate(
            "spans",
            F.expr("CAST(array() AS array<struct<start:long,stop:long>>)"),
            lambda done, s: F.when(
                (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= s["start"]),
                F.concat(
                    F.slice(done, 1, F.size(done) - 1),
                    F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop"))),
                ),
            ).otherwise(F.concat(done, F.array(s))),
        )
        # Matches of one item on one diagonal that overlap at the border of two pieces are one match.
        joined = F.aggregate(
            "borders",
            F.expr("named_struct('item', -1L, 'shift', 0L, 'start', 0L, 'stop', 0L, 'most', 0L)"),
            lambda x, b: _longer(x, b),
        )["most"]
        merged = merged.withColumn("longest_match", F.greatest("longest_match", joined))
        found = (
            merged.withColumn("spans", F.when(F.size("spans") > 0, merge).otherwise(F.col("spans")))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(F.col("_key.id").alias(id_col), "n_words", "spans", "items", "longest_match")
        )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated: one pass without a shuffle where the
    benchmark fits one block, else :func:`find_contamination` by text. The rule is the same.
    """
    common.require(docs, text_col)
    parts = benchmark_blocks(benchmark, window, item_col, item_text_col)
    q, more = next(parts), next(parts, None)
    parts.close()
    if more is not None:
        # Several blocks: a text's verdict is found block by block, and joined by the text's key.
        text = F.col(f"`{text_col}`").cast("string")
        keyed = docs.select(common.text_key(text).alias("key"), text.alias("text"))
        found = find_contamination(keyed, benchmark, "key", "text", item_col, item_text_col, window)
        bad = common.unused(docs, "bad")
        keys = common.Scratch(docs.sparkSession).write(found.where("contaminated").select(F.col("key").alias(bad)).distinct())
        return docs.join(keys, common.text_key(text) == F.col(bad), "left_anti")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for i, j, texts in common.text_blocks(batch, CLEAN_CHARS):
                sizes, doc, at, _, length = match_block([t or "" for t in texts], q)
                starts = np.cumsum(sizes) - sizes
                hit = np.zeros(int(sizes.sum()) + 1, np.int64)
                np.add.at(hit, starts[doc] + at, 1)
                np.add.at(hit, starts[doc] + at + length, -1)
                inside = np.cumsum(hit)[:-1] > 0
                n_hit = np.bincount(np.repeat(np.arange(j - i), sizes)[inside], minlength=j - i)
                out.append(~((n_hit > 0) & (20 * n_hit >= sizes)))
            yield pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from common.released(run)(batches)

    return docs.where(clean(F.col(f"`{text_col}`").cast("string")))
