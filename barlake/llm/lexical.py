"""Operator 12: ranked lexical search with a document FP-tree.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, only A-Z
lower-cased. N counts the documents with a term, L all their terms, n a document's terms, df the
documents that hold a term, tf a term's occurrences. A term weighs
``w = floor(1000 ln((2N + 2) / (2 df + 1)))``; a document's length norm is
``m = 25 + (75 n N) div L``; its score sums ``w * ((10^9 tf) div (1000 tf + 8 m))`` over the item's
terms, repeats included, in 64-bit integers.

1. One pass over the documents cuts the texts and keeps, of each, n and its vector restricted to
   the items' terms; the vectors are written to the shared folder, and N, L and df follow from them.
2. A task reads its vectors in chunks of ``CHUNK_ENTRIES`` entries. A chunk's vectors, their terms ordered from the
   most frequent to the rarest, form an FP-tree: documents with the same first terms share a path, and
   chains without a branch are one edge. Documents with equal vectors and norms are one leaf. Every
   node knows the largest tf of each term and the smallest m below it; both bound the
   score of all documents below, because the score grows with tf and falls with m.
3. Per item the tree is searched depth first, the child with the best bound first. A subtree whose bound is
   below the k-th best score found so far by this task is skipped; equal bounds are not, so ties are
   whole. Bounds and scores of all children of a node are computed at once.
4. The best k of each task meet in a window per item.

What the driver and the tasks hold of the items is a block of at most ``ITEM_CHARS`` characters (or one
longer item); further blocks are further passes. Every document is searched; there is no candidate limit.

Defined cases: null and empty texts have no terms and never appear; an item without terms, or whose
terms no document holds, has no rows; repeated document rows rank as rows of their own, in any order
among themselves; equal scores rank by ascending id, null first; every row of the items is an item, also where its
id repeats or is null; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from barlake.llm import common

common.ship(__name__)

TOP = 10
ITEM_CHARS = 4_000_000
CHUNK_ENTRIES = 3_000_000
LEAF = 16  # so few documents are the children of one node

# Bytes of terms stay (A-Z as a-z), all others are blanks.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_TERM_BYTES).split() if text else []


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """(number, id, terms) of the items, in blocks of bounded size."""
    block, size = [], 0
    rows = items.select(F.col(f"`{item_col}`"), F.col(f"`{text_col}`").cast("string"))
    for number, (item, text) in enumerate(rows.toLocalIterator()):
        if block and size + len(text or "") > ITEM_CHARS:
            yield block
            block, size = [], 0
        block.append((number, item, terms(text)))
        size += len(text or "")
    if block:
        yield block


def restricted_vectors(docs: DataFrame, known: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """id, n, and the vector over the known terms (terms ascending, tf), of all documents with a term."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, vocabulary = shared.value.get, len(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in common.blocks(texts, lambda t: len(t or "")):
                words = [terms(t) for t in texts[i:j]]
                n = np.fromiter(map(len, words), np.int64, j - i)
                found = np.fromiter((number(w, -1) for ws in words for w in ws), np.int64, int(n.sum()))
                doc = np.repeat(np.arange(j - i), n)
                key, tf = np.unique((doc * vocabulary + found)[found >= 0], return_counts=True)
                ends = np.searchsorted(key, np.arange(j - i + 1) * vocabulary)
                offsets = pa.array(ends, pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array(n),
                        pa.ListArray.from_arrays(offsets, pa.array(key % vocabulary, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32())),
                    ],
                    names=["id", "n", "terms", "tf"],
                )
                yield out.filter(pa.array(n > 0))

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n long, terms array<int>, tf array<int>")


class Descending:
    """Sort key in descending order; a key is (is not null, id)."""

    __slots__ = ("key",)

    def __init__(self, key: tuple):
        self.key = key

    def __lt__(self, other: Descending) -> bool:
        return other.key < self.key

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Descending) and self.key == other.key


class Node:
    """A node's children: for each the terms below it with their largest tf, and the smallest m."""

    __slots__ = ("child", "term", "tf", "m", "nodes")

    def __init__(self, child: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, nodes: list):
        self.child, self.term, self.tf, self.m, self.nodes = child, term, tf, m, nodes

    def bounds(self, weight: np.ndarray) -> np.ndarray:
        """Of each child the score, if it is a document, or a bound of all scores below it."""
        w = weight[self.term]
        at = np.flatnonzero(w)
        out = np.zeros(len(self.m), np.int64)
        if len(at):
            child, tf = self.child[at], self.tf[at]
            part = w[at] * ((1_000_000_000 * tf) // (1000 * tf + 8 * self.m[child]))
            first = np.flatnonzero(np.r_[True, child[1:] != child[:-1]])
            out[child[first]] = np.add.reduceat(part, first)
        return out


class FpTree:
    """Documents as (sort keys of ids, m, vectors); the terms of a vector are numbered from the most frequent."""

    def __init__(self, ids: list, m: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray, vocabulary: int):
        raw = term.astype(">u4").tobytes()
        counts = tf.astype("<i8").tobytes()
        # Documents in the order of their paths; equal vectors and norms side by side.
        keys = [(raw[4 * a : 4 * b], counts[8 * a : 8 * b], x) for a, b, x in zip(ends[:-1].tolist(), ends[1:].tolist(), m.tolist())]
        order = sorted(range(len(ids)), key=keys.__getitem__)
        self.leaves: list[list] = []
        paths, firsts, last = [], [], None
        for i in order:
            if keys[i] != last:
                last = keys[i]
                self.leaves.append([])
                paths.append(last[0])
                firsts.append(i)
            self.leaves[-1].append(ids[i])
        for leaf in self.leaves:
            leaf.sort()
        first = np.array(firsts)
        size = (ends[1:] - ends[:-1])[first]
        self.end = np.r_[0, np.cumsum(size)]
        take = np.arange(self.end[-1]) + np.repeat(ends[:-1][first] - self.end[:-1], size)
        self.term, self.tf, self.m = term[take].astype(np.int64), tf[take].astype(np.int64), m[first]
        self.doc = np.repeat(np.arange(len(first)), size)
        self.buffer = np.zeros(vocabulary, np.int64)
        self.root = self._build(self._shared(paths))

    @staticmethod
    def _shared(paths: list[bytes]) -> np.ndarray:
        """Number of first terms that each path shares with the one before it."""
        out = np.zeros(len(paths), np.int64)
        for i in range(1, len(paths)):
            a, b = paths[i - 1], paths[i]
            k = min(len(a), len(b))
            if a[:k] == b[:k]:
                out[i] = k // 4
            else:
                x = np.frombuffer(a, np.uint8, k) != np.frombuffer(b, np.uint8, k)
                out[i] = int(x.argmax()) // 4
        return out

    def _build(self, shared: np.ndarray) -> Node:
        spans, children = [(0, len(self.leaves))], [[]]
        at = 0
        while at < len(spans):  # a node follows its parent
            lo, hi = spans[at]
            if hi - lo > LEAF:
                # The paths part where they share least.
                inner = shared[lo + 1 : hi]
                cuts = [lo, *(lo + 1 + np.flatnonzero(inner == inner.min())).tolist(), hi]
                for a, b in zip(cuts, cuts[1:]):
                    # A leaf by its number, a node by its negative number.
                    children[at].append(a if b - a == 1 else -len(spans))
                    if b - a > 1:
                        spans.append((a, b))
                        children.append([])
            at += 1
        nodes: list[Node | None] = [None] * len(spans)
        below: list = [None] * len(spans)  # terms, largest tf, smallest m
        for at in range(len(spans) - 1, -1, -1):
            lo, hi = spans[at]
            if not children[at]:
                a, b = self.end[lo], self.end[hi]
                nodes[at] = Node(self.doc[a:b] - lo, self.term[a:b], self.tf[a:b], self.m[lo:hi], list(range(lo, hi)))
                parts = [(self.term[x:y], self.tf[x:y]) for x, y in zip(self.end[lo:hi], self.end[lo + 1 : hi + 1])]
                least = int(self.m[lo:hi].min())
            else:
                parts, norms, inside = [], [], []
                for c in children[at]:
                    if c >= 0:
                        parts.append((self.term[self.end[c] : self.end[c + 1]], self.tf[self.end[c] : self.end[c + 1]]))
                        norms.append(int(self.m[c]))
                        inside.append(c)
                    else:
                        parts.append(below[-c][:2])
                        norms.append(below[-c][2])
                        inside.append(nodes[-c])
                        below[-c] = None
                sizes = [len(p[0]) for p in parts]
                nodes[at] = Node(
                    np.repeat(np.arange(len(parts)), sizes), np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
                    np.array(norms, np.int64), inside,
                )
                least = min(norms)
            buffer = self.buffer
            for t, f in parts:
                buffer[t] = np.maximum(buffer[t], f)
            held = np.flatnonzero(buffer)
            below[at] = held, buffer[held], least
            buffer[held] = 0
        return nodes[0]

    def search(self, weight: np.ndarray, best: list, top: int) -> None:
        """Branch and bound, depth first; ``best`` is a heap of at most ``top`` (score, id), the worst first."""
        stack: list = [(0, self.root)]
        while stack:
            bound, node = stack.pop()
            least = best[0][0] if len(best) == top else 1
            if isinstance(node, Node):
                if bound < least and node is not self.root:
                    continue
                bounds = node.bounds(weight)
                wanted = np.flatnonzero(bounds >= least)
                # The best bound is popped first.
                for c in wanted[np.argsort(bounds[wanted], kind="stable")].tolist():
                    stack.append((int(bounds[c]), node.nodes[c]))
            elif bound >= least:
                for key in self.leaves[node][:top]:
                    entry = (bound, Descending(key))
                    if len(best) < top:
                        heapq.heappush(best, entry)
                    elif best[0] < entry:
                        heapq.heapreplace(best, entry)


def rank_chunks(batches: Iterator[pa.RecordBatch], order: np.ndarray, weights: list, total: int, length: int, top: int) -> list[list]:
    """Each item's best (score, id) of one task. ``order``: number of a term, most frequent first;
    ``weights``: per item its terms (by that number) and their weights."""
    best: list[list] = [[] for _ in weights]
    held: list[tuple] = []

    def search() -> None:
        ids = [i for part in held for i in part[0]]
        n, sizes, term, tf = (np.concatenate([part[k] for part in held]) for k in range(1, 5))
        held.clear()
        doc, term = np.repeat(np.arange(len(ids)), sizes), order[term]
        by_path = np.lexsort((term, doc))
        ends = np.r_[0, np.cumsum(sizes)]
        m = 25 + (75 * n * total) // length
        tree = FpTree(ids, m, ends, term[by_path], tf[by_path], len(order))
        weight = np.zeros(len(order), np.int64)
        for heap, (at, w) in zip(best, weights):
            weight[at] = w
            tree.search(weight, heap, top)
            weight[at] = 0

    size = 0
    for batch in batches:
        step = 10_000
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            ids = [(x is not None, x) for x in part.column(0).to_pylist()]
            term, tf = part.column(2), part.column(3)
            sizes = np.diff(term.offsets.to_numpy())
            held.append((ids, part.column(1).to_numpy(), sizes, term.flatten().to_numpy().astype(np.int64), tf.flatten().to_numpy().astype(np.int64)))
            size += int(sizes.sum()) + len(ids)
            if size >= CHUNK_ENTRIES:
                search()
                size = 0
    if held:
        search()
    return best


def _best_of_block(vectors: DataFrame, block: list[tuple], known: dict[bytes, int], kinds: StructType, top: int) -> DataFrame:
    """number, item, id and score of the best documents of each task for each item of the block."""
    total, length = vectors.agg(F.count("*"), F.sum("n")).first()
    counts = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # at most the block's terms
    df = np.zeros(len(known), np.int64)
    for t, count in counts:
        df[t] = count
    order = np.empty(len(known), np.int64)
    order[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    value = [math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in df.tolist()]
    weights = []
    for _, _, words in block:
        repeats = Counter(known[w] for w in words)
        at = np.fromiter(repeats, np.int64, len(repeats))
        weights.append((order[at], np.array([value[t] * r for t, r in repeats.items()], np.int64)))
    shared = vectors.sparkSession.sparkContext.broadcast((order, weights, [b[0] for b in block], [b[1] for b in block]))
    schema = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, weights, numbers, items = shared.value
        best = rank_chunks(batches, order, weights, total, length, top)
        rows = [(n, i, d.key[1], s) for n, i, heap in zip(numbers, items, best) for s, d in heap]
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
        if rows:
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return vectors.mapInArrow(run, kinds)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """item_col, rank, id_col and score: the ``top`` best documents of every item."""
    common.require(docs, id_col, text_col)
    common.require(items, item_col, item_text_col)
    spark = docs.sparkSession
    kinds = StructType(
        [
            StructField("number", LongType()),
            StructField("item", items.schema[item_col].dataType),
            StructField("id", docs.schema[id_col].dataType),
            StructField("score", LongType()),
        ]
    )
    out = spark.createDataFrame([], kinds).withColumn("rank", F.lit(0))
    for block in item_blocks(items, item_col, item_text_col):
        known: dict[bytes, int] = {}
        for _, _, words in block:
            for w in words:
                known.setdefault(w, len(known))
        if not known:
            continue
        scratch = common.Scratch(spark)
        vectors = scratch.write(restricted_vectors(docs, known, id_col, text_col))
        if vectors.isEmpty():
            continue
        best = _best_of_block(vectors, block, known, kinds, top)
        place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("id")))
        out = out.union(scratch.write(best.withColumn("rank", place).where(F.col("rank") <= top)))
        scratch.drop(vectors)
    return out.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
