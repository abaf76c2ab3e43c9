"""Operator 3: near-duplicate classes by improved consistent weighted sampling (ICWS).

Words are runs of characters other than white space, lower-cased; shingles are five
consecutive words (a shorter text is one shingle). A shingle weighs its count in the
document times its IDF, ``clip(ln(N / df) / ln(1 / RARE), FLOOR, 1)``: full weight up to a
share RARE of the documents, down to FLOOR for boilerplate. df is read from a sketch of
2^16 counters over all documents, less the mean load; its error is a fixed share of
N, whatever the corpus size, and so are its size and the driver's part.

1. Equal word sequences form one class straight away (128-bit digest).
2. ICWS draws BANDS * ROWS samples (shingle, quantised weight) per text; two texts
   agree on a sample with the probability of their weighted Jaccard similarity. A band of
   ROWS equal samples puts texts into one bucket: at 0.8, 20 bands of 5 miss 0.04 %.
3. Within a bucket all texts are compared with one leader, the text that shares its buckets
   with most others (it is nearest the middle of its group); verified pairs (similarity THRESHOLD or
   more, exact) are joined to classes, and the leader leaves. This is linear in the bucket. Two texts whose
   weights alone keep them below THRESHOLD are not compared (similarity is at most the smaller sum over the larger).
4. Buckets that still hold texts of several classes go to cells: a bucket is cut into slices of bounded
   size, and every two slices meet in one cell, which is one group of a task. There each text outside the cell's
   largest class is compared with all others at once, and only the links that join classes come out, less than
   one a text. No pairs are written, no bucket or partner is capped. The work within a cell, and the copies of a bucket of
   many slices, grow with the square of the bucket; only texts that the leader did not settle cause it.
5. Classes are the connected components (large-star / small-star).

Defined cases: texts without words (null, empty) are classes of their own; repeated rows
share a class; the class id is the smallest document id of the class (null only if all
are); other columns pass through. Very long texts are whole weighted sets.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm import common

common.ship(__name__)

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 5
SKETCH = 1 << 16
RARE, FLOOR = 0.1, 0.7
CELLS = 1 << 13
CACHE_SHINGLES = 500_000
CELL = 1_000_000  # weight of a slice: two make a cell of 16 MB of shingle ids
BLOCK = 200_000  # code points; keeps a block's arrays in cache

_WORD = re.compile(common.WORD)
_ID_BITS = 50
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


class WordHashes(dict):
    """64-bit hashes of the words met by one task, bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(words: list[list[str]], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, 50-bit shingle id and count of every distinct shingle, sorted by text and id."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n = int(sizes.sum())
    w = np.fromiter((h for ws in words for h in map(hashes.__getitem__, ws)), np.uint64, n)
    doc = np.repeat(np.arange(len(words)), sizes)
    start = np.cumsum(sizes) - sizes
    left = np.repeat(start + sizes, sizes) - np.arange(n)  # words from here to the text's end
    value = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        part = np.zeros(n, np.uint64)
        part[: max(n - k, 0)] = w[k:]
        if k:
            part[left <= k] = 0
        value += part * np.uint64(_ODD[k])
    first = np.zeros(n, bool)
    first[start[sizes > 0]] = True
    keep = (left >= SHINGLE) | first
    key = (doc[keep].astype(np.uint64) << np.uint64(_ID_BITS)) | (_mix(value[keep]) >> np.uint64(64 - _ID_BITS))
    key.sort()
    if not len(key):
        return doc[:0], key, doc[:0]
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    count = np.diff(np.r_[begin, len(key)])
    key = key[begin]
    return (key >> np.uint64(_ID_BITS)).astype(np.int64), key & np.uint64((1 << _ID_BITS) - 1), count


def _slots(ids: np.ndarray) -> np.ndarray:
    return (ids & np.uint64(SKETCH - 1)).astype(np.int64)


class Icws:
    """Samples of weighted sets. Gamma and uniform draws of a shingle come from one of CELLS
    cells per sample, picked by its hash; equal cells are ordered by the hash itself."""

    def __init__(self, idf: np.ndarray, bands: int = BANDS, rows: int = ROWS):
        rng = np.random.default_rng(20_011)
        n = bands * rows
        self.idf, self.bands, self.rows = idf, bands, rows
        u = 1.0 - rng.random((5, n, CELLS))
        self.r, self.ln_c = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3]))
        self.beta = u[4]
        self.unit = self._order(self.ln_c - self.r * (1 - self.beta))  # ln a at weight 1, where t is 0
        self.odd = (rng.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1)) | np.uint64(1)

    @staticmethod
    def _order(x: np.ndarray) -> np.ndarray:
        """Order-preserving high 32 bits of a float."""
        bits = x.astype(np.float32).view(np.uint32)
        flip = np.where(bits >> 31 == 1, np.uint32(0xFFFFFFFF), np.uint32(0x80000000))
        return (bits ^ flip).astype(np.uint64) << np.uint64(32)

    def bands_of(self, doc: np.ndarray, ids: np.ndarray, count: np.ndarray, docs: int) -> list:
        """The band hashes of each text; None for a text without shingles."""
        out: list = [None] * docs
        if not len(doc):
            return out
        weight = count * self.idf[_slots(ids)]
        start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        other = np.flatnonzero(weight != 1.0)
        ln_w = np.log(weight[other])
        low = np.uint64(0xFFFFFFFF)
        bands = np.zeros((len(start), self.bands), np.uint64)
        for h in range(self.bands * self.rows):
            z = ids * self.odd[h]
            z ^= z >> np.uint64(29)
            cell = (z >> np.uint64(64 - 13)).astype(np.int64) if CELLS == 1 << 13 else (z % np.uint64(CELLS)).astype(np.int64)
            key = self.unit[h][cell] | (z & low)
            if len(other):
                c = cell[other]
                t = np.floor(ln_w / self.r[h][c] + self.beta[h][c])
                ln_a = self.ln_c[h][c] - self.r[h][c] * (t - self.beta[h][c] + 1)
                mark = (t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B1)) & low
                key[other] = self._order(ln_a) | ((z[other] & low) ^ mark)
            sample = np.minimum.reduceat(key, start)
            b = h // self.rows
            bands[:, b] = _mix(bands[:, b] * np.uint64(3) + sample + np.uint64(b + 1))
        for d, row in zip(doc[start].tolist(), bands.view(np.int64)):
            out[d] = row
        return out


def _words(texts: list) -> list[list[str]]:
    return [_WORD.findall(t.lower()) if t else [] for t in texts]


def inverse_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """IDF weight of each sketch counter, from all documents."""
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total, seen = WordHashes(), np.zeros(SKETCH, np.int64), 0
        for batch in batches:
            for _, _, rows in common.text_blocks(batch.column(0), BLOCK):
                words = _words(rows)
                _, ids, _ = shingle_sets(words, hashes)
                total += np.bincount(_slots(ids), minlength=SKETCH)
                seen += sum(map(bool, words))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, at], pa.int32()), pa.array(np.r_[seen, total[at]], pa.int64())], names=["slot", "n"]
        )

    sums = texts.mapInArrow(common.released(count), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    n = int(sums.loc[sums.slot == -1, "n"].sum())
    df = np.zeros(SKETCH)
    own = sums[sums.slot >= 0]
    df[own.slot.to_numpy()] = own.n.to_numpy()
    df = np.maximum(df - df.sum() / SKETCH, 1.0)
    return np.clip(np.log(max(n, 1) / df) / np.log(1 / RARE), FLOOR, 1.0)


def signatures(docs: DataFrame, idf: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """id, t (text key), node (digest of the word sequence, null without words), bands, weight (sum over the shingles)."""
    text = F.col(f"`{text_col}`").cast("string")
    source = docs.select(F.col(f"`{id_col}`").alias("id"), common.text_key(text).alias("t"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, icws = WordHashes(), Icws(idf)
        for batch in batches:
            for i, j, rows in common.text_blocks(batch.column(2), BLOCK):
                words = _words(rows)
                doc, ids, count = shingle_sets(words, hashes)
                bands = icws.bands_of(doc, ids, count, j - i)
                weight = np.bincount(doc, count * idf[_slots(ids)], minlength=j - i)
                node = [hashlib.blake2b(" ".join(w).encode(), digest_size=16).digest() if w else None for w in words]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(1).slice(i, j - i),
                        pa.array(node, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(weight, pa.float64()),
                    ],
                    names=["id", "t", "node", "bands", "weight"],
                )

    kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(common.released(run), f"id {kind}, t string, node binary, bands array<long>, weight double")


def unary(ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A weighted set as a plain one: a shingle of count c becomes c ids of its counter, so that
    the sum of minima of two sets is the weight of the ids that both have. Sorted."""
    more = count - 1
    base = np.repeat(ids, more)
    level = (np.arange(len(base)) - np.repeat(np.cumsum(more) - more, more) + 1).astype(np.uint64)
    slot = np.uint64(SKETCH - 1)
    other = _mix(base + level * np.uint64(_ODD[0])) >> np.uint64(64 - _ID_BITS)
    return np.sort(np.r_[ids, (other & ~slot) | (base & slot)])


def unary_sets(texts: DataFrame) -> DataFrame:
    """node, items (bytes of the 64-bit ids) of rows node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for i, j, rows in common.text_blocks(batch.column(1), BLOCK):
                doc, ids, count = shingle_sets(_words(rows), hashes)
                ends = np.searchsorted(doc, np.arange(j - i + 1))
                items = [unary(ids[x:y], count[x:y]).tobytes() for x, y in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(items, pa.binary())], names=["node", "items"]
                )

    return texts.mapInArrow(common.released(run), "node binary, items binary")


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard of two (ids, weights) sets with sorted ids."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    same = a[0][at] == b[0]
    both = np.minimum(a[1][at[same]], b[1][same]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def _verified(pairs: DataFrame, sets: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """The pairs (leader, node) whose sets reach the threshold."""
    member = sets.select(F.col("node"), F.col("items").alias("b"))
    leader = sets.select(F.col("node").alias("leader"), F.col("items").alias("a"))
    both = pairs.join(member, "node").join(leader, "leader").select("leader", "node", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}  # the weighted sets of the leaders met last, at most CACHE_SHINGLES in all
        held = 0

        def weighted(items: pa.Scalar) -> tuple:
            ids = np.frombuffer(items.as_buffer(), np.uint64)
            return ids, idf[_slots(ids)]

        for batch in batches:
            leaders = batch.column(0).to_pylist()
            ok = []
            for k, name in enumerate(leaders):
                if name not in cache:
                    one = weighted(batch.column(2)[k])
                    if held + len(one[0]) > CACHE_SHINGLES:
                        cache.clear()
                        held = 0
                    held += len(one[0])
                    cache[name] = one[0].copy(), one[1]
                ok.append(similarity(cache[name], weighted(batch.column(3)[k])) >= threshold - 1e-9)
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["leader", "node"]
            )

    return both.mapInArrow(common.released(run), "leader binary, node binary")


def join_classes(sets: list[np.ndarray], labels: np.ndarray, idf: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Pairs of similar sets that join the classes ``labels`` to their final ones within these sets."""
    sizes = np.array([len(x) for x in sets])
    start = np.cumsum(sizes) - sizes
    ids, at = np.unique(np.concatenate(sets), return_inverse=True)
    weight = idf[_slots(ids)]
    total = np.add.reduceat(weight[at], start)
    _, label = np.unique(labels, return_inverse=True)
    main = int(np.bincount(label).argmax())
    mark, links = np.zeros(len(ids)), []
    for x in np.flatnonzero(label != main).tolist():
        if label[x] == main:  # joined to it by an earlier text
            continue
        own = at[start[x] : start[x] + sizes[x]]
        mark[own] = weight[own]
        both = np.add.reduceat(mark[at], start)
        mark[own] = 0
        near = (both >= (threshold - 1e-9) * (total[x] + total - both)) & (label != label[x])
        for y in np.flatnonzero(near).tolist():
            if label[y] != label[x]:
                links.append((x, y))
                to, gone = (label[y], label[x]) if label[y] == main else (label[x], label[y])
                label[label == gone] = to
    return links


def _cells(mixed: DataFrame, sets: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """u, v: links between the classes of the buckets of ``mixed`` (bucket, node, n, weight, label)."""
    size = mixed.groupBy("bucket").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.least(F.count("*"), F.ceil(F.sum("weight") / CELL)).alias("parts")
    )
    live = mixed.join(size.where("lo < hi").select("bucket", "parts"), "bucket").withColumn("part", F.expr("pmod(n, parts)"))
    # Of several slices every two meet; so do the texts of one slice, wherever it is.
    cell = F.expr(
        "CASE WHEN parts = 1 THEN array(0L) ELSE transform(filter(sequence(0L, parts - 1), x -> x <> part),"
        " x -> least(x, part) * parts + greatest(x, part)) END"
    )
    spread = live.select("bucket", "node", "label", F.explode(cell).alias("cell"))

    def run(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_pylist()
        own = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("items")]
        links = join_classes(own, group.column("label").to_numpy(), idf, threshold)
        ends = [pa.array([nodes[link[side]] for link in links], pa.binary()) for side in (0, 1)]
        return pa.table(ends, names=["u", "v"])

    return spread.join(sets, "node").groupBy("bucket", "cell").applyInArrow(run, "u binary, v binary")


def components(edges: DataFrame, scratch: common.Scratch) -> DataFrame:
    """node, label (smallest node of its component) for the nodes of undirected edges u, v; a
    label's own row is left out. Large-star and small-star steps until nothing changes."""
    pairs = F.struct(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = scratch.write(edges.select(pairs.alias("p")).select("p.u", "p.v").where("u > v").distinct())
    mark = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        last, edges = edges, scratch.write(small.union(least.select("u", "m")).distinct())
        scratch.drop(last)
        # Count and sum of hashes tell whether the step changed the edges.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        mark = now


def _number(node: str) -> Column:
    """A long from a node digest, so that aggregates over nodes stay hash aggregates."""
    return F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("long")


def _links(sig: DataFrame, docs: DataFrame, idf: np.ndarray, id_col: str, text_col: str, threshold: float, scratch: common.Scratch):
    """node, label of all texts that share a class with a different text; None if there are none."""
    nodes = sig.where("node IS NOT NULL").select("node", "bands", "weight").dropDuplicates(["node"])
    numbered = nodes.select("node", _number("node").alias("n"), "weight", F.posexplode("bands").alias("b", "h"))
    spread = numbered.select(F.xxhash64("b", "h").alias("bucket"), "node", "n", "weight")
    common_buckets = spread.groupBy("bucket").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).where("lo < hi").select("bucket")
    members = scratch.write(spread.join(common_buckets, "bucket"))
    # A text that shares its buckets with many others is close to the middle of its group: it leads.
    sizes = members.groupBy("bucket").agg(F.count("*").alias("k"))
    degree = scratch.write(members.join(sizes, "bucket").groupBy("node").agg(F.sum("k").alias("degree")))
    last, members = members, scratch.write(members.join(degree, "node").select("bucket", "node", "n", "weight", "degree"))
    scratch.drop(last, degree)
    wanted = members.select("node").distinct()
    rows = sig.join(wanted, "node").groupBy("node").agg(F.min(F.struct("id", "t")).alias("r")).select("node", "r.id", "r.t")
    text = F.col(f"`{text_col}`").cast("string")
    source = docs.select(F.col(f"`{id_col}`").alias("did"), common.text_key(text).alias("dt"), text.alias("text"))
    texts = source.join(rows, F.col("did").eqNullSafe(F.col("id")) & (F.col("dt") == F.col("t"))).select("node", "text")
    sets = scratch.write(unary_sets(texts.dropDuplicates(["node"])))
    order = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("degree"), "n"))
    names = {"node": "leader", "degree": "ld", "n": "ln", "weight": "lw"}
    leaders = members.withColumn("r", order).where("r = 1").withColumnsRenamed(names)
    leaders = scratch.write(leaders.select("bucket", *names.values()))
    close = F.least("weight", "lw") >= (threshold - 1e-6) * F.greatest("weight", "lw")
    pairs = members.join(leaders, "bucket").where(F.col("node") != F.col("leader")).where(close).select("leader", "node").distinct()
    edges = scratch.write(_verified(pairs, sets, idf, threshold).select(F.col("leader").alias("u"), F.col("node").alias("v")))
    labels = None if edges.isEmpty() else components(edges, scratch)
    rest = members.join(leaders.select("bucket", F.col("leader").alias("node")), ["bucket", "node"], "left_anti")
    rest = rest.withColumn("label", F.col("n")) if labels is None else _labelled(rest, labels)
    rest = scratch.write(rest)
    more = scratch.write(_cells(rest, sets, idf, threshold))
    if not more.isEmpty():
        labels = components(more if labels is None else more.union(labels.select("node", "label")), scratch)
    scratch.drop(members, leaders, sets, edges, rest, more)
    return labels


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with the number of their class."""
    named = labels.select("node", _number("label").alias("l"))
    return members.join(named, "node", "left").select("bucket", "node", "n", "weight", F.coalesce("l", "n").alias("label"))


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float, scratch: common.Scratch) -> DataFrame:
    """id, t and label (null without words) of every row, written; rows of one class share the label."""
    common.require(docs, id_col, text_col)
    idf = inverse_frequencies(docs, text_col)
    sig = scratch.write(signatures(docs, idf, id_col, text_col))
    labels = _links(sig, docs, idf, id_col, text_col, threshold, scratch)
    rows = sig.select("id", "t", "node")
    if labels is None:
        return scratch.write(rows.select("id", "t", F.col("node").alias("label")))
    out = scratch.write(rows.join(labels, "node", "left").select("id", "t", F.coalesce("label", "node").alias("label")))
    scratch.drop(sig)
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: its id and class_id."""
    scratch = common.Scratch(docs.sparkSession)
    rows = _classes(docs, id_col, text_col, threshold, scratch)
    # Written first, so that the join shuffles both sides and a hot class can be split.
    least = scratch.write(rows.where("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("class_id")))
    return rows.join(least, "label", "left").select(
        F.col("id").alias(id_col), F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, one of each class: the smallest (id, text key). Rows without words stay."""
    scratch = common.Scratch(docs.sparkSession)
    rows = _classes(docs, id_col, text_col, threshold, scratch)
    several = scratch.write(rows.where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n")).where("n > 1"))
    own = scratch.write(rows.join(several.select("label"), "label"))
    best = scratch.write(own.groupBy("label").agg(F.min(F.struct("id", "t")).alias("best")))
    judged = own.join(best, "label").select("id", "t", F.struct("id", "t").eqNullSafe(F.col("best")).alias("stays"))
    drop = judged.groupBy("id", "t").agg(F.first("stays").alias("stays"), F.count("*").alias("copies"))
    # The only columns beside the input's are a struct and a key whose names it does not have.
    drop = scratch.write(drop.where("NOT stays OR copies > 1"))
    got, key = common.unused(docs, "drop"), common.unused(docs, "key")
    text = F.col(f"`{text_col}`").cast("string")
    match = F.col(f"`{id_col}`").eqNullSafe(F.col(f"{got}.id")) & (common.text_key(text) == F.col(f"{got}.t"))
    out = docs.join(drop.select(F.struct("id", "t").alias(got)), match, "left_anti")
    repeated = drop.where("stays")
    if not repeated.isEmpty():  # rows that repeat the id and text of the one that stays
        again = docs.join(repeated.select(F.struct("id", "t").alias(got)), match, "left_semi")
        out = out.union(again.withColumn(key, common.text_key(text)).dropDuplicates([id_col, key]).drop(key))
    return out
