"""Operator 11: byte-level BPE encoding and decoding by a global shuffle of distinct words.

Reads a public rank file (one base64 token and its rank a line; the path is a parameter)
and a pattern that cuts a text into pre-tokens ("words"), each of which is encoded on its own.

1. Documents are cut into words, block by block (``BLOCK_CHARS`` code points, or one longer
   text). A block keeps its texts as sequences of local word numbers: the position of a word is
   its place in the sequence. Its distinct words go out once each, packed by hash bucket.
2. One exchange deals words to their bucket and sequences to their block. A bucket sees a word of
   the whole corpus in one place and encodes it once.
3. The ids go back to the blocks by a second exchange and are put in place of the word numbers.

A frequent word crosses the exchanges once per block, without its positions, so no key is hot:
what a word adds is at most one of the block's distinct words. No text is shuffled. The words' memory is
bounded by a bucket (``BUCKETS_PER_PARTITION`` per shuffle partition, a setting that follows the
input), the sequences' by a block. Blocks are named by their content: where a lost
task is run again over an input that came out in another order, the ids do not fit and the task fails
instead of returning wrong tokens.

Decoding joins the tokens with the table of token bytes (bounded by the rank file) by position:
the bytes of a row are a slice of the joined column. A batch is decoded ``DECODE_TOKENS`` at a time.

Defined cases: null and empty texts have no tokens and decode to no bytes; null and unknown ids
decode to no bytes; repeated rows are encoded alike; all other columns pass through, whatever
their names; the text column is not carried (decoding gives it back); an input column with the output's name
is replaced. Characters newer than the Unicode version of the ``regex`` package may be cut otherwise
than in other libraries.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from barlake.llm import bpe, common

common.ship(__name__)

BLOCK_CHARS = 8_000_000
PART_CHARS = 1_000_000  # of a block that are at work at once
DECODE_TOKENS = 250_000  # that are decoded at once, or one longer row
BUCKETS_PER_PARTITION = 4
WORDS = pa.schema([("n", pa.int32()), ("word", pa.string())])
IDS = pa.schema([("n", pa.int32()), ("ids", pa.list_(pa.int32()))])
ROW = "key long, block long, payload binary"


def word_pattern(pattern: str) -> regex.Pattern:
    r"""The pattern with Unicode White_Space for \s (Python's \s holds four control characters more)."""
    inside = regex.sub(r"\[\^([^\]]*)\\s", lambda m: f"[^{m[1]}{bpe.SPACE}", pattern)
    return regex.compile(inside.replace(r"\S", f"[^{bpe.SPACE}]").replace(r"\s", f"[{bpe.SPACE}]"))


class Ranks:
    """Encoder of single words by a rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pair = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pair[a, b] = (rank, rank)

    def encode(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        parts = [self.single[b] for b in data]
        return (bpe.merge_short if len(parts) <= bpe.SHORT_WORD else bpe.merge_long)(parts, self.pair)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


class Numbers(dict):
    """Local numbers of a block's words, in the order of their first occurrence."""

    def __missing__(self, word: str) -> int:
        out = self[word] = len(self)
        return out


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload) as stream:
        return stream.read_next_batch()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    key, block, payload = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(block, pa.int64()), pa.array(payload, pa.binary())], names=["key", "block", "payload"]
    )


def _cut(pattern: str, at: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of the input: rows with word numbers (key: block, negative) and the words (key: bucket)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_pattern(pattern).findall
        numbers, parts, size, made = Numbers(), [], 0, 0
        task = TaskContext.get()
        name = xxhash.xxh3_64()

        def block() -> Iterator[pa.RecordBatch]:
            name.update(f"{task.partitionId() if task else 0}:{made}:{len(numbers)}")
            key = -(name.intdigest() >> 1) - 1
            yield _rows([(key, i, _pack(p)) for i, p in enumerate(parts)])
            found = list(numbers)
            dealt = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in found), np.uint64, len(found)) % np.uint64(buckets)
            order = np.argsort(dealt, kind="stable")
            ends = np.searchsorted(dealt[order], np.arange(buckets + 1, dtype=np.uint64))
            out = []
            for b in np.flatnonzero(np.diff(ends)).tolist():
                n = order[ends[b] : ends[b + 1]]
                step = pa.array(np.diff(n, prepend=0), pa.int32())
                out.append((b, key, _pack(pa.RecordBatch.from_arrays([step, pa.array([found[i] for i in n.tolist()], pa.string())], schema=WORDS))))
            if out:
                yield _rows(out)

        for batch in batches:
            rest = batch.drop_columns([batch.schema.names[at]])
            for i, j, texts in common.text_blocks(batch.column(at), min(PART_CHARS, BLOCK_CHARS)):
                sequences = []
                for text in texts:
                    found = list(map(numbers.__getitem__, words(text))) if text else []
                    sequences.append(np.array(found, np.int32))
                    name.update(text or "")
                    size += len(text or "")
                ends = np.cumsum([0, *map(len, sequences)])
                flat = np.concatenate(sequences)
                # Byte planes: the high bytes are nearly all zero and vanish when packed.
                planes = [pa.array(((flat >> (8 * k)) & 255).astype(np.uint8)) for k in range(4)]
                planes = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), p) for p in planes]
                parts.append(pa.RecordBatch.from_arrays([*rest.slice(i, j - i).columns, *planes], names=[str(k) for k in range(rest.num_columns + 4)]))
                if size >= BLOCK_CHARS:
                    yield from block()
                    numbers, parts, size, made = Numbers(), [], 0, made + 1
                    name = xxhash.xxh3_64()
        if parts:
            yield from block()

    return run


def _encode_words(file: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by key: every distinct word of a bucket is encoded once; its ids go to the blocks that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, bucket = None, None
        ids: dict[str, np.ndarray] = {}
        for batch in batches:
            keys, blocks, payloads = (batch.column(i) for i in range(3))
            out = []
            for i, key in enumerate(keys.to_pylist()):
                if key < 0:
                    continue  # a block's rows
                ranks = ranks or Ranks(read_ranks(SparkFiles.get(file)))
                if key != bucket:
                    ids, bucket = {}, key
                words = _unpack(payloads[i].as_py())
                found = []
                for word in words.column(1).to_pylist():
                    got = ids.get(word)
                    if got is None:
                        got = ids[word] = np.array(ranks.encode(word), np.int32)
                    found.append(got)
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                coded = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found)))
                out.append((blocks[i].as_py(), key, _pack(pa.RecordBatch.from_arrays([words.column(0), coded], schema=IDS))))
            if out:
                yield _rows(out)

    return run


def _lists(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and flat values of a list column."""
    ends = values.offsets.to_numpy()
    return ends - ends[0], values.flatten().to_numpy()


def _put_back(schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One block: ids in place of the word numbers."""

    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        try:
            return block(rows, replies)
        finally:
            common.release()

    def block(rows: pa.Table, replies: pa.Table) -> pa.Table:
        parts = rows.sort_by("block").column("payload").to_pylist() if rows.num_rows and rows.column("key")[0].as_py() < 0 else []
        if not parts:
            return schema.empty_table()
        numbers, sizes, flats = [], [], []
        for payload in replies.column("payload").to_pylist():
            reply = _unpack(payload)
            ends, flat = _lists(reply.column(1))
            numbers.append(np.cumsum(reply.column(0).to_numpy()))
            sizes.append(np.diff(ends))
            flats.append(flat)
        none = np.zeros(0, np.int64)
        number, size, flat = (np.concatenate(x) if x else none for x in (numbers, sizes, flats))
        begin = np.cumsum(size) - size
        starts, lengths = np.full(len(number), -1, np.int64), np.zeros(len(number), np.int64)
        starts[number], lengths[number] = begin, size
        out = []
        for payload in parts:
            part = _unpack(payload)
            at = part.num_columns - 4
            ends, low = _lists(part.column(at))
            sequence = low.astype(np.int64)
            for k in range(1, 4):
                sequence |= _lists(part.column(at + k))[1].astype(np.int64) << (8 * k)
            if len(sequence) and (sequence.max() >= len(starts) or starts[sequence].min() < 0):
                raise ValueError("a block's words came back incomplete: its input changed when a task ran again; checkpoint the input")
            n = lengths[sequence]
            before = np.cumsum(n) - n
            take = np.arange(int(n.sum())) + np.repeat(starts[sequence] - before, n)
            bounds = np.r_[before, n.sum()][ends]
            tokens = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat[take].astype(np.int32)))
            out.append(pa.Table.from_arrays([*part.columns[:at], tokens], names=schema.names))
        return pa.concat_tables(out)

    return run


def encode(docs: DataFrame, ranks: str, pattern: str, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    """The columns of ``docs`` but the text, and ``out_col``: the token ids (array of int) of the whole text."""
    common.require(docs, text_col)
    spark = docs.sparkSession
    kept = [f for f in docs.schema.fields if f.name not in (text_col, out_col) and f.name.lower() != out_col.lower()]
    file = bpe._ship_file(spark, ranks)
    source = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").cast("string"))
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One exchange for both kinds of rows: it is written once and read by both sides below.
    dealt = source.mapInArrow(common.released(_cut(pattern, len(kept), buckets)), ROW).repartition("key")
    coded = dealt.sortWithinPartitions("key").mapInArrow(common.released(_encode_words(file)), ROW)
    schema = StructType([*kept, StructField(out_col, ArrayType(IntegerType()))])
    return dealt.groupBy("key").cogroup(coded.groupBy("key")).applyInArrow(_put_back(to_arrow_schema(schema)), schema)


def decode_batches(known: dict[bytes, int], batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Bytes of batches of token ids, block by block."""
    strings = [b""] * (max(known.values()) + 2)  # the last one for unknown ids
    for token, rank in known.items():
        strings[rank] = token
    table = pa.array(strings, pa.large_binary())
    none = len(strings) - 1
    for batch in batches:
        all_ends = batch.offsets.to_numpy()
        for start, stop in common.blocks(np.diff(all_ends).tolist(), int, DECODE_TOKENS):
            ends = all_ends[start : stop + 1] - all_ends[start]
            ids = batch.values.slice(all_ends[start], ends[-1]).fill_null(-1).to_numpy()
            joined = table.take(pa.array(np.where((ids < 0) | (ids >= none), none, ids)))
            _, places, data = joined.buffers()
            places = np.frombuffer(places, np.int64)[joined.offset : joined.offset + len(joined) + 1] if len(joined) else np.zeros(1, np.int64)
            bounds = pa.array(places[ends], pa.int64())
            out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), stop - start, [None, bounds.buffers()[1], data])
            yield out.cast(pa.binary())


def decode(encoded: DataFrame, ranks: str, tokens_col: str = "tokens", out_col: str = "decoded") -> DataFrame:
    """Add ``out_col``: the bytes of every row's token ids."""
    common.require(encoded, tokens_col)
    file = bpe._ship_file(encoded.sparkSession, ranks)

    @F.arrow_udf("binary")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from common.released(lambda x: decode_batches(read_ranks(SparkFiles.get(file)), x))(batches)

    ids = F.coalesce(F.col(f"`{tokens_col}`").cast("array<int>"), F.array().cast("array<int>"))
    return common.append(encoded, out_col, text(ids))
