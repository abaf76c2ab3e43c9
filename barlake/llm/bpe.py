"""Operator 9: BPE encoding and decoding with a contiguous rank array.

Reads a public tokenizer file of the kind "lower-cased words with an end-of-word mark"
(JSON; its path is a parameter). Text is cut at white space; a piece is split at the
special tokens, composed (NFC), lower-cased and split into words by the file's pattern.
A word's symbols are its mapped bytes, the last one carrying the end mark. A short word
keeps its part boundaries and the rank of each adjacent pair in one contiguous array:
scan for the smallest rank, delete that boundary, refresh the two neighbouring ranks. A
word beyond ``SHORT_WORD`` symbols uses the same rule with a heap and links, so that a
very long word does not cost its length squared. Equal pieces and words are encoded once
per task, as long as ``CACHE_PIECES`` and ``CACHE_WORDS`` hold them. A task cuts each Arrow batch
into blocks of ``BLOCK`` bytes of text or tokens (or one longer row), each of which goes out on its
own: besides the batch, its memory is bounded by the caches and a block.

Defined cases: null and empty texts have no tokens and decode to an empty text; special
token strings in a text become their special ids; repeated rows are encoded alike.
Decoding is the file's own (no decoder: token strings joined by one space). Letters newer
than Unicode 15.1 (Python's tables) may be cased or split otherwise than in other libraries.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import common

common.ship(__name__)

SHORT_WORD = 64
CACHE_PIECES = 200_000
CACHE_WORDS = 200_000
# Bytes of text (encoding) or tokens (decoding) handled at once inside a task.
BLOCK = 250_000
NO_RANK = 1 << 60
# Unicode White_Space, at which no word continues.
SPACE = "\t-\r \x85\xa0  -     　"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others for U+0100 onwards."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [], 0x100
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def merge_short(parts: list[int], pair: dict) -> list[int]:
    """Merge symbol ids by the contiguous rank array. ``pair``: (a, b) -> (rank, merged)."""
    parts = list(parts)
    none = (NO_RANK, -1)
    ranks = [pair.get((parts[i], parts[i + 1]), none) for i in range(len(parts) - 1)]
    while ranks:
        best = min(ranks)
        if best[0] == NO_RANK:
            break
        at = ranks.index(best)
        parts[at] = best[1]
        del parts[at + 1], ranks[at]
        if at:
            ranks[at - 1] = pair.get((parts[at - 1], parts[at]), none)
        if at < len(ranks):
            ranks[at] = pair.get((parts[at], parts[at + 1]), none)
    return parts


def merge_long(parts: list[int], pair: dict) -> list[int]:
    """The same merges for a long word: smallest rank first, leftmost first."""
    n = len(parts)
    parts = list(parts)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []
    for i in range(n - 1):
        found = pair.get((parts[i], parts[i + 1]))
        if found:
            heap.append((found[0], i, parts[i], parts[i + 1], found[1]))
    heapq.heapify(heap)
    while heap:
        _, i, a, b, merged = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or not alive[i] or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j] = merged, False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n:
                found = pair.get((parts[k], parts[after[k]]))
                if found:
                    heapq.heappush(heap, (found[0], k, parts[k], parts[after[k]], found[1]))
    return [p for p, ok in zip(parts, alive) if ok]


def token_strings(spec: dict) -> dict[int, str]:
    """id -> token string of a tokenizer file."""
    model = spec["model"]
    steps = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
    if model["type"] != "BPE" or steps != ["Split", "ByteLevel"] or spec["decoder"] or model["byte_fallback"]:
        raise ValueError("expected a byte-level word BPE file without a decoder")
    return {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, spec: dict):
        self.strings = token_strings(spec)
        model = spec["model"]
        vocab, self.mark = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.mark] for s in symbols]
        self.pair = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pair.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE))
        self.piece = regex.compile(f"[^{SPACE}]+")
        self.separator = re.compile("[\x1c-\x1f]")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words: dict[str, tuple[int, ...]] = {}

    def encode_word(self, word: str) -> Sequence[int]:
        known = self.words.get(word)
        if known is not None:
            return known
        data = word.encode("utf-8")
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        if len(parts) > SHORT_WORD:
            return merge_long(parts, self.pair)
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        out = self.words[word] = tuple(merge_short(parts, self.pair))
        return out

    def pieces(self, text: str) -> list[str]:
        """A text's parts between white space."""
        # str.split also cuts at U+001C to U+001F, which are no White_Space.
        return self.piece.findall(text) if self.separator.search(text) else text.split()

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of a text without white space."""
        ids: list[int] = []
        for part in self.marks.split(piece) if any(map(piece.__contains__, self.special)) else [piece]:
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                # Lower-casing goes letter by letter: no final sigma.
                plain = part if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ")
                for word in self.word.findall(plain.lower()):
                    ids += self.encode_word(word)
        return ids

    def decode(self, ids) -> str:
        return " ".join([self.strings[i] for i in ids if i in self.strings])


class Pieces(dict):
    """Encoded pieces of one task: piece -> ids as little-endian int32 bytes."""

    def __init__(self, bpe: WordBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        out = np.array(self.bpe.encode_piece(piece), "<i4").tobytes()
        if len(piece) <= 4 * SHORT_WORD:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = out
        return out


def _read(name: str) -> dict:
    with open(SparkFiles.get(name), encoding="utf-8") as f:
        return json.load(f)


def _ship_file(spark: SparkSession, path: str) -> str:
    """Distribute the tokenizer file to all executors; returns its name there."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def _column(df: DataFrame, name: str) -> Column:
    common.require(df, name)
    return F.col(f"`{name}`")


def encode_batches(bpe: WordBpe, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Token ids of batches of texts, block by block."""
    pieces = Pieces(bpe)
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch), 0).to_pylist()
        for start, stop in common.blocks(sizes, int, BLOCK):
            texts = batch.slice(start, stop - start).to_pylist()
            found = [b"".join(map(pieces.__getitem__, bpe.pieces(t))) if t else b"" for t in texts]
            ends = np.cumsum([0, *(len(x) // 4 for x in found)])
            if ends[-1] >= 2**31:
                raise ValueError("more than 2^31 tokens in a text")
            values = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def decode_batches(strings: dict[int, str], batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Texts of batches of token ids, block by block."""
    table = np.array([strings.get(i, "") for i in range(max(strings) + 1)], object)
    known = np.array([i in strings for i in range(len(table))])
    for batch in batches:
        all_ends = batch.offsets.to_numpy()
        for start, stop in common.blocks(np.diff(all_ends).tolist(), int, BLOCK):
            ends = all_ends[start : stop + 1] - all_ends[start]
            flat = batch.values.slice(all_ends[start], ends[-1]).fill_null(-1).to_numpy().astype(np.int64)
            good = (flat >= 0) & (flat < len(table))
            good[good] = known[flat[good]]
            out = []
            for i in range(stop - start):
                part = slice(ends[i], ends[i + 1])
                out.append(" ".join(table[flat[part][good[part]]].tolist()))
            yield pa.array(out, pa.string())


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    """Add ``out_col``: the token ids (array of int) of every row's whole text."""
    text = _column(docs, text_col).cast("string")
    name = _ship_file(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = WordBpe(_read(name))
        common.release()  # the file as read
        yield from encode_batches(bpe, batches)

    @F.arrow_udf("array<int>")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from common.released(run)(batches)

    return common.without(docs.withColumn("__tokens", tokens(text)), out_col).withColumnRenamed("__tokens", out_col)


def decode(encoded: DataFrame, tokenizer: str, tokens_col: str = "tokens", out_col: str = "decoded") -> DataFrame:
    """Add ``out_col``: the text of every row's token ids; unknown ids are skipped, null is empty."""
    ids = _column(encoded, tokens_col)
    name = _ship_file(encoded.sparkSession, tokenizer)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        strings = token_strings(_read(name))
        common.release()  # the file as read
        yield from decode_batches(strings, batches)

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from common.released(run)(batches)

    return common.without(encoded.withColumn("__text", text(ids)), out_col).withColumnRenamed("__text", out_col)
