"""Operator 13: spelling variant grouping with a bit-sliced position index.

Words are the distinct maximal runs of A-Z, a-z and U+00C0..U+00FF, only A-Z lower-cased, of at least
``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences in the table. With h the CRC-32 of
``<id>:<run>``, a run with h divisible by ``TYPO`` first loses its code point ``h % length`` (such
made typos come with the contract; ``typo=None`` turns them off). Two words are near if they differ by one
inserted, deleted or replaced code point. A word's form is its near word of largest count (ties:
smallest in code-point order) if that count is at least twice the word's; following forms leads to the root.

1. Each task counts its own words; one exchange adds the counts up.
2. The vocabulary is dealt to shards in which near words meet. Of two near words, the shorter one of l code
   points, either the first l div 2 agree or the last l - l div 2 do. So a word goes to four shards: with its
   first and with its last half, as a word of l and as one of l + 1.
3. A shard's bit-sliced position index holds, per position and letter, the set of words with that letter
   there, one bit a word, from the front. For every word of the shard the sets of words that agree without an
   error, and with one replaced, inserted or deleted letter, are carried along its letters: the sets of
   positions one before and one behind give insertions and deletions. Each step treats all words of the
   shard at once. Pairs that already met by their first half are masked out in the other shard.
4. Near pairs are counted, and the best is taken, by one aggregate with partial sums. Forms are followed by
   joins that double their reach; a form's count at least doubles with each step, so their number is at most
   the logarithm of the largest count's logarithm.

A shard of more than ``SHARD`` words is cut into slices; each of its words is asked of every slice, so a
task holds at most one slice's index, whatever the shard's size, and no word or pair is left out.

Defined cases: null and empty texts have no words; a null id stands as an empty string in h; repeated rows
count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import common

common.ship(__name__)

MIN_LENGTH, MIN_COUNT, TYPO = 5, 3, 97
SHARD = 20_000
COUNTED = 400_000  # words that a task counts before it hands them on

# Latin-1 bytes of word letters stay (A-Z as a-z), all others are blanks.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> list[bytes]:
    """The lower-cased runs of a text, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int | None = TYPO) -> DataFrame:
    """word, n (long) of all words long and frequent enough."""
    source = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.col(f"`{text_col}`").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = defaultdict(int)
        plain: dict[bytes, bytes] = {}  # UTF-8 of words beyond ASCII

        def counts() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in total]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not text:
                    continue
                start = zlib.crc32(f"{key}:".encode())
                for word, n in Counter(runs(text)).items():
                    if typo:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % typo == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= MIN_LENGTH:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield counts()
                    total.clear()
        yield counts()

    found = source.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


class PositionIndex:
    """Sets of words (bits of an integer) by position and letter, and by length."""

    def __init__(self, words: list[str]):
        at: list[dict[str, int]] = [defaultdict(int) for _ in range(max(map(len, words), default=0) + 1)]
        length: dict[int, int] = defaultdict(int)
        for i, word in enumerate(words):
            bit = 1 << i
            length[len(word)] |= bit
            for p, letter in enumerate(word):
                at[p][letter] |= bit
        self.at = [dict(x) for x in at]
        self.length, self.all = dict(length), (1 << len(words)) - 1

    def near(self, word: str, shorter: int, half: int = 0) -> int:
        """The set of words at one edit from ``word``, where the shorter of the two has length ``shorter``.

        After i letters of the word ``zero`` are the words with the same first i letters. With one error
        ``same`` have reached i letters (one replaced), ``more`` i + 1 (one inserted) and ``less`` i - 1 (one left out).
        Words that share the first ``half`` letters are left out, if it is not 0.
        """
        at, top = self.at, len(self.at)
        zero, same, more, less, met = self.all, 0, 0, 0, 0
        before: dict[str, int] = {}
        for i, letter in enumerate(word):
            row = at[i] if i < top else {}
            here = row.get(letter, 0)
            after = at[i + 1].get(letter, 0) if i + 1 < top else 0
            more = (more | zero) & after
            less = (less & before.get(letter, 0)) | zero
            same = (same & here) | (zero & ~here)
            zero &= here
            before = row
            if i + 1 == half:
                met = zero
        n, size = len(word), self.length
        if n == shorter:
            out = (same & size.get(n, 0)) | ((more | zero) & size.get(n + 1, 0))
        else:
            out = less & size.get(shorter, 0)
        return out & ~met


def shard_rows(words: DataFrame) -> DataFrame:
    """shard, shorter, half, word, n: a word's four shards. ``half`` is 0 in shards of first halves."""
    roles = words.withColumn("shorter", F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)))
    roles = roles.where(F.col("shorter") >= MIN_LENGTH).withColumn("h", F.expr("shorter div 2").cast("int"))
    first = F.struct(F.concat_ws(" ", F.lit("first"), "shorter", F.expr("left(word, h)")).alias("shard"), F.lit(0).alias("half"))
    last = F.struct(F.concat_ws(" ", F.lit("last"), "shorter", F.expr("right(word, shorter - h)")).alias("shard"), F.col("h").alias("half"))
    return roles.select("shorter", "word", "n", F.explode(F.array(first, last)).alias("s")).select("s.shard", "shorter", "s.half", "word", "n")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, slice, own first): of each word its near words in the slice."""
    at, own, index = None, [], None
    out: list[tuple] = []

    def ask(word: str, shorter: int, half: int) -> None:
        found = index.near(word, shorter, half)
        count, best, best_n = 0, "", -1
        while found:
            low = found & -found
            found ^= low
            other, n = own[low.bit_length() - 1]
            count += 1
            if n > best_n or (n == best_n and other < best):
                best, best_n = other, n
        if count:
            out.append((word, count, -best_n, best))

    def close() -> None:
        nonlocal index
        if own and index is None:
            index = PositionIndex([w for w, _ in own])
            for word, _ in own:
                ask(word, *at[2:])

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[], [], [], []]
        out.clear()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "minus_n", "form"])

    for batch in batches:
        for shard, part, shorter, half, word, n, mine in zip(*(c.to_pylist() for c in batch.columns)):
            here = (shard, part, shorter, half)
            if here != at:
                if len(own) > 1 or index:
                    close()
                at, own, index = here, [], None
            if mine:
                own.append((word, n))
            else:
                close()
                if own:
                    ask(word, shorter, half)
        if len(out) >= 10_000:
            yield flush()
    if len(own) > 1:
        close()
    yield flush()


def near_words(words: DataFrame, scratch: common.Scratch, shard: int = SHARD) -> DataFrame:
    """word, n_near, form (the best near word), form_n, of all words that have a near word."""
    rows = shard_rows(words)
    # Written first, so that a hot shard can be split in the join.
    sizes = scratch.write(rows.groupBy("shard").count().where("count > 1"))
    slices = F.ceil(F.col("count") / shard).cast("int")
    dealt = rows.join(sizes, "shard").select("*", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("word"), slices) == F.col("slice"))
    dealt = dealt.select("shard", "slice", "shorter", "half", "word", "n", "own")
    dealt = dealt.repartition("shard", "slice").sortWithinPartitions("shard", "slice", F.desc("own"))
    found = dealt.mapInArrow(_search, "word string, n_near long, minus_n long, form string")
    best = F.min(F.struct("minus_n", "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", "best.form", (-F.col("best.minus_n")).alias("form_n")
    )


def roots(forms: DataFrame, scratch: common.Scratch) -> DataFrame:
    """word, root for the (word, form) rows: forms are followed to the last one."""
    steps = scratch.write(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not steps.where("moved").isEmpty():
        ahead = steps.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = steps.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        last, steps = steps, scratch.write(moved)
        scratch.drop(last)
    return steps.select("word", "root")


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int | None = TYPO, shard: int = SHARD
) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the table."""
    common.require(docs, id_col, text_col)
    scratch = common.Scratch(docs.sparkSession)
    words = scratch.write(word_counts(docs, id_col, text_col, typo))
    near = near_words(words, scratch, shard)
    clear = F.col("form_n") >= 2 * F.col("n")
    known = scratch.write(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(clear, F.col("form")).alias("form"), F.when(clear, F.col("form_n")).alias("form_n")
        )
    )
    last = roots(known.where("form IS NOT NULL"), scratch)
    return known.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
