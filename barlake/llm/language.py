"""Operator 2: language identification by rank-order n-gram profiles.

Text is reduced to lower-case letters with one space between words. A profile lists the
``top`` most frequent n-grams (1 to 3 characters, with the space at a word's ends, never
across words) by falling count, ties by code points. A document gets the language whose
profile is nearest in out-of-place distance: the sum of rank differences, ``top`` for an
n-gram that the profile lacks. Score: 1 - distance / (top * n-grams compared).

Profiles are learned by Spark: each task counts n-grams per language, one shuffle sums
them. At most ``max_docs_per_lang`` documents of a language are used, chosen by the hash
of their id (a documented bound on the training sample only); prediction reads all text.

Defined cases: null text and text without letters give ``und`` and score 0; ties go to the
language first in order; without any training document everything is ``und``; repeated rows are
judged alike; letters of every plane are told apart; training rows with more than ``max_langs`` values of the
language (there are about 8,000 languages) are refused, because the profiles go to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm import common

common.ship(__name__)

TOP = 300
MAX_DOCS_PER_LANG = 20_000
MAX_LANGS = 20_000
UNKNOWN = "und"
_SPACE = 0x20
# Cells of the (text, language) table that are held at once.
CELLS = 4_000_000
BLOCK = 250_000  # code points at work at once, or one longer text
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Lower-case letter of each code point of the basic plane, space where it is no letter."""
    if not _LETTERS:
        table = np.full(0x10000, _SPACE, np.uint16)
        for cp in range(0x10000):
            if chr(cp).isalpha():
                low = chr(cp).lower()
                table[cp] = ord(low) if len(low) == 1 and ord(low) < 0x10000 else cp
        _LETTERS.append(table)
    return _LETTERS[0]


def reduce_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Reduced characters of all texts, each starting and ending with a space, and their text's number."""
    joined = " ".join(["", *(t for t in texts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    doc = np.r_[0, np.repeat(np.arange(len(texts), dtype=np.int64), sizes)]
    far = codes > 0xFFFF
    if far.any():
        plain = np.where(far, 0, codes).astype(np.uint16)
        chars = letters()[plain]
        found, where = np.unique(codes[far], return_inverse=True)
        lower = [chr(c).lower() for c in found]
        chars = chars.astype(np.uint32)
        chars[far] = np.array([(ord(x) if len(x) == 1 else c) if chr(c).isalpha() else _SPACE for c, x in zip(found, lower)], np.uint32)[where]
    else:
        chars = letters()[codes.astype(np.uint16)]
    space = chars == _SPACE
    keep = np.r_[True, ~(space[1:] & space[:-1])]
    return chars[keep], doc[keep]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram, count), sorted by text and n-gram. An n-gram is its characters
    in 21 bits each, first character highest, zero where it is shorter than three."""
    chars, doc = reduce_texts(texts)
    alphabet = np.flatnonzero(np.bincount(chars))
    wide = len(alphabet) + 1
    cube = wide**3
    if cube * (len(texts) + 1) >= 2**62:  # keys would not fit 64 bits
        half = len(texts) // 2
        (d1, g1, n1), (d2, g2, n2) = gram_counts(texts[:half]), gram_counts(texts[half:])
        return np.r_[d1, d2 + half], np.r_[g1, g2], np.r_[n1, n2]
    small = np.zeros(int(alphabet[-1]) + 1, np.int64)
    small[alphabet] = np.arange(1, len(alphabet) + 1)
    c, is_space = small[chars], chars == _SPACE
    one = (c * wide * wide)[~is_space]
    # A space belongs to the word it touches; a pair or triple has no space in its middle.
    two = ((c[:-1] * wide + c[1:]) * wide)[~(is_space[:-1] & is_space[1:])]
    middle = ~is_space[1:-1]
    three = ((c[:-2] * wide + c[1:-1]) * wide + c[2:])[middle] if len(c) > 2 else c[:0]
    # The space between two texts carries the earlier one's number: a pair belongs to its letter's text.
    d2 = np.where(is_space[:-1], doc[1:], doc[:-1])[~(is_space[:-1] & is_space[1:])]
    grams = np.concatenate([one, two, three])
    docs = np.concatenate([doc[~is_space], d2, doc[1:-1][middle]])
    key = docs * cube + grams
    if cube * len(texts) < 2**32:
        key = key.astype(np.uint32)
    key.sort()
    if not len(key):
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    count = np.diff(np.r_[first, len(key)])
    key = key[first].astype(np.int64)
    docs, grams = key // cube, key % cube
    back = np.r_[0, alphabet].astype(np.int64)
    a, b, z = grams // (wide * wide), grams // wide % wide, grams % wide
    return docs, (back[a] << 42) | (back[b] << 21) | back[z], count


def top_grams(docs: np.ndarray, grams: np.ndarray, count: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``top`` n-grams of each text with their ranks."""
    order = np.lexsort((grams, -count, docs))
    docs, grams = docs[order], grams[order]
    start = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else docs
    rank = np.arange(len(docs)) - np.repeat(start, np.diff(np.r_[start, len(docs)]))
    keep = rank < top
    return docs[keep], grams[keep], rank[keep]


class Profiles:
    """Learned profiles: language -> its n-grams in rank order. Held by n-gram: its languages and ranks there."""

    def __init__(self, grams: dict[str, list[int]], top: int):
        self.langs, self.top = sorted(grams), top
        sizes = [len(grams[x]) for x in self.langs]
        gram = np.array([g for x in self.langs for g in grams[x]], np.int64)
        lang = np.repeat(np.arange(len(self.langs), dtype=np.int32), sizes)
        rank = np.concatenate([np.zeros(0, np.int32), *(np.arange(n, dtype=np.int32) for n in sizes)])
        order = np.argsort(gram, kind="stable")
        self.lang, self.rank = lang[order], rank[order]
        self.known, first = np.unique(gram[order], return_index=True)
        self.first = np.r_[first, len(gram)]

    def _nearness(self, text: np.ndarray, grams: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
        """(text, language): how much less than ``top`` an n-gram the distance is. ``text`` counts from 0 to n - 1."""
        at = np.searchsorted(self.known, grams)
        at[at == len(self.known)] = 0
        hit = self.known[at] == grams
        at, text, rank = at[hit], text[hit], rank[hit]
        size = self.first[at + 1] - self.first[at]
        entry = np.arange(size.sum()) + np.repeat(self.first[at] - (np.cumsum(size) - size), size)
        gain = self.top - np.abs(np.repeat(rank, size) - self.rank[entry])
        cell = np.repeat(text, size) * len(self.langs) + self.lang[entry]
        return np.bincount(cell, gain, n * len(self.langs)).astype(np.int64).reshape(n, -1)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        docs, grams, rank = top_grams(*gram_counts(texts), self.top)
        if not len(self.known) or not len(docs):
            return lang, score
        start = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1], True])
        step = max(1, CELLS // len(self.langs))
        for i in range(0, len(start) - 1, step):
            cut = start[i : i + step + 1]
            size, rows = np.diff(cut), slice(cut[0], cut[-1])
            near = self._nearness(np.repeat(np.arange(len(size)), size), grams[rows], rank[rows], len(size))
            best = near.argmax(axis=1)
            who = docs[cut[:-1]]
            for d, k in zip(who, best):
                lang[d] = self.langs[k]
            score[who] = 1.0 - (self.top * size - near[np.arange(len(size)), best]) / (self.top * size)
        return lang, score


def fit_profiles(
    training: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    top: int = TOP,
    max_docs_per_lang: int = MAX_DOCS_PER_LANG,
    max_langs: int = MAX_LANGS,
) -> Profiles:
    """Learn a profile per non-null language. The result has at most ``top`` n-grams per language."""
    common.require(training, id_col, text_col, lang_col)
    rows = training.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string")), F.lit(1_000_003)).alias("draw"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages; is {lang_col} a language column?")
    share = {k: int(1_000_003 * max_docs_per_lang / n) for k, n in sizes.items() if n > max_docs_per_lang}
    if share:
        limit = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])
        rows = rows.where(F.col("draw") < F.coalesce(F.try_element_at(limit, F.col("lang")), F.lit(1_000_003)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for i, j, texts in common.text_blocks(batch.column(1), BLOCK):
                names = sorted(set(langs[i:j]))
                number = np.array([names.index(x) for x in langs[i:j]])
                docs, grams, n = gram_counts(texts)
                order = np.lexsort((grams, number[docs]))
                who, grams, n = number[docs][order], grams[order], n[order]
                first = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (grams[1:] != grams[:-1])])[: len(who)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[k] for k in who[first]], pa.string()),
                        pa.array(grams[first]),
                        pa.array(np.add.reduceat(n, first) if len(first) else n),
                    ],
                    names=["lang", "gram", "n"],
                )

    counts = rows.select("lang", "text").mapInArrow(common.released(count), "lang string, gram long, n long")
    sums = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = sums.withColumn("r", F.row_number().over(by)).where(F.col("r") <= top)
    found: dict[str, list[tuple[int, int]]] = {}
    for r in best.select("lang", "gram", "r").collect():
        found.setdefault(r["lang"], []).append((r["r"], r["gram"]))
    return Profiles({k: [g for _, g in sorted(v)] for k, v in found.items()}, top)


def predict_column(profiles: Profiles, text: Column) -> Column:
    """struct(lang, score) of a text column."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            langs, scores = [], [np.zeros(0)]
            for _, _, texts in common.text_blocks(batch, BLOCK):
                lang, score = profiles.predict([t or "" for t in texts])
                langs += lang
                scores.append(score)
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(np.concatenate(scores))], names=["lang", "score"]
            )

    @F.arrow_udf("lang string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from common.released(run)(batches)

    return predict(text.cast("string"))


def identify(
    docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score"
) -> DataFrame:
    """Add the predicted language and its score to every row."""
    common.require(docs, text_col)
    name = common.unused(docs, "lang")
    found = docs.withColumn(name, predict_column(profiles, F.col(f"`{text_col}`")))
    rest = [F.col(f"`{c}`") for c in common.without(docs, lang_out, score_out).columns]
    return found.select(*rest, F.col(f"{name}.lang").alias(lang_out), F.col(f"{name}.score").alias(score_out))
