"""Operator 9 against the tokenizers library on the same file."""

import json
import random
import tracemalloc

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from barlake.llm import bpe
from barlake.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return bpe.WordBpe(json.load(f))


def ids(own, text):
    return [i for p in own.piece.findall(text) for i in own.encode_piece(p)]


def test_random_texts(own, library):
    r = random.Random(1)
    pool = "aàÀÉ1 2.'’sS!\t\n\x1c\x85́Σσ<|startoftext|>ABC日本é​🙂"
    for _ in range(3_000):
        text = "".join(r.choice(pool) for _ in range(r.randint(0, 200)))
        if r.random() < 0.3:
            text += r.choice(["<|startoftext|>", "<|endoftext|>"]) + text[::-1]
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(own, text) == want
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("word", ["a" * 5_000, "ab" * 3_000, "théréin" * 900, "x" * 64, "x" * 65])
def test_long_words(own, library, word):
    assert ids(own, word) == library.encode(word, add_special_tokens=False).ids


def test_operator(spark, documents, edges, texts, library):
    path = tokenizer_path()
    both = bpe.decode(bpe.encode(documents, path), path)
    got = {r["doc_id"]: r for r in both.collect()}
    for doc_id, text, _ in texts:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert list(got[doc_id]["tokens"]) == want
        assert got[doc_id]["decoded"] == library.decode(want, skip_special_tokens=False)
    rows = bpe.decode(bpe.encode(edges, path, out_col="kept"), path, tokens_col="kept", out_col="lang").collect()
    assert len(rows) == edges.count()
    assert all(list(r["kept"]) == [] and r["lang"] == "" for r in rows if not (r["text"] or "").strip())
    assert bpe.encode(edges.limit(0), path).count() == 0


def test_white_space_of_pieces(own):
    text = "a\x1cb\x1dc\x1ed\x1fe f\x85g h　i​j\x0bk"
    assert own.pieces(text) == own.piece.findall(text)
    assert own.pieces(text.replace("\x1c", " ")) == own.piece.findall(text.replace("\x1c", " "))
    for c in filter(str.isspace, map(chr, range(0x110000))):
        assert own.pieces(f"a{c}b") == own.piece.findall(f"a{c}b")


def peak_mb(batches):
    """Most Python memory and the most values of a batch that goes out; batches are not kept."""
    tracemalloc.start()
    sizes = [len(b.flatten()) if pa.types.is_list(b.type) else b.nbytes for b in batches]
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most, max(sizes)


def test_large_batches_are_taken_block_by_block(own):
    texts = pa.array([None, "", *["Some words, and more of them. " * 100] * 3_000, "one " * 100_000], pa.string())
    most, values = peak_mb(bpe.encode_batches(own, iter([texts])))
    assert most < 20 and values <= 250_000
    found = list(bpe.encode_batches(own, iter([texts.slice(1), texts.slice(0, 1)])))
    coded = pa.concat_arrays(found)
    assert coded.to_pylist()[-2:] == [ids(own, "one " * 100_000), []]
    assert len(coded) == len(texts) and len(coded[1]) == len(coded[3_000]) == len(ids(own, texts[2].as_py()))
    most, values = peak_mb(bpe.decode_batches(own.strings, iter([coded])))
    assert most < 20 and values < 4_000_000
    decoded = pa.concat_arrays(list(bpe.decode_batches(own.strings, iter([coded.slice(2_999)]))))
    assert decoded.to_pylist() == [own.decode(i) for i in coded.slice(2_999).to_pylist()]


def test_full_caches(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    texts = ["one two three four five one, two. (three) four;", "five one two's " + "long" * 50, "one two three"] * 3
    found = pa.concat_arrays(list(bpe.encode_batches(own, iter([pa.array(texts)]))))
    assert found.to_pylist() == [library.encode(t, add_special_tokens=False).ids for t in texts]
