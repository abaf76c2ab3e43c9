"""Operator 11 against the tiktoken library on the same file."""

import random

import public_tokenizers
import pytest
import tiktoken

from barlake.llm import word_bpe
from barlake.llm.queries import rank_path

PATH = rank_path()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=word_bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def own():
    return word_bpe.Ranks(word_bpe.read_ranks(PATH))


def ids(own, text):
    return [i for w in word_bpe.word_pattern(public_tokenizers.PATTERN).findall(text) for i in own.encode(w)]


def test_random_texts(own, library):
    r = random.Random(3)
    pool = "aàÀÉ1 2.'’sS!\t\n\x1c\x85́Σσ<|endoftext|>ABC日本é​🙂  \r\n'll're"
    for _ in range(3_000):
        text = "".join(r.choice(pool) for _ in range(r.randint(0, 200)))
        assert ids(own, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("word", ["a" * 5_000, "ab" * 3_000, "théréin" * 900, "x" * 64, "x" * 65, " " * 300, "\n" * 300])
def test_long_words(own, library, word):
    assert ids(own, word) == library.encode_ordinary(word)


def both(docs, **names):
    coded = word_bpe.encode(docs, PATH, public_tokenizers.PATTERN, **names)
    return word_bpe.decode(coded, PATH, tokens_col=names.get("out_col", "tokens"))


def test_operator(spark, documents, texts, library, monkeypatch):
    for limit in (word_bpe.BLOCK_CHARS, 5_000):  # many texts to a block, and blocks of a few
        monkeypatch.setattr(word_bpe, "BLOCK_CHARS", limit)
        got = {r["doc_id"]: r for r in both(documents).collect()}
        assert len(got) == len(texts)
        for doc_id, text, _ in texts:
            want = library.encode_ordinary(text or "")
            assert got[doc_id]["tokens"] == want
            assert bytes(got[doc_id]["decoded"]) == (text or "").encode()


def test_edges(spark, edges, library):
    assert both(edges).columns == ["doc_id", "lang", "kept", "tokens", "decoded"]
    docs = edges.selectExpr("doc_id", "text", "kept AS key", "lang AS block", "text AS payload", "lang AS TOKENS")
    rows = both(docs).collect()
    assert sorted(str(r["key"]) for r in rows) == sorted(str(r["kept"]) for r in edges.collect())
    for r in rows:
        assert r["tokens"] == library.encode_ordinary(r["payload"] or "")
        assert bytes(r["decoded"]) == (r["payload"] or "").encode()
    assert both(edges.limit(0)).count() == 0
    odd = spark.createDataFrame([([1, None, -5, 10**6, 2],), (None,), ([],)], "t array<int>")
    got = [bytes(r["decoded"]) for r in word_bpe.decode(odd, PATH, "t").collect()]
    assert got == [library.decode_bytes([1, 2]), b"", b""]


def test_words_and_sequences_share_one_exchange(spark, documents):
    out = word_bpe.encode(documents.select("doc_id", "text"), PATH, public_tokenizers.PATTERN)
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") == 1


def test_decoding_holds_a_block(monkeypatch):
    """A batch is decoded block by block; a row's bytes do not depend on where a block ends."""
    import pyarrow as pa

    known = word_bpe.read_ranks(PATH)
    monkeypatch.setattr(word_bpe, "DECODE_TOKENS", 100)
    r = random.Random(5)
    rows = [[r.choice([None, -1, 10**6, *range(50)]) for _ in range(r.randint(0, 60))] for _ in range(200)] + [list(range(500)), []]
    by_rank = {v: k for k, v in known.items()}
    want = [b"".join(by_rank.get(i, b"") for i in row) for row in rows]
    whole = pa.array([[7], *rows, [8]], pa.list_(pa.int32())).slice(1, len(rows))
    got = list(word_bpe.decode_batches(known, iter([whole, whole.slice(0, 0)])))
    assert [x.as_py() for part in got for x in part] == want
    assert len(got) > 20


def test_text_blocks():
    import pyarrow as pa

    from barlake.llm import common

    texts = ["é" * 40, None, "", "b" * 70, "c" * 300, "d"]
    got = list(common.text_blocks(pa.array(texts), 100))
    assert [(i, j) for i, j, _ in got] == list(common.blocks(texts, lambda t: len(t or ""), 100))
    assert [t for _, _, part in got for t in part] == texts
