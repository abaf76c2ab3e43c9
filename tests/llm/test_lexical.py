"""Operator 12 against a plain scan of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from barlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=10):
    cut = [(i, TERM.findall((t or "").translate(LOW))) for i, t in docs]
    cut = [(i, ts, Counter(ts)) for i, ts in cut if ts]
    total, length = len(cut), sum(len(ts) for _, ts, _ in cut)
    df = Counter(t for _, _, c in cut for t in c)
    out = []
    for item, text in items:
        q = Counter(TERM.findall((text or "").translate(LOW)))
        w = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in q}
        scored = []
        for i, ts, c in cut:
            m = 100 - 75 + (75 * len(ts) * total) // length
            s = sum(r * w[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, r in q.items() if t in c)
            if s > 0:
                scored.append((-s, i is not None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored)[:top])]
    return out


def key(rows):
    return sorted(map(tuple, rows), key=lambda r: (str(r[0]), r[1], str(r[2]), r[3]))


@pytest.mark.parametrize("chunk, block", [(3_000_000, 4_000_000), (2_000, 300)])
def test_against_scan(spark, documents, monkeypatch, chunk, block):
    monkeypatch.setattr(lexical, "CHUNK_ENTRIES", chunk)
    monkeypatch.setattr(lexical, "ITEM_CHARS", block)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(8 if block < 1_000 else 1_000)
    got = lexical.rank_documents(documents.repartition(3), items).collect()
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert key(got) == key(want) and got


def test_edges(spark, edges):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()] + [(30 + i, "ties of equal score word") for i in range(25)]
    rows += [(60, "Ünicode É é A a 1a-B_c"), (61, "word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS terms", "3 AS id")
    queries = [(1, "equal SCORE ties"), (1, "equal SCORE ties"), (None, "word word of"), (2, None), (3, ""), (4, "nowhere"), (5, "É é a 1A b C")]
    items = spark.createDataFrame(queries, "item_id long, text string").selectExpr("*", "'x' AS score", "1 AS number")
    got = lexical.rank_documents(docs, items).collect()
    assert key(got) == key(brute(rows, queries))
    assert [r["doc_id"] for r in got if r["item_id"] == 1 and r["rank"] == 3] == [32, 32]
    assert lexical.rank_documents(docs.limit(0), items).collect() == []
    assert lexical.rank_documents(docs, items.limit(0)).collect() == []
    assert lexical.rank_documents(docs, items.where("text IS NULL")).collect() == []


def test_search_skips_most_documents():
    r = np.random.default_rng(5)
    n, vocabulary, size = 4_000, 2_000, 12
    term = np.sort(np.minimum((r.pareto(0.7, (n, size)) * 3).astype(np.int64), vocabulary - 1), axis=1)
    term[7] = np.sort(r.choice(np.arange(1_000, 2_000), size, replace=False))
    ends = np.arange(n + 1) * size
    flat = term.ravel()
    seen = []
    tree = lexical.FpTree([(True, i) for i in range(n)], np.full(n, 100), ends, flat, np.ones(len(flat), np.int64), vocabulary)
    weight = np.zeros(vocabulary, np.int64)
    weight[term[7]] = 1_000
    plain = lexical.Node.bounds

    def counted(self, w):
        seen.append(len(self.m))
        return plain(self, w)

    best = []
    lexical.Node.bounds = counted
    try:
        tree.search(weight, best, 1)
    finally:
        lexical.Node.bounds = plain
    assert best[0][1].key == (True, 7)
    assert sum(seen) < n // 2
