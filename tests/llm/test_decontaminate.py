"""Operator 4 against a direct search of every window."""

import random
import re

import pytest

from barlake.llm import decontaminate as dec


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window):
    grams = {}
    for name, text in items:
        ws = words(text)
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            grams.setdefault(tuple(ws[i : i + n]), set()).add("null" if name is None else str(name))
    out = []
    for text in docs:
        ws, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(ws) - n + 1):
                if tuple(ws[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(ws[i : i + n])]
        out.append((len(ws), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(ws)))
    return out


def case(seed):
    r = random.Random(seed)
    pool = ["the", "of", "A", "b", "naïve", "x1"]
    text = lambda n: "".join(r.choice(pool) + r.choice([" ", ", ", "\n"]) for _ in range(n))
    items = [(i, text(r.randint(0, 9))) for i in range(12)] + [(None, text(4)), (3, text(6)), (20, None)]
    docs = [text(r.randint(0, 40)) for _ in range(40)] + [None, "", items[0][1] * 3]
    return docs, items


@pytest.mark.parametrize("block", [60_000, 25])
def test_random(spark, monkeypatch, block):
    monkeypatch.setattr(dec, "BLOCK_WORDS", block)
    for seed in range(2):
        docs, items = case(seed)
        left = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
        right = spark.createDataFrame(items, "item_id long, text string")
        want = brute(docs, items, 4)
        got = {r["doc_id"]: r for r in dec.find_contamination(left, right, window=4).collect()}
        for i, w in enumerate(want):
            g = got[i]
            assert (g["n_words"], g["n_hit"], list(g["items"]), g["contaminated"]) == w
        kept = {r["doc_id"] for r in dec.remove_contaminated(left, right, window=4).collect()}
        assert kept == {i for i, w in enumerate(want) if not w[3]}


def test_table(spark, documents, texts):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([t for _, t, _ in texts], [(r["item_id"], r["text"]) for r in bench.collect()], dec.WINDOW)
    got = {r["doc_id"]: r for r in dec.find_contamination(documents, bench).collect()}
    assert any(w[3] for w in want)
    for (doc_id, _, _), w in zip(texts, want):
        g = got[doc_id]
        assert (g["n_words"], g["n_hit"], list(g["items"]), g["contaminated"]) == w


def test_longest_match_and_edges(spark, edges):
    item = " ".join(f"w{i}" for i in range(30))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    doc = "start " + " ".join(f"w{i}" for i in range(5, 25)) + " end"
    docs = spark.createDataFrame([(1, doc), (2, "w1 w2")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in dec.find_contamination(docs, bench).collect()}
    assert got[1]["longest_match"] == 20 and [tuple(s) for s in got[1]["spans"]] == [(1, 21)] and got[2]["n_hit"] == 0
    assert dec.find_contamination(edges, bench).count() == edges.count()
    assert dec.find_contamination(edges, bench.limit(0)).where("contaminated").count() == 0
    assert dec.remove_contaminated(edges, bench).columns == edges.columns


def test_same_rows_for_any_block_size(spark, monkeypatch):
    """longest_match included; items longer than a block, repeated items and repeated documents."""
    r = random.Random(8)
    long = [f"w{r.randrange(60)}" for _ in range(90)]
    items = [(1, " ".join(long)), (1, " ".join(long)), (2, " ".join(long[20:70])), (3, " ".join(f"w{r.randrange(60)}" for _ in range(40))), (4, "w1 w2"), (None, " ".join(long[:6]))]
    docs = [" ".join(long[a:b]) for a, b in ((0, 90), (5, 45), (30, 80), (0, 5), (88, 90))]
    docs += [" ".join([*long[3:40], "x", *long[41:85]]), " ".join(long[10:40] + long[10:60]), None, docs[0]]
    left = spark.createDataFrame([(i if i < 8 else 0, t) for i, t in enumerate(docs)], "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    for window in (4, 20):
        rows = {}
        for block in (60_000, 37, 25):
            monkeypatch.setattr(dec, "BLOCK_WORDS", block)
            got = dec.find_contamination(left, right, window=window).collect()
            fields = ("doc_id", "n_words", "n_hit", "spans", "items", "longest_match", "contaminated")
            rows[block] = sorted(str([x[f] for f in fields]) for x in got)
        assert rows[60_000] == rows[37] == rows[25]
        whole = {x["doc_id"]: x["longest_match"] for x in got}
        assert whole[0] == 90 and whole[1] == 40 and whole[5] == 44
        brute_rows = brute(docs[:8], items, window)
        by = {x["doc_id"]: x for x in got}
        assert [(by[i]["n_words"], by[i]["n_hit"], list(by[i]["items"]), by[i]["contaminated"]) for i in range(8)] == brute_rows
    extra = left.selectExpr("*", "'k' AS _bad", "1 AS key")
    assert dec.remove_contaminated(extra, right, window=4).columns == extra.columns
