"""Operator 13 against plain Python over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from barlake.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(docs):
    n = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n):
    near = {w: [] for w in n}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    for w in n:
        for size in (len(w), len(w) + 1):
            for x in by_length.get(size, []):
                if (size > len(w) or x > w) and is_near(w, x):
                    near[w].append(x)
                    near[x].append(w)
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_documents(spark, documents, texts):
    got = rows(spelling.group_variants(documents.withColumn("word", documents.lang)))
    assert got == brute(counts([(i, t) for i, t, _ in texts]))
    assert any(r[1] for r in got)


@pytest.mark.parametrize("shard", [spelling.SHARD, 7])
def test_close_words(spark, shard):
    """Words over few letters, most of them near many others; shards of one and of many slices."""
    r = random.Random(shard)
    words = {"".join(r.choice("abé") for _ in range(r.randint(5, 8))) for _ in range(700)}
    text = [(i, " ".join([w] * r.choice([3, 3, 4, 6, 7, 12, 25, 50, 100]))) for i, w in enumerate(sorted(words))]
    docs = spark.createDataFrame(text, "doc_id long, text string")
    want = brute(counts(text))
    assert rows(spelling.group_variants(docs, shard=shard)) == want
    assert any(r[2] != r[1] for r in want if r[1])  # chains of more than one step


def test_near_is_one_edit():
    r = random.Random(2)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randint(5, 7))) for _ in range(150)})
    for w in words:
        for shorter in (len(w), len(w) - 1):
            there = [x for x in words if len(x) in (shorter, shorter + 1)]
            found = spelling.PositionIndex(there).near(w, shorter)
            got = {x for i, x in enumerate(there) if found >> i & 1}
            assert got == {x for x in there if is_near(w, x) and min(len(w), len(x)) == shorter}


def test_edges(spark, edges):
    own = [(r["doc_id"], r["text"]) for r in edges.collect()]
    own += [(70, "Étude ÉTUDE étude Etude étude×÷x naïve naïve naïve naive naive naive abĀcdefg " * 3), (None, "Étude " * 5)]
    docs = spark.createDataFrame(own, "doc_id long, text string").selectExpr("*", "'x' AS word", "1 AS n", "2 AS shard")
    got = rows(spelling.group_variants(docs))
    assert got == brute(counts(own)) and got
    assert rows(spelling.group_variants(docs.limit(0))) == []
    assert rows(spelling.group_variants(docs.where("text IS NULL"))) == []
