"""Operator 3: classes against the components of all similar pairs, and planted cases."""

import random
import re

import numpy as np
import pytest

from barlake.llm import neardup as nd


def weights(text, idf):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())]
    _, ids, count = nd.shingle_sets(words, nd.WordHashes())
    return {int(i): c * w for i, c, w in zip(ids, count, idf[nd._slots(ids)])}


def brute_classes(rows, idf, threshold=nd.THRESHOLD):
    sets = [(i, weights(t, idf)) for i, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y:
                both = sum(min(x[k], y[k]) for k in x.keys() & y.keys())
                if both / (sum(x.values()) + sum(y.values()) - both) >= threshold:
                    parent[max(top(a), top(b))] = min(top(a), top(b))
    return {rows[k][0]: min(rows[j][0] for j in range(len(rows)) if top(j) == top(k)) for k in range(len(rows))}


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(3_000)]
    rows, key = [], 0
    common = [r.choice(vocab) for _ in range(60)]
    for _ in range(40):
        base = [r.choice(vocab) for _ in range(r.randint(60, 200))]
        if r.random() < 0.5:
            base[10:10] = common
        for k in range(r.choice([1, 1, 2, 6])):
            words = list(base)
            for _ in range(r.choice([0, 1, 2, 8])):
                words[r.randrange(len(words))] = r.choice(vocab)
            rows.append((key, " ".join(words).upper() if k == 1 else " ".join(words)))
            key += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicates(docs).collect()}
    assert got == brute_classes(rows, nd.inverse_frequencies(docs, "text"))


def test_table(spark, documents, texts):
    rows = [(i, t) for i, t, _ in texts]
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicates(documents).collect()}
    assert got == brute_classes(rows, nd.inverse_frequencies(documents, "text"))
    kept = {r["doc_id"] for r in nd.keep_one(documents).collect()}
    assert kept == set(got.values())


def hot_group(n, seed=5):
    """Copies of one text with up to 14 edited words each: many pairs on either side of the threshold."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for key in range(n):
        words = list(base)
        for _ in range(r.randint(0, 14)):
            words[r.randrange(len(words))] = f"e{r.randrange(40)}"
        rows.append((key, " ".join(words)))
    return rows


@pytest.mark.parametrize("cell", [nd.CELL, 3_000])
def test_hot_mixed_group(spark, monkeypatch, cell):
    monkeypatch.setattr(nd, "CELL", cell)  # 3,000: buckets are cut into slices of about 20 texts
    rows = hot_group(160)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicates(docs).collect()}
    want = brute_classes(rows, nd.inverse_frequencies(docs, "text"))
    assert 1 < len(set(want.values())) < len(rows)
    assert got == want


def test_join_classes_links_every_similar_pair():
    rng, idf = np.random.default_rng(8), np.where(np.arange(nd.SKETCH) % 3 == 0, 0.7, 1.0)
    for trial in range(30):
        pool = np.unique(rng.integers(0, 2**50, 60).astype(np.uint64))
        sets = [np.sort(rng.choice(pool, rng.integers(40, len(pool) + 1), replace=False)) for _ in range(25)]
        labels = rng.integers(0, 20, 25)
        links = nd.join_classes(sets, labels, idf, 0.7)

        def closed(pairs):
            label = labels.copy()
            for a, b in pairs:
                label[label == label[a]] = label[b]
            return {frozenset(np.flatnonzero(label == x).tolist()) for x in label}

        weighted = [(x, idf[nd._slots(x)]) for x in sets]
        near = [(a, b) for a in range(25) for b in range(a) if nd.similarity(weighted[a], weighted[b]) >= 0.7 - 1e-9]
        assert closed(links) == closed(near) and len(links) < 25
        assert all((max(p), min(p)) in near for p in links)


def test_unary_sets_keep_the_sum_of_minima():
    ids = np.array([5, 70_000, 1 << 40], np.uint64)
    one, two = nd.unary(ids, np.array([3, 1, 2])), nd.unary(ids[:2], np.array([2, 4]))
    assert len(one) == 6 and len(two) == 6 and len(np.intersect1d(one, two)) == 2 + 1
    assert sorted(nd._slots(one).tolist()) == sorted([5] * 3 + [70_000 & 65_535] + [0] * 2)


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    idf = np.where(np.arange(nd.SKETCH) % 3 == 0, 0.6, 1.0)
    icws = nd.Icws(idf, bands=400, rows=1)
    ids = np.unique(rng.integers(0, 2**50, 300).astype(np.uint64))
    a, b = ids[:240], ids[40:]
    ca, cb = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
    ca[100:140] = 3
    one = icws.bands_of(np.zeros(len(a), int), a, ca, 1)[0]
    two = icws.bands_of(np.zeros(len(b), int), b, cb, 1)[0]
    exact = nd.similarity((a, ca * idf[nd._slots(a)]), (b, cb * idf[nd._slots(b)]))
    assert abs((one == two).mean() - exact) < 0.08


def test_edges(spark, edges):
    rows = nd.near_duplicates(edges).collect()
    assert len(rows) == edges.count()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["class_id"]) for r in rows if r["class_id"] is not None)
    assert [x[2] for x in got if x[1] in (5, 6)] == [5, 5, 5] and (False, 2, 2) in got and (False, 3, 3) in got
    kept = nd.keep_one(edges)
    assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(5) == 1 and 6 not in ids and ids.count(None) == 2 and {1, 2, 3, 4, 7, 8, 9} <= set(ids)
    assert nd.keep_one(edges.limit(0)).count() == 0


def test_pair_that_shares_one_band_with_another_leader(spark):
    words = [f"w{i}" for i in range(200)]
    docs = {1: " ".join(words), 2: " ".join(words[:-4]), 3: " ".join(f"x{i}" for i in range(200)), 4: " ".join(f"y{i}" for i in range(200))}
    shared = {1: {0: 7}, 2: {0: 7}, 3: {0: 7, 1: 8, 2: 9}, 4: {1: 8, 2: 9}}  # 3 leads the bucket of 1 and 2
    bands = {i: [shared[i].get(b, 1000 * i + b) for b in range(nd.BANDS)] for i in docs}
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    made = spark.createDataFrame(list(bands.items()), "id long, made array<long>")
    idf = nd.np.ones(nd.SKETCH)
    sig = nd.signatures(rows, idf, "doc_id", "text").join(made, "id").withColumn("bands", nd.F.col("made")).drop("made")
    scratch = nd.common.Scratch(spark)
    labels = nd._links(scratch.write(sig), rows, idf, "doc_id", "text", nd.THRESHOLD, scratch)
    node = {r["id"]: bytes(r["node"]) for r in sig.collect()}
    assert labels is not None
    assert [{bytes(r["node"]), bytes(r["label"])} for r in labels.collect()] == [{node[1], node[2]}]


def test_columns_with_helper_names_stay(spark):
    names = ["__key", "__id", "__t", "_drop", "_key", "id", "t", "label", "stays"]
    words = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, words), (1, words), (2, words), (3, None)], "doc_id long, text string")
    docs = docs.select("*", *[nd.F.concat(nd.F.lit(n), "doc_id").alias(n) for n in names])
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert sorted(rows) == [1, 3] and kept.count() == 2
    assert all(r[n] == f"{n}{i}" for i, r in rows.items() for n in names)
