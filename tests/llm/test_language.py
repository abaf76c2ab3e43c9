"""Operator 2 against a plain out-of-place computation, and its held-out accuracy."""

import zlib
from collections import Counter

import numpy as np
import pytest

from barlake.llm import language as lang
from barlake.llm import queries


def grams(text):
    lower = lambda c: c.lower() if len(c.lower()) == 1 else c
    plain = "".join(lower(c) if c.isalpha() else " " for c in text or "")
    out = Counter()
    for word in plain.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                g = padded[i : i + n]
                if g != " " and " " not in g[1:-1]:
                    out[g] += 1
    return out


def ranked(counts, top):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], [ord(c) for c in x[0]]))][:top]


def test_against_plain(spark, texts, documents):
    train = [t for t in texts if zlib.crc32(str(t[0]).encode()) % 5 and t[2] is not None]
    profiles = {}
    for _, text, name in train:
        profiles.setdefault(name, Counter()).update(grams(text))
    profiles = {k: {g: i for i, g in enumerate(ranked(v, lang.TOP))} for k, v in profiles.items()}
    rows = {r["doc_id"]: r for r in queries.op2_language_id(spark, "/root/testdata/sf0.001").collect()}
    right = total = 0
    for doc_id, text, name in texts:
        own = ranked(grams(text), lang.TOP)
        got = rows[doc_id]
        if not own:
            assert (got["lang_pred"], got["score"]) == ("und", 0.0)
            continue
        far = {k: sum(abs(p[g] - i) if g in p else lang.TOP for i, g in enumerate(own)) for k, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert got["lang_pred"] == best
        assert got["score"] == 1.0 - far[best] / (lang.TOP * len(own))
        assert got["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        if got["held_out"] and name:
            total, right = total + 1, right + (best == name)
    assert total > 20 and right / total >= 0.95


def test_edges(spark, edges):
    profiles = lang.fit_profiles(edges)
    assert set(profiles.langs) == {"en", "ja"}
    out = lang.identify(edges, profiles, lang_out="lang", score_out="kept").collect()
    assert len(out) == edges.count() and set(out[0].asDict()) == {"doc_id", "text", "lang", "kept"}
    by = {(r["doc_id"], r["text"]): r["lang"] for r in out}
    assert by[1, None] == by[2, ""] == "und" and [v for k, v in by.items() if k[0] == 7] == ["ja"]
    empty = lang.fit_profiles(edges.limit(0))
    assert {r["lang"] for r in lang.identify(edges, empty, lang_out="lang").collect()} == {"und"}


def test_training_sample_is_bounded(spark, documents):
    full = lang.fit_profiles(documents)
    part = lang.fit_profiles(documents, max_docs_per_lang=5)
    assert set(part.langs) == set(full.langs) and len(part.rank) <= len(full.rank)


def plain_prediction(profiles, text):
    """Language and score of ``text`` by the definition; ``profiles``: language -> Counter of n-grams."""
    ranks = {k: {g: i for i, g in enumerate(ranked(v, lang.TOP))} for k, v in profiles.items()}
    own = ranked(grams(text), lang.TOP)
    far = {k: sum(abs(p[g] - i) if g in p else lang.TOP for i, g in enumerate(own)) for k, p in ranks.items()}
    best = min(sorted(far), key=far.get)
    return best, 1.0 - far[best] / (lang.TOP * len(own))


def test_scripts_beyond_the_basic_plane(spark):
    """Gothic and Deseret share no letter; Deseret has cases."""
    gothic, deseret = "".join(map(chr, range(0x10330, 0x10341))), "".join(map(chr, range(0x10428, 0x10440)))
    rows = [(1, f"{gothic} {gothic[3:9]}", "got"), (2, f"{deseret} {deseret[2:7]}", "en-x"), (3, "plain words", "en")]
    profiles = lang.fit_profiles(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = {name: grams(text) for _, text, name in rows}
    for text in (gothic[:5], deseret[4:].upper(), f"words {gothic[2:4]}", gothic + deseret * 2):
        (name,), score = profiles.predict([text])
        assert (name, score[0]) == plain_prediction(counts, text)
    assert profiles.predict([gothic, deseret.upper()])[0] == ["got", "en-x"]


def test_many_languages(spark, monkeypatch):
    """3,000 languages, texts taken a few at a time; more than ``max_langs`` are refused."""
    rows = [(i, f"w{chr(0x4E00 + i)} {chr(0x4E00 + i)}x common words", f"l{i:04}") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = lang.fit_profiles(docs)
    monkeypatch.setattr(lang, "CELLS", 7_000)
    assert profiles.predict([t for _, t, _ in rows[::100]])[0] == [x for _, _, x in rows[::100]]
    with pytest.raises(ValueError, match="more than 10 languages"):
        lang.fit_profiles(docs, max_langs=10)


def test_block_with_very_many_letters():
    """Keys that would not fit 64 bits: the block is halved, with equal counts."""
    letters = [c for c in map(chr, range(0x3400, 0x2EBE0)) if c.isalpha()]
    texts = [c for c in letters[:60_000]] + ["".join(letters[::7])]
    docs, found, count = lang.gram_counts(texts)
    size = np.bincount(docs, minlength=len(texts))
    assert (size[:60_000] == 4).all() and size[-1] == len(grams(texts[-1]))  # x, " x", "x ", " x "
    assert count.sum() == 4 * 60_000 + 3 * len(texts[-1]) + 1 and (np.diff(docs) >= 0).all()
