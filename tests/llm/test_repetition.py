"""Operator 1 against a direct count over all windows of a text."""

import random
import re

from barlake.llm import repetition as rep


def brute(text, min_repeat):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tokens = words

    def windows(ts, n):
        seen = {}
        for i in range(len(ts) - n + 1):
            seen.setdefault(tuple(ts[i : i + n]), []).append(i)
        return [at for at in seen.values() if len(at) > 1]

    def covered(ts, n):
        return len({k for at in windows(ts, n) for i in at for k in range(i, i + n)})

    longest, n = 0, min_repeat
    while windows(tokens, n):
        longest, n = n, n + 1
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, covered(words, 3), len(tokens), covered(tokens, min_repeat), longest]


def check(texts, min_repeat=4):
    got = list(zip(*[x.tolist() for x in rep.measure_block([t or "" for t in texts], min_repeat)]))
    for text, row in zip(texts, got):
        assert list(row) == brute(text, min_repeat), text


def test_random_texts():
    r = random.Random(5)
    texts = []
    for _ in range(120):
        words = [r.choice(["a", "b", "c#", "dd", "x" * 45]) for _ in range(r.randint(0, 60))]
        if r.random() < 0.5:
            words += words[: r.randint(0, 30)]
        texts.append("".join(w + r.choice([" ", "\n", "  ", "\t"]) for w in words))
    check(texts)


def test_edges():
    check([None, "", " ", "one", "a " * 50, "ab" * 60, "x y z x y z", "q" * 41 + " " + "q" * 41])


def test_operator(spark, edges, documents):
    rows = rep.repetition_rules(edges).collect()
    assert len(rows) == edges.count()
    by = [(r["doc_id"], r["n_words"], r["base_failed"], r["kept"]) for r in rows]
    assert (1, 0, True, False) in by and (9, 20_000, True, False) in by
    out = {r["doc_id"]: r for r in rep.repetition_rules(documents).collect()}
    for r in documents.limit(60).collect():
        got = out[r["doc_id"]]
        want = brute(r["text"], rep.MIN_REPEAT)
        assert [got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"], got["n_tokens"], got["covered_tokens"], got["longest_repeat"]] == want
    assert rep.repetition_rules(documents.limit(0)).count() == 0


def test_a_long_word_does_not_change_the_verdict(spark):
    r = random.Random(9)
    clean = [f"w{r.randrange(10**6)}" for _ in range(5_000)]
    texts = [" ".join([*clean[:2_500], "=" * n, *clean[2_500:]]) for n in (10, 256, 257, 5_000)]
    rows = rep.repetition_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [(x["kept"], x["longest_repeat"], x["n_tokens"]) for x in rows] == [(True, 0, 5_001)] * 4
