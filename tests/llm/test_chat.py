"""Operator 8: exact way back, budget, history and loss mask."""

import random

from pyspark.sql import functions as F

from barlake.llm import chat

NASTY = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\l", "\\b", "\\\\", "a", " ", "\n", "é🙂", "<", "["]


def conversations(seed):
    r = random.Random(seed)
    rows = []
    for c in range(25):
        for t in range(r.randint(1, 30)):
            role = r.choice(["user", "assistant", "to<ol"]) if t else r.choice(["system", "user"])
            rows.append((c, t, role, "".join(r.choice(NASTY) for _ in range(r.choice([0, 3, 20, 120])))))
    return rows


def test_round_trip_and_windows(spark):
    rows = conversations(1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    windows = chat.format_windows(df, budget=60, history=12).cache()
    back = chat.read_windows(windows).orderBy("conv_id", "window").collect()
    turns, loss = {}, {}
    for r in back:
        turns.setdefault(r["conv_id"], []).extend((t["role"], t["text"]) for t in r["turns"])
        loss.setdefault(r["conv_id"], []).extend(r["loss_texts"])
    for c in range(25):
        want = [(role, text) for conv, _, role, text in rows if conv == c]
        assert turns[c] == want
        assert loss[c] == [text for role, text in want if role == "assistant"]
    plan = chat.plan_turns(df, budget=60, history=12).collect()
    several = {(r["conv_id"], r["window"]) for r in plan}
    assert len(several) > 40
    alone = {}
    for r in plan:
        alone.setdefault((r["conv_id"], r["window"]), []).append(r["tokens"])
    for w in windows.collect():
        costs = alone[w["conv_id"], w["window"]]
        assert w["n_tokens"] <= 60 or len(costs) == 1 or w["window"] == 0
        if w["window"] > 0:
            first = [r for r in plan if r["conv_id"] == w["conv_id"] and r["pos"] == 1][0]
            assert (first["role"] == "system") <= w["formatted"].startswith("<s>system[INST]")
    assert windows.where("window > 0 AND n_repeated > 0").count() > 10


def test_escape_is_reversible(spark):
    r = random.Random(2)
    texts = ["".join(r.choice(NASTY) for _ in range(r.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for x in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert x["u"] == x["t"] and "<" not in x["e"] and "[" not in x["e"]


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.format_windows(none)).count() == 0
