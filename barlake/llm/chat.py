"""Operator 8: chat formatting in budgeted, turn-aligned windows.

A conversation's turns are ordered by ``turn`` (ties by role, then text). A turn costs its
words plus ``TURN_TOKENS`` for its markup. The prefix sums of these costs choose the
windows: a new one starts where the sum passes a multiple of the stride, half of what the
budget leaves after system turn and history; a turn longer than the stride stands alone.
Later windows repeat the leading system turn and the last turns that fit in ``history``
tokens; repeated turns are not under the loss mask, so each assistant text is a target once.

Template: ``<s>role[INST]text[/INST]</s>`` per turn. Inside roles and texts ``\\``, ``<`` and
``[`` are written ``\\\\``, ``\\l`` and ``\\b``, so no control string can occur in them, and
the way back is exact.

Defined cases: null texts and roles are empty; a null conversation id is one conversation;
repeated rows are repeated turns; a null turn comes first; an empty table gives no rows;
other columns are not read. Prefix sums run over numbers within one conversation; a
window's texts are bounded by the budget or one turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm import common

BUDGET, HISTORY, TURN_TOKENS = 1024, 128, 4
OPEN, MIDDLE, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
TARGET, SYSTEM = "assistant", "system"


def escape(text: Column) -> Column:
    for old, new in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def unescape(text: Column) -> Column:
    parts = F.transform(
        F.split(text, r"\\\\", -1),
        lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")),
    )
    return F.array_join(parts, "\\")


def plan_turns(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per turn: position, costs, its window and, at a window's start, how many turns it repeats."""
    common.require(conversations, "conv_id", "turn", "role", "text")
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("tokens", F.size(F.split(F.trim("text"), r"[ \t-\r]+", -1)).cast("long") + TURN_TOKENS)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    has_system = F.first("role").over(order) == SYSTEM
    turns = (
        turns.withColumn("pos", F.row_number().over(order))
        .withColumn("has_system", has_system)
        .withColumn("before", F.coalesce(F.sum("tokens").over(so_far), F.lit(0)))
        .withColumn("stride", F.greatest(F.lit(1), F.floor((budget - history - F.when(has_system, F.first("tokens").over(order)).otherwise(0)) / 2)))
    )
    alone = (F.col("tokens") > F.col("stride")) & ~(F.col("has_system") & (F.col("pos") == 1))
    by_pos = Window.partitionBy("conv_id").orderBy("pos")
    turns = turns.withColumn("alone", alone).withColumn(
        "slot",
        F.struct(
            F.floor(F.col("before") / F.col("stride")).alias("a"),
            F.coalesce(F.sum(F.col("alone").cast("int")).over(by_pos.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"),
            F.col("alone").alias("c"),
        ),
    )
    starts = F.coalesce(F.lag("slot").over(by_pos) != F.col("slot"), F.lit(True))
    by_sum = Window.partitionBy("conv_id").orderBy("before").rangeBetween(-history, -1)
    return (
        turns.withColumn("starts", starts)
        .withColumn("window", F.sum(F.col("starts").cast("int")).over(by_pos) - 1)
        .withColumn("repeats", F.count("*").over(by_sum))
        .select("conv_id", "pos", "role", "text", "tokens", "window", "starts", "repeats", "has_system")
    )


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, formatted, n_repeated (leading turns seen before), n_tokens,
    loss_spans (code point ranges of formatted that are targets)."""
    turns = plan_turns(conversations, budget, history)
    new = turns.select("conv_id", "window", "pos", "role", "text", "tokens", F.lit(True).alias("new"))
    from_pos = F.greatest(F.col("pos") - F.col("repeats"), F.when(F.col("has_system"), 2).otherwise(1))
    past = F.when(from_pos < F.col("pos"), F.sequence(from_pos, F.col("pos") - 1)).otherwise(F.array().cast("array<bigint>"))
    wanted = (
        turns.where(F.col("starts") & (F.col("window") > 0))
        .select(
            F.col("conv_id").alias("c"),
            "window",
            F.explode(F.concat(F.when(F.col("has_system"), F.array(F.lit(1).cast("bigint"))).otherwise(F.array().cast("array<bigint>")), past)).alias("p"),
        )
    )
    old = wanted.join(
        turns.select("conv_id", "pos", "role", "text", "tokens"), F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("p") == F.col("pos"))
    ).select("conv_id", "window", "pos", "role", "text", "tokens", F.lit(False).alias("new"))
    pieces = new.unionByName(old).select(
        "conv_id",
        "window",
        F.struct(
            "pos",
            "new",
            F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE)).alias("head"),
            escape(F.col("text")).alias("body"),
            (F.col("new") & (F.col("role") == TARGET)).alias("target"),
            "tokens",
        ).alias("t"),
    )
    grouped = pieces.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list("t")).alias("ts"), F.sum("t.tokens").alias("n_tokens"))
    tail = CLOSE + END
    spans = F.aggregate(
        "ts",
        F.expr("named_struct('at', 0, 'spans', CAST(array() AS array<struct<start:int,stop:int>>))"),
        lambda s, t: F.struct(
            (s["at"] + F.char_length(t["head"]) + F.char_length(t["body"]) + len(tail)).alias("at"),
            F.when(
                t["target"],
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct(
                            (s["at"] + F.char_length(t["head"])).alias("start"),
                            (s["at"] + F.char_length(t["head"]) + F.char_length(t["body"])).alias("stop"),
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return grouped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "").alias("formatted"),
        F.size(F.filter("ts", lambda t: ~t["new"])).alias("n_repeated"),
        "n_tokens",
        spans.alias("loss_spans"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Back from the formatted text: conv_id, window, turns (role, text) that are new in the
    window, and loss_texts (unescaped text under the mask)."""
    blocks = F.split("formatted", END, -1)
    blocks = F.slice(blocks, F.col("n_repeated") + 1, F.size(blocks) - 1 - F.col("n_repeated"))
    parts = F.transform(blocks, lambda b: F.split(b, r"<s>|\[INST\]|\[/INST\]", -1))
    turns = F.transform(parts, lambda p: F.struct(unescape(F.get(p, F.lit(1))).alias("role"), unescape(F.get(p, F.lit(2))).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["stop"] - s["start"])))
    return windows.select("conv_id", "window", "formatted", turns.alias("turns"), loss.alias("loss_texts"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from the output alone: turns, their digest, loss text and its digest, characters."""
    back = read_windows(windows).select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.array_join("loss_texts", "").alias("loss"),
        ).alias("w"),
        F.size("turns").cast("long").alias("n"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    joined = back.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"), F.array_sort(F.collect_list("w")).alias("ws")
    )
    loss = F.array_join(F.col("ws.loss"), "")
    return joined.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.col("ws.turns"), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )
