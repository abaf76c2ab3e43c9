"""Operator 7 against a direct pass in document order, skew and plan."""

import hashlib
import random

from barlake.llm import line_dedup


def brute(rows, window=3):
    docs = sorted({(i is not None, i, hashlib.md5(t.encode()).hexdigest(), t) for i, t in rows if t is not None})
    seen, out = set(), {}
    for _, i, _, text in docs:
        lines = text.split("\n")
        counted = [k for k, x in enumerate(lines) if any(ord(c) > 32 for c in x)]
        gone = set()
        for p in range(len(counted) - window + 1):
            key = tuple(lines[k] for k in counted[p : p + window])
            if key in seen:
                gone |= set(counted[p : p + window])
            seen.add(key)
        kept = [x for k, x in enumerate(lines) if k not in gone]
        out[i, text] = ("" if gone and len(gone) == len(counted) else "\n".join(kept), len(counted), len(gone))
    return out


def test_random(spark):
    r = random.Random(6)
    rows = []
    for i in range(150):
        rows.append((r.choice([i, None, i // 2]), "\n".join(r.choice(["a", "b", "c", "", " ", "dd"]) for _ in range(r.randint(0, 9)))))
    rows += rows[:10] + [(7, None)]
    df = spark.createDataFrame([(i, t, "en", 1) for i, t in rows], "doc_id long, text string, lang string, n_removed int")
    got = line_dedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "lang", "n_lines", "n_removed"]
    want = brute(rows)
    out = sorted(((x["doc_id"] is None, x["doc_id"] or 0), x["text"] or "", x["n_lines"], x["n_removed"]) for x in got.collect())
    assert out == sorted(((i is None, i or 0), *((want[i, t]) if t is not None else ("", 0, 0))) for i, t in rows)


def test_edges(spark, edges):
    out = {(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(edges).collect()}
    text = "the same words of a text\nthat has three lines\nin all of them\nand a fourth"
    assert {(5, text), (6, ""), (1, None), (2, "")} <= out
    assert line_dedup.dedup_lines(edges).count() == edges.count()
    assert line_dedup.dedup_lines(edges.limit(0)).count() == 0


def test_columns_with_helper_names_stay(spark):
    names = ["__key", "__n", "__text", "__removed", "_removed", "_row", "_REMOVED_", "id", "t"]
    text = "a b\nc d\ne f"
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    docs = docs.select("*", *[line_dedup.F.concat(line_dedup.F.lit(n), "doc_id").alias(n) for n in names])
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert (got[1]["text"], got[2]["text"]) == (text, "")
    assert all(got[i][n] == f"{n}{i}" for i in (1, 2) for n in names)


def test_hot_window_is_split(spark):
    """Half of the documents share one window: the join that finds its later occurrences is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        own = line_dedup.F.expr("concat('x', id, '\ny', id, '\nz', id)")
        same = line_dedup.F.expr("concat('same\nthree\nlines\n', uuid())")
        hot = line_dedup.F.when(line_dedup.F.col("id") % 2 == 0, same).otherwise(own)
        docs = spark.range(20_000).select(line_dedup.F.col("id").alias("doc_id"), hot.alias("text")).checkpoint()
        out = line_dedup.removed_lines(docs)
        assert len(out.collect()) == 9_999
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
