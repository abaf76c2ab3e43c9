"""Operator 6: entire licence texts are found by the known table of the registered query."""

import re
import textwrap

import pytest
from pyspark.sql import functions as F

from barlake.llm import licenses


@pytest.fixture(scope="module")
def texts():
    """Text of each licence's file."""
    out = {}
    for name, text in licenses.full_texts():
        out.setdefault(name, text)
    return out


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(p, width, break_long_words=False) for p in re.split(r"\n\s*\n", text))


def scan(spark, docs, **kw):
    """license_id of each text, in order."""
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r["doc_id"]: r["license_id"] for r in licenses.license_scan(rows, licenses.known_licenses(spark, **kw)).collect()}
    return [got[i] for i in range(len(docs))]


def test_entire_texts_in_any_line_width(spark, texts):
    docs = []
    for name, text in texts.items():
        docs += [(name, text)] + [(name, wrapped(text, n)) for n in (30, 45, 72, 79, 100, 110, 1_000_000)]
    assert scan(spark, [t for _, t in docs]) == [name for name, _ in docs]


def test_titles_notices_and_lists(spark, texts):
    head = "{}\n\nCopyright (c) 2020 Some One\nAll rights reserved.\n\n{}"
    docs = [(n, head.format(title, wrapped(texts[n], 58))) for n, titles in licenses.TITLES.items() for title in titles]
    notices = ["(c) 2020 Some One", "© Some One, 2020", "# Copyright 2019-2021 Some One", "Copyright (C) <year> <owner>", " * Copyright [yyyy] [name]"]
    docs += [("ISC", f"{x}\n\n{texts['ISC']}") for x in notices]
    docs += [("BSD-3-Clause", re.sub(r"(?m)^[1-9]\. ", mark, texts["BSD-3-Clause"])) for mark in ("* ", "", "  - ")]
    docs += [("BSD-2-Clause", texts["BSD-2-Clause"].replace("HOLDER OR", "OWNER OR")), ("Unlicense", texts["Unlicense"].replace("https", "http"))]
    docs += [("MIT", "\n".join(f"// {line}" for line in texts["MIT"].split("\n")))]
    assert scan(spark, [t for _, t in docs]) == [name for name, _ in docs]


def test_other_texts(spark, texts):
    mit = texts["MIT"]
    docs = [texts["GPL-3.0"][:-100], mit.split("\n\n")[0], mit.replace("copyright notice", "notice"), mit + " more", mit * 2]
    docs += [None, "", " \n", "Copyright (c) 2020 Some One", "All rights reserved.", "© 2020\n\n", mit + "x" * 3_000_000]
    assert scan(spark, docs) == [None] * len(docs)


def test_no_text_stands_for_two_licences(spark):
    known = licenses.known_licenses(spark)
    digests = known.select("license_id", licenses.digest(F.col("text")).alias("d")).groupBy("d")
    assert digests.agg(F.countDistinct("license_id").alias("n")).where("n > 1").count() == 0


def test_known_table(spark):
    """Two ids of one digest, null ids and texts, texts of which nothing is left."""
    known = [("b", "One text."), ("a", "one TEXT"), (None, "other"), ("c", None), ("d", "(c) 2020 x"), ("e", "...")]
    assert scan(spark, ["one text", "other", "", None, "(c) 2021 y"], texts=known) == ["a", None, None, None, None]
    assert scan(spark, ["one text"], texts=[]) == [None]


def test_lines_equal_their_own_canonical_form(spark):
    lines = ["Released under the M.I.T. licence", "", "gnu gpl v2 v2", "(c) 2020 x", "©", "per", "cent per cent", "==", "all rights reserved", "ß Σ\t日本 1", "copyright notice"]
    for sep, text in (("\n", "\n".join(lines)), ("\r\n", "\r\n".join(lines) + "\n\n")):
        row = spark.createDataFrame([(text,)], "t string").select(licenses.canonical_lines(F.col("t")).alias("x")).first()
        alone = spark.createDataFrame(list(enumerate(lines)), "i int, t string").select("i", licenses.canonical(F.col("t")).alias("x"))
        assert row["x"] == [r["x"] for r in sorted(alone.collect()) if r["x"]], sep


def test_clashing_names_and_empty_tables(spark):
    schema = "doc_id long, text string, digest int, license_id int, __digest int, _digest int, _license int, notices int"
    docs = spark.createDataFrame([(1, "Released under the MIT Licence\nx", 1, 2, 3, 4, 5, 6), (1, "released under the mit license", 7, 8, 9, 10, 11, 12)], schema)
    known = licenses.known_licenses(spark)
    out = licenses.license_scan(docs, known)
    assert out.columns == ["doc_id", "text", "__digest", "_digest", "_license", "notices", "digest", "license_id"]
    assert sorted((r["__digest"], r["_digest"], r["_license"], r["license_id"] or "") for r in out.collect()) == [(3, 4, 5, ""), (9, 10, 11, "MIT")]
    found = licenses.notice_scan(docs, known)
    assert found.columns == ["doc_id", "text_key", "notices"] and [r["notices"] for r in found.collect()] == [["MIT"]] * 2
    assert licenses.license_scan(docs.limit(0), known).count() == 0 and licenses.notice_scan(docs.limit(0), known).count() == 0
    line_id = docs.select(F.col("doc_id").alias("text_id"), F.col("text").alias("line"))
    assert licenses.notice_scan(line_id, known, "text_id", "line").columns == ["text_id", "text_key", "notices"]
