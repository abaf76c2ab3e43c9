"""Operator 6: licence scan by canonical digest lookup.

A text is made canonical: lower case, copyright notices dropped, punctuation, spacing and line
breaks reduced to single spaces, equivalent spellings unified.
Its SHA-256 is joined with the digests of known licence texts, canonicalised the same
way. ``license_scan`` compares entire texts; ``notice_scan`` compares each entire line,
which finds one-line licence notices inside documents.

A copyright notice is a line that begins with a copyright mark and a year, a second mark or a
placeholder of the year, or with the sign ©, or that says no more than "all rights reserved". Other lines with the word stay, and the notices
that licences quote themselves go by their words, so the canonical form does not depend on where a licence's
own sentences are broken. A notice of several lines leaves all but its first, and its text is then not found.

Defined cases: null, empty and notice-only texts match nothing (a null text has no digest); known texts with equal
canonical forms give the smallest licence id; a very long text is one digest like any
other; repeated rows match alike; extra columns pass through, input columns with the
output's names are replaced.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import common

# Equivalent spellings, (pattern, written as).
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licencing", "licensing"),
    ("organisation", "organization"),
    ("sublicence", "sublicense"),
    ("noncommercial", "non commercial"),
    ("favour", "favor"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("per cent", "percent"),
    ("v2", "version 2"),
    ("v3", "version 3"),
    ("gnu gpl", "gnu general public license"),
    ("https", "http"),
    ("copyright owner or", "copyright holder or"),
]

# One-line notices that are looked up by default.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
]

# Titles that may stand before a short licence; the long ones begin with theirs.
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "ISC": ["ISC License"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "Unlicense": ["The Unlicense"],
    "Zlib": ["zlib License"],
}

_YEAR = r"(?:[0-9]{4}|[\[<{(](?:year|yyyy|years))"
_GAP = r"[^\p{L}\p{N}\n]*"
# Regular expressions that Java and RE2 read alike.
COPYRIGHT_LINE = (
    rf"^{_GAP}(?:copyright{_GAP}(?:\(c\)|©|{_YEAR})|\(c\){_GAP}(?:copyright|{_YEAR})|©|all rights reserved{_GAP}$)[^\n]*$"
)
# Notices that are a licence's own words. They go wherever a line is broken; `_` stands for white space.
OWN_NOTICES = (
    r"copyright_*\(c\)_*(?:[0-9](?:_|[0-9,-])*free_+software_+foundation|<?year>?_+<?name_+of_+author>?)"
    r"|copyright_*\[yyyy\]_*\[name_+of_+copyright_+owner\]"
).replace("_", r"[ \t\r\n]")
NOT_WORD = r"[^\p{L}\p{N}]+"
NOT_WORD_IN_LINE = r"[^\p{L}\p{N}\n]+"


def _without_notices(text: Column, own: str = OWN_NOTICES) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), own, " "), f"(?md){COPYRIGHT_LINE}", " ")


def _unify(words: Column) -> Column:
    """Equivalent spellings unified; every word stands between two spaces."""
    for old, new in SPELLINGS:
        words = F.replace(words, F.lit(f" {old} "), F.lit(f" {new} "))
    return words


def canonical(text: Column) -> Column:
    """Canonical form; empty where nothing is left."""
    words = F.trim(F.regexp_replace(_without_notices(text), NOT_WORD, " "))
    return F.trim(_unify(F.concat(F.lit(" "), words, F.lit(" "))))


def canonical_lines(text: Column) -> Column:
    """Canonical form of each line, worked out on the text as a whole; lines of which nothing is left are not listed."""
    words = F.regexp_replace(_without_notices(text, OWN_NOTICES.replace(r"\n", "")), NOT_WORD_IN_LINE, " ")
    spaced = F.concat(F.lit(" "), F.replace(words, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    lines = F.transform(F.split(_unify(spaced), "\n", -1), lambda x: F.trim(x))
    return F.filter(lines, lambda x: x != "")


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the files in ``known_licenses``, with and without a title and list numbers."""
    out = []
    for file in sorted(resources.files("barlake.llm").joinpath("known_licenses").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        titles = TITLES.get(name, [])
        bodies = [text, re.sub(r"(?m)^[1-9]\. ", "", text)] if titles else [text]
        out += [(name, f"{title}\n\n{body}" if title else body) for body in dict.fromkeys(bodies) for title in ("", *titles)]
    return out


def known_texts() -> list[tuple[str, str]]:
    """(licence, text) of all notices and texts that are looked up by default."""
    return [*NOTICES, *full_texts()]


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """license_id, text of the licences to look for; any other table of that shape will do."""
    return spark.createDataFrame(known_texts() if texts is None else texts, "license_id string, text string")


def known_digests(known: DataFrame, digest_name: str, license_name: str) -> DataFrame:
    common.require(known, "license_id", "text")
    return (
        known.select(F.col("license_id").alias(license_name), digest(F.col("text").cast("string")).alias(digest_name))
        .where(F.col(license_name).isNotNull() & (F.col(digest_name) != F.sha2(F.lit(""), 256)))
        .groupBy(digest_name)
        .agg(F.min(license_name).alias(license_name))
    )


def license_scan(docs: DataFrame, known: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row with digest and license_id (null: no known licence is the entire text).

    Unmatched digests are spread by themselves and a licence's copies share one digest,
    so the known side is the one to broadcast; Spark decides that by its size.
    """
    common.require(docs, text_col)
    key, name = common.unused(docs, "digest"), common.unused(docs, "license")
    rows = docs.withColumn(key, digest(F.col(f"`{text_col}`").cast("string")))
    out = common.without(rows.join(known_digests(known, key, name), key, "left"), "digest", "license_id")
    rest = [F.col(f"`{c}`") for c in out.columns if c not in (key, name)]
    return out.select(*rest, F.col(key).alias("digest"), F.col(name).alias("license_id"))


def notice_scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text key and the sorted ids of licences that an entire line states; only rows with one."""
    common.require(docs, id_col, text_col)
    text = F.col(f"`{text_col}`").cast("string")
    lines = docs.select(F.col(f"`{id_col}`").alias("id"), common.text_key(text).alias("text_key"), F.explode(canonical_lines(text)).alias("line"))
    hits = lines.select("id", "text_key", F.sha2("line", 256).alias("digest")).join(known_digests(known, "digest", "license"), "digest")
    found = hits.groupBy("id", "text_key").agg(F.sort_array(F.collect_set("license")).alias("notices"))
    return found.withColumnRenamed("id", id_col)
