"""Operator 5: secret scan by a randomness test battery.

Three base patterns (key assignments, access key ids, hexadecimal runs) always count. The method
adds spans: what the base spans leave of a run of characters of ``[A-Za-z0-9+/_=-]`` is a
candidate where it has 20 characters or more, and so are the parts of it that a name or path
before or behind may hide: the parts between ``=``, these without the names at both ends, and the
parts between ``=``, ``/``, ``_`` and ``-``. Parts with letters of one case only are not
tested. The encoding is the smallest alphabet that holds a part (hex, base32, base36, base64). Against the hypothesis of
independent uniform symbols stand a chi-squared test over the alphabet's parts, a runs test
about its middle and a serial-correlation test; Fisher's method joins their p-values.
Benjamini-Hochberg at ``Q`` within each length class, over all candidates of the table,
rejects those that are no random strings; the rest are reported as ``random``, a part inside
another reported one not again.

The p-values are binned (20 bins per unit of -ln p), so the control needs one partial
aggregate to at most 4 x 2,001 rows, whatever the input.

Defined cases: null text is empty; positions are code points, end exclusive; repeated
rows are scanned alike; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm import common

# The base patterns and the least length of what counts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
# Parts of a run: between '=' (padding at the run's end belongs to its part), and between all separators.
VALUE = rf"(?=[A-Za-z0-9+/_=-]{{{LEAST}}})[A-Za-z0-9+/_-]++(?:={{1,2}}(?!.))?"
PART = rf"[A-Za-z0-9+]{{{LEAST},}}"
# Names with their separators at the start of a text, and of a reversed one. Possessive: no recursion per name.
NAMES = "^(?:(?:[A-Z]+|[A-Z]?[a-z]*)[0-9]{0,4}[/_-]+)*+"
NAMES_REVERSED = "^(?:[0-9]{0,4}(?:[A-Z]+|[a-z]*[A-Z]?)[/_-]+)*+"
Q = 0.05
BINS_PER_UNIT, LAST_BIN = 20, 2000
LENGTH_CLASSES = (32, 48, 80)

# encoding -> (alphabet in value order, [(part of the alphabet, its symbols)])
ENCODINGS = {
    "hex": ("0123456789abcdef", [("[0-4]", 5), ("[5-9]", 5), ("[a-c]", 3), ("[d-f]", 3)]),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", [("[A-M]", 13), ("[N-Z]", 13), ("[2-7]", 6)]),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", [("[0-9]", 10), ("[a-m]", 13), ("[n-z]", 13)]),
    "base64": (
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
        [("[A-M]", 13), ("[N-Z]", 13), ("[a-m]", 13), ("[n-z]", 13), ("[0-9]", 10), ("[+/]", 2)],
    ),
}


def _spans(text: Column, pattern: str, least: int, kind: int, group: int = 0) -> Column:
    """Spans of leftmost non-overlapping matches whose ``group`` has ``least`` characters or more.

    The text between matches gives the positions: a match starts after all earlier pieces and matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.char_length)
    steps = F.arrays_zip(
        F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), F.char_length).alias("gap"),
        F.transform(found, F.char_length).alias("size"),
        sizes.alias("value"),
    )
    folded = F.aggregate(
        steps,
        F.expr("named_struct('at', 0, 'out', CAST(array() AS array<struct<start:int,kind:int,stop:int>>))"),
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(
                x["value"] >= least,
                F.concat(
                    s["out"],
                    F.array(
                        F.struct(
                            (s["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (s["at"] + x["gap"] + x["size"]).alias("stop")
                        )
                    ),
                ),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
        lambda s: s["out"],
    )
    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,stop:int>>)")
    return F.when(text.rlike(pattern), folded).otherwise(none)


def base_spans(text: Column) -> Column:
    """Sorted array of (start, kind, stop) of the base patterns. A run of hexadecimal or access
    key characters is matched whole, so its least length can stand in the pattern."""
    return F.array_sort(
        F.concat(
            _spans(text, ASSIGN, MIN_VALUE, 0, group=2),
            _spans(text, f"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}", MIN_ACCESS, 1),
            _spans(text, f"[0-9a-f]{{{MIN_HEX},}}", MIN_HEX, 2),
        )
    )


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by its logistic approximation."""
    return 1 / (1 + F.exp(F.least(1.5976 * z + 0.070565 * z * z * z, F.lit(700.0))))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions read several times: a generator keeps the optimizer from
    writing their expressions out at every use."""
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline(packed))


def battery(tokens: DataFrame) -> DataFrame:
    """Add encoding, n, p_uniform, p_runs, p_serial and p to rows with a ``token``; rows whose
    token has letters of one case only are left out."""
    plain = F.translate(F.regexp_replace("token", "=", ""), "-_", "+/")
    rows = _once(tokens, plain=plain).where("NOT plain RLIKE '^([a-z]*|[A-Z]*)$'")
    encoding = (
        F.when(F.col("plain").rlike("^([0-9a-f]*|[0-9A-F]*)$"), "hex")
        .when(F.col("plain").rlike("^[A-Z2-7]*$"), "base32")
        .when(F.col("plain").rlike("^([a-z0-9]*|[A-Z0-9]*)$"), "base36")
        .otherwise("base64")
    )
    rows = _once(rows, encoding=encoding)
    pick = lambda of: F.coalesce(*[F.when(F.col("encoding") == e, of(e)) for e in ENCODINGS])
    symbols = F.when(F.col("encoding").isin("hex", "base36"), F.lower("plain")).otherwise(F.col("plain"))
    rows = _once(rows, symbols=symbols, alphabet=pick(lambda e: F.lit(ENCODINGS[e][0])))
    number = F.transform(F.split("symbols", ""), lambda c: (F.instr(F.col("alphabet"), c) - 1).cast("double"))
    rows = _once(rows, v=number, n=F.char_length("symbols").cast("double"), k=F.char_length("alphabet").cast("double"))
    later = F.slice("v", 2, F.size("v") - 1)
    pairs = F.zip_with(F.slice("v", 1, F.size("v") - 1), later, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    half, mean = F.col("k") / 2, (F.col("k") - 1) / 2
    rows = _once(rows, pairs=pairs, high=F.size(F.filter("v", lambda x: x >= half)).cast("double"))
    rows = _once(
        rows,
        z_chi=pick(lambda e: _z_chi(*ENCODINGS[e])),
        runs=1.0 + F.size(F.filter("pairs", lambda p: (p["a"] >= half) != (p["b"] >= half))),
        mu=2 * F.col("high") * (F.col("n") - F.col("high")) / F.col("n") + 1,
        cross=F.aggregate("pairs", F.lit(0.0), lambda s, p: s + (p["a"] - mean) * (p["b"] - mean)),
    )
    n, mu = F.col("n"), F.col("mu")
    var_runs = (mu - 1) * (mu - 2) / (n - 1)
    # Variance of a symbol's value under the hypothesis.
    var_symbol = (F.col("k") * F.col("k") - 1) / 12
    rows = _once(
        rows,
        z_runs=F.when(var_runs > 0, F.abs(F.col("runs") - mu) / F.sqrt(F.greatest(var_runs, F.lit(1e-9)))).otherwise(0.0),
        z_serial=F.abs(F.col("cross")) / (var_symbol * F.sqrt(n - 1)),
    )
    tiny = F.lit(1e-300)
    rows = _once(
        rows,
        p_uniform=F.greatest(_upper_tail(F.col("z_chi")), tiny),
        p_runs=F.greatest(2 * _upper_tail(F.col("z_runs")), tiny),
        p_serial=F.greatest(2 * _upper_tail(F.col("z_serial")), tiny),
    )
    rows = _once(rows, x=-(F.log("p_uniform") + F.log("p_runs") + F.log("p_serial")))
    x = F.col("x")
    return rows.select(
        *[F.col(c) for c in tokens.columns], "encoding", "n", "p_uniform", "p_runs", "p_serial",
        (F.exp(-x) * (1 + x + x * x / 2)).alias("p"),
    )


def _z_chi(alphabet: str, parts: list[tuple[str, int]]) -> Column:
    """Normal deviate (Wilson-Hilferty) of the chi-squared statistic over an alphabet's parts."""
    chi = F.lit(0.0)
    for pattern, size in parts:
        expected = F.col("n") * (size / len(alphabet))
        chi = chi + F.pow(F.regexp_count("symbols", F.lit(pattern)) - expected, F.lit(2)) / expected
    df = len(parts) - 1
    spread = 2 / (9 * df)
    return (F.pow(chi / df, F.lit(1 / 3)) - (1 - spread)) / spread**0.5


def _uncovered(run: Column) -> Column:
    """The parts of a run's span that no base span covers; ``base`` is sorted by start."""
    cut = F.aggregate(
        F.filter("base", lambda b: (b["start"] < run["stop"]) & (run["start"] < b["stop"])),
        F.struct(run["start"].alias("at"), F.expr("CAST(array() AS array<struct<start:int,kind:int,stop:int>>)").alias("out")),
        lambda s, b: F.struct(
            F.greatest(s["at"], b["stop"]).alias("at"),
            F.concat(s["out"], F.array(F.struct(s["at"].alias("start"), F.lit(3).alias("kind"), b["start"].alias("stop")))).alias("out"),
        ),
        lambda s: F.concat(s["out"], F.array(F.struct(s["at"].alias("start"), F.lit(3).alias("kind"), run["stop"].alias("stop")))),
    )
    return F.filter(cut, lambda c: c["stop"] - c["start"] >= LEAST)


def _parts(token: Column) -> Column:
    """Spans within ``token`` to be tested: the whole, and what names before or behind may hide."""
    whole = F.array(F.struct(F.lit(0).alias("start"), F.lit(3).alias("kind"), F.char_length(token).alias("stop")))
    values = _spans(token, VALUE, LEAST, 3)

    def bare(x: Column) -> Column:
        value = F.substring(token, x["start"] + 1, x["stop"] - x["start"])
        before = F.char_length(F.regexp_extract(value, NAMES, 0))
        behind = F.char_length(F.regexp_extract(F.reverse(value), NAMES_REVERSED, 0))
        return F.struct((x["start"] + before).alias("start"), F.lit(3).alias("kind"), (x["stop"] - behind).alias("stop"))

    parts = F.array_distinct(F.concat(whole, values, F.transform(values, bare), _spans(token, PART, LEAST, 3)))
    return F.filter(parts, lambda x: x["stop"] - x["start"] >= LEAST)


def candidates(scanned: DataFrame) -> DataFrame:
    """One row per candidate outside the base spans: id, t, span, tests, length class, p bin."""
    free = F.flatten(F.transform(_spans(F.col("text"), CANDIDATE, LEAST, 3), _uncovered))
    runs = scanned.select("id", "t", "text", F.explode(free).alias("run")).select(
        "id", "t", F.col("run.start").alias("at"), F.substring(F.col("text"), F.col("run.start") + 1, F.col("run.stop") - F.col("run.start")).alias("run")
    )
    parts = runs.select("id", "t", "at", "run", F.explode(_parts(F.col("run"))).alias("part"))
    span = F.struct((F.col("at") + F.col("part.start")).alias("start"), F.col("part.kind"), (F.col("at") + F.col("part.stop")).alias("stop"))
    rows = parts.select(
        "id", "t", span.alias("span"), F.substring(F.col("run"), F.col("part.start") + 1, F.col("part.stop") - F.col("part.start")).alias("token")
    )
    size = sum((F.col("n") >= edge).cast("int") for edge in LENGTH_CLASSES)
    p_bin = F.least(F.floor(-F.log(F.greatest(F.col("p"), F.lit(1e-300))) * BINS_PER_UNIT), F.lit(LAST_BIN))
    return battery(rows).withColumn("size", size).withColumn("bin", p_bin)


def rejected_from(tested: DataFrame) -> DataFrame:
    """Benjamini-Hochberg per length class: the smallest p bin number that is rejected as not random."""
    counts = tested.groupBy("size", "bin").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("size"))
    rank = F.sum("n").over(Window.partitionBy("size").orderBy(F.desc("bin")))
    largest_p = F.exp(-F.col("bin") / BINS_PER_UNIT)
    return counts.select("size", "bin", (largest_p <= Q * rank / total).alias("ok")).where("ok").groupBy("size").agg(F.min("bin").alias("cut"))


def _outermost(spans: Column) -> Column:
    """The spans that lie in no other one."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["stop"]).alias("end"))))
    return F.aggregate(
        ordered,
        F.expr("named_struct('stop', -1, 'out', CAST(array() AS array<struct<start:int,kind:int,stop:int>>))"),
        lambda s, x: F.when(
            -x["end"] > s["stop"],
            F.struct(
                (-x["end"]).alias("stop"),
                F.concat(s["out"], F.array(F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), (-x["end"]).alias("stop")))).alias("out"),
            ),
        ).otherwise(s),
        lambda s: s["out"],
    )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row: its id and spans, an array of (start, kind number in KINDS, stop), sorted."""
    common.require(docs, id_col, text_col)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), common.text_key(text).alias("t"))
    scanned = _once(rows, base=base_spans(F.col("text")))
    tested = candidates(scanned)
    kept = tested.join(rejected_from(tested), "size", "left").where("cut IS NULL OR bin < cut")
    # Rows with the same id and text have the same spans.
    added = kept.groupBy("id", "t").agg(_outermost(F.collect_set("span")).alias("added")).select(F.col("id").alias("i2"), F.col("t").alias("t2"), "added")
    out = scanned.select("id", "t", "base").join(added, F.col("id").eqNullSafe(F.col("i2")) & (F.col("t") == F.col("t2")), "left")
    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,stop:int>>)")
    return out.select(
        F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans")
    )
