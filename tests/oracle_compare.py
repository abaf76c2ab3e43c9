"""Run registered queries in Spark and their SQL twins in DuckDB; compare results.

Columns are compared by name, rows as an unordered multiset; doubles are
compared after rounding to 6 places (the queries already round derived values).
Usable from pytest and as ``python tests/oracle_compare.py [sf_dir] [names...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = False  # set by --exact: compare floats bit for bit


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if EXACT else round(v, 6) + 0.0
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_sec": round(t1 - t0, 2), "rows": len(s_rows), "oracle_rows": len(d_rows)}
    out["columns_match"] = sorted(s_names) == sorted(d_names)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_names), sorted(d_names)
        out["match"] = False
        return out
    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
    out["match"] = a == b
    if not out["match"]:
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from barlake.session import build_session

    global EXACT
    if "--exact" in argv:
        EXACT = True
        argv = [a for a in argv if a != "--exact"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print({"name": name, "oracle": "none"})
            continue
        try:
            r = compare(spark, con, sf_dir, name, qs[name], sqls[name])
        except Exception as e:  # noqa: BLE001 - report and go on
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:400]}", "match": False}
        bad += not r["match"]
        print(r, flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
