"""The operators' queries against their DuckDB SQL, on the small tables and on edge cases."""

import duckdb
import pytest

from barlake.llm.oracles import ORACLES
from barlake.llm.queries import QUERIES
from tests import oracle_compare
from tests.llm.conftest import EDGE_SCHEMA, EDGES, SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_small_tables(spark, name, monkeypatch):
    monkeypatch.setattr(oracle_compare, "EXACT", True)
    result = oracle_compare.compare(spark, oracle_compare.duck(SF), SF, name, QUERIES[name], ORACLES[name])
    assert result["match"], result


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    """Tables of edge cases under the names of the real ones."""
    out = str(tmp_path_factory.mktemp("edges"))
    edges = [r for r in EDGES if r[0] not in (8, 9)]
    repeated = "line one is here\nline two\n\nline three\nline four"
    edges += [(20, repeated, "en", 1), (21, "x\n" + repeated + "\ny", "en", 1), (22, "Released under the MIT Licence", "en", 1)]
    edges += [(23, "(c) 2020 someone\nReleased under the M.I.T. License\n\n", "en", 1), (24, "all rights reserved", "en", 1)]
    spark.createDataFrame(edges, EDGE_SCHEMA).write.parquet(f"{out}/documents.parquet")
    item = "the same words of a text that has three lines in all of them and a fourth"
    items = [(1, item), (1, item), (None, "one"), (2, None), (3, ""), (10, "words of a")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    long = "w " * 700
    turns = [(1, 0, "system", "be <s> [kind] \\l"), (1, 1, "user", long), (1, 2, "assistant", long), (1, 3, "user", "a b c"), (1, 4, "assistant", "d"), (1, 5, "user", long)]
    turns += [(2, 0, None, None), (2, 0, None, None), (2, None, "assistant", "")] + [(None, i, ("user", "assistant")[i % 2], f"t{i} " * (i % 40)) for i in range(120)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{out}/conversations.parquet")
    urls = [(1, "http://www.A.example.com/x/y?q"), (2, None), (3, "no url"), (4, "//u:p@b.example.com:80/x"), (None, "http://a.example.com/x"), (5, "http://localhost"), (5, "http://localhost"), (6, "")]
    pages = urls + [(100 + i, f"https://h{i % 7}.site{i % 3}.org/p/{i % 5}") for i in range(300)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{out}/pages.parquet")
    return out


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_edge_tables(spark, edge_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{edge_dir}/{t}.parquet/*.parquet')")
    result = oracle_compare.compare(spark, con, edge_dir, name, QUERIES[name], ORACLES[name])
    assert result["match"], result
    assert result["rows"]
