"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from barlake import oracles, queries
from tests import oracle_compare
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.QUERIES, oracles.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name, monkeypatch):
    monkeypatch.setattr(oracle_compare, "EXACT", True)  # floats compared bit for bit
    result = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert result["match"], result


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["ticker", "date", "daily_returns", "daily_volatility"]
    assert df.count() > 0
