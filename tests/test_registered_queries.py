"""Every registered query against its DuckDB oracle, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans import registry, tpch_sources
from tests.conftest import SF_SMALL
from tools.oracle_check import _digest, duck_rows, spark_rows

# The library's own queries; tests/llm covers those of strata/llm.
QUERIES = registry.QUERIES
ORACLE = registry.ORACLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in tpch_sources.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    scols, sdata, stypes = spark_rows(QUERIES[name](spark, SF_SMALL))
    dcols, ddata, dtypes = duck_rows(duck, ORACLE[name])
    assert scols == dcols
    assert {c: stypes[c] for c in scols} == {c: dtypes[c] for c in dcols}
    assert len(sdata) == len(ddata)
    assert _digest(sdata) == _digest(ddata)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "campo_limpo" in df.columns
