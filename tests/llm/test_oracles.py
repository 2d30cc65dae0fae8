"""Corpus queries with a DuckDB oracle, on the smallest tables, by the rule of tests/test_oracle.py."""

import duckdb
import pytest

import __spark_entry__ as E
from claimlake.llm import registry
from conftest import SF_SMALL
from test_oracle import hashes


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_has_the_corpus_queries():
    assert set(registry.QUERIES) <= set(E.queries()) and set(registry.ORACLES) <= set(E.oracle_sql())
    assert set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_oracle(spark, tables, name):
    sdf = registry.QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = tables.sql(registry.ORACLES[name])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns) and len(srows) == len(drows)
    assert hashes(sdf.columns, srows) == hashes(rel.columns, drows)
