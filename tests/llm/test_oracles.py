"""Queries with SQL against DuckDB on the same tables."""

import duckdb
import pytest

from llm_cases import SF0001
from ledgerloom.llm.queries import QUERIES, oracle_sql


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    rel = con.execute(oracle_sql()[name])
    names = [d[0] for d in rel.description]
    got = QUERIES[name](spark, SF0001)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, rel.fetchall()))
