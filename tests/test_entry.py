import os

import duckdb
import pytest

from conftest import SF0001

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["category", "total_usd", "n_tx"]


def test_every_query_has_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {name for name in q if not name.startswith("op") and name != "pipeline"}
    assert own <= set(o)


@pytest.mark.skipif(not os.path.exists(SF0001), reason="driver data not present")
@pytest.mark.parametrize("name", ["amounts_clean", "dates_clean", "merchants_resolve", "spend_by_category_resolved"])
def test_oracle_agrees_on_sf0001(spark, name):
    con = duckdb.connect()
    for t in ["orders", "customer", "nation", "embeddings"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF0001)
    cols = sorted(sdf.columns)
    a = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
    rel = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    b = sorted(tuple(str(dict(zip(names, r))[c]) for c in cols) for r in rel.fetchall())
    assert len(a) == len(b)
    assert a == b
