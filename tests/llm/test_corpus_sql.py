"""The corpus queries that have SQL, against it."""

import duckdb
import pytest

from feedloom.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.sql(registry.ORACLES[name])
    df = registry.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    got = sorted((tuple(r[c] for c in rel.columns) for r in df.collect()), key=str)
    assert got == sorted(rel.fetchall(), key=str) and got
