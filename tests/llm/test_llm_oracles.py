"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from conftest import SF_DIR
from fleetwise.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF_DIR)
    rel = con.sql(Q.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    at = [rel.columns.index(c) for c in df.columns]
    norm = lambda r: tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r)
    assert sorted(norm(r) for r in df.collect()) == sorted(norm([r[i] for i in at]) for r in rel.fetchall())
