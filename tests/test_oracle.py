"""Every registered query against its DuckDB oracle at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_DIR
from fleetwise.plans import catalog
from fleetwise.sources.tables import TABLES

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    assert s_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
    drows = rel.fetchall()
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows) == _rows(rel.columns, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_end_ms", "driver_id", "sum_tips"]
