"""Every query built on the ordered scans, run with a tiny bucket target so
each key is cut into many buckets (the path a hot key takes at scale), must
still equal the DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_DIR
from fleetwise.operators import scan
from fleetwise.sources.tables import TABLES
from test_oracle import _rows

SCAN_QUERIES = ["q_trade_enrich", "q_gap_segments", "q_stopped_segments", "q_toggle_broadcast", "q_early_tumbling",
                "q_early_session", "q_finish_ordered_list"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SCAN_QUERIES)
def test_bucketed_scans_match_oracle(spark, con, name, monkeypatch):
    monkeypatch.setattr(scan, "TARGET_ROWS", 4)
    df = E.queries()[name](spark, SF_DIR)
    rel = con.sql(E.oracle_sql()[name])
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
