"""The domain views of ``fleetwise.sources.adapters`` written as DuckDB SQL.

Only the provided base tables exist on the oracle side, so each oracle query
carries the views it needs as common table expressions.  Times are epoch-ms
bigints; decimal literals are cast to DOUBLE (DuckDB reads them as DECIMAL).
"""

from __future__ import annotations


def _lon(k: str, p: int) -> str:
    return f"CAST(CAST(-74.10 AS DOUBLE) + ({k}*{p} % 1000)*CAST(0.0005 AS DOUBLE) AS FLOAT)"


def _lat(k: str, p: int) -> str:
    return f"CAST(CAST(40.45 AS DOUBLE) + ({k}*{p} % 1000)*CAST(0.0006 AS DOUBLE) AS FLOAT)"


_START = "(1356998400000 + (o_orderkey*37 % 10080)*60000)"

VIEWS: dict[str, str] = {
    "rides_v": f"""rides_v AS (
  SELECT o_orderkey AS ride_id, k.is_start,
    {_START} AS start_ms,
    {_START} + (1 + o_orderkey % 120)*60000 AS end_ms,
    {_lon('o_orderkey', 7919)} AS start_lon, {_lat('o_orderkey', 104729)} AS start_lat,
    {_lon('o_orderkey', 15485863)} AS end_lon, {_lat('o_orderkey', 32452843)} AS end_lat,
    CAST(1 + o_orderkey % 5 AS SMALLINT) AS passenger_cnt,
    o_custkey % 100 AS taxi_id, o_custkey % 200 AS driver_id,
    CASE WHEN k.is_start THEN {_START} ELSE {_START} + (1 + o_orderkey % 120)*60000 END AS event_ms
  FROM orders, (VALUES (true), (false)) AS k(is_start)
  WHERE k.is_start OR o_orderstatus <> 'O')""",
    "fares_v": f"""fares_v AS (
  SELECT o_orderkey AS ride_id, o_custkey % 100 AS taxi_id, o_custkey % 200 AS driver_id,
    {_START} AS start_ms,
    CASE WHEN o_orderkey % 3 = 0 THEN 'CSH' ELSE 'CRD' END AS payment_type,
    CAST((o_orderkey*13 % 2000)/CAST(100 AS DOUBLE) AS FLOAT) AS tip,
    CAST(CASE WHEN o_orderkey % 4 = 0 THEN CAST(5.76 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS FLOAT) AS tolls,
    CAST(o_totalprice / CAST(10000 AS DOUBLE) AS FLOAT) AS total_fare
  FROM orders)""",
    "fares_some_v": """fares_some_v AS (SELECT * FROM fares_v WHERE ride_id % 11 <> 0)""",
    "car_v": f"""car_v AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS car_id, ts AS event_time,
    (epoch_us(ts) // 1000) AS event_ms,
    {_lon('event_id', 7919)} AS longitude, {_lat('event_id', 104729)} AS latitude,
    CAST(value / CAST(10 AS DOUBLE) AS FLOAT) AS consumption,
    CAST(CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE value END AS FLOAT) AS speed,
    CAST(json_extract_string(props, '$.k') AS FLOAT) AS throttle,
    CAST(value AS FLOAT) AS engineload
  FROM events)""",
    "trades_v": """trades_v AS (
  SELECT (epoch_us(ts) // 1000) AS trade_ms, ts AS trade_ts, user_id AS customer_id, CAST(event_id AS VARCHAR) AS trade_info
  FROM events WHERE event_type = 'purchase')""",
    "customers_v": """customers_v AS (
  SELECT (epoch_us(ts) // 1000) AS customer_ms, ts AS customer_ts, user_id AS customer_id,
         CAST(event_id AS VARCHAR) AS customer_info
  FROM events WHERE event_type = 'signup')""",
    "calls_v": """calls_v AS (
  SELECT event_id AS call_id, user_id, (epoch_us(ts) // 1000) AS timestamp,
    CAST(-74.10 AS DOUBLE) + (event_id*7919 % 1000)*CAST(0.0005 AS DOUBLE) AS longitude,
    CAST(40.45 AS DOUBLE) + (event_id*104729 % 1000)*CAST(0.0006 AS DOUBLE) AS latitude
  FROM events WHERE event_type = 'click')""",
    "timeline_v": """timeline_v AS (
  SELECT event_id*2 AS seq, 'E' AS kind, (epoch_us(ts) // 1000) AS time, user_id AS key,
         CAST(CASE WHEN event_type = 'purchase' THEN 5 ELSE 4 END AS BIGINT) AS value
  FROM events
  UNION ALL
  SELECT event_id*2 + 1, 'W', (epoch_us(ts) // 1000), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM events)""",
}

# Views that other views are built on.
DEPENDS = {}


def with_views(body: str, *names: str) -> str:
    ordered: list[str] = []
    for n in names:
        for d in DEPENDS.get(n, ()):
            if d not in ordered:
                ordered.append(d)
        if n not in ordered:
            ordered.append(n)
    ctes = [VIEWS[n] for n in ordered]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
