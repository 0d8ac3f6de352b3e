"""Registered queries: one per inventory item, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the provided tables through ``fleetwise.sources.adapters``
and runs a job from ``fleetwise.operators``; the final projection turns times
into epoch-ms bigints and single-precision values into doubles so results can
be compared with the DuckDB oracle (``ORACLES``, same column names).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwise.functions import geo
from fleetwise.functions.times import utc_day
from fleetwise.plans.oracle_views import with_views
from fleetwise.sources import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query.  The domain is UTC: no expression goes by the session's
    time zone, so a caller's session in another zone gets the same results."""
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def ms(c) -> Column:
    return F.unix_millis(F.col(c) if isinstance(c, str) else c)


def d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def rnd(c, k: int) -> Column:
    """Round to ``k`` decimals through DECIMAL and back: engines that agree to
    ``k`` places then return the identical double (plain ``round`` on a double
    may differ in the last bit between engines)."""
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal(38,{k})").cast("double")


def rnd_sql(expr: str, k: int) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(38,{k})) AS DOUBLE)"


RIDE_OUT_SQL = """ride_id, is_start, start_ms, end_ms,
  CAST(start_lon AS DOUBLE) AS start_lon, CAST(start_lat AS DOUBLE) AS start_lat,
  CAST(end_lon AS DOUBLE) AS end_lon, CAST(end_lat AS DOUBLE) AS end_lat,
  CAST(passenger_cnt AS INTEGER) AS passenger_cnt, taxi_id, driver_id"""


def ride_out(df: DataFrame, *more) -> DataFrame:
    return df.select(*more, "ride_id", "is_start", ms("start_time").alias("start_ms"), ms("end_time").alias("end_ms"),
                     d("start_lon").alias("start_lon"), d("start_lat").alias("start_lat"),
                     d("end_lon").alias("end_lon"), d("end_lat").alias("end_lat"),
                     F.col("passenger_cnt").cast("int").alias("passenger_cnt"), "taxi_id", "driver_id")


# --- step 0: minimum slice -------------------------------------------------------

from fleetwise.operators.cleansing import cleanse_rides  # noqa: E402
from fleetwise.operators.tips import hourly_tips  # noqa: E402

_NYC = """(NOT (NOT isnan({lon}) AND ({lon} > CAST(-73.7 AS DOUBLE) OR {lon} < CAST(-74.05 AS DOUBLE)))
   AND NOT (NOT isnan({lat}) AND ({lat} > CAST(41.0 AS DOUBLE) OR {lat} < CAST(40.5 AS DOUBLE))))"""


def nyc_sql(lon: str, lat: str) -> str:
    return _NYC.format(lon=f"CAST({lon} AS DOUBLE)", lat=f"CAST({lat} AS DOUBLE)")


@register("q_ride_cleansing", with_views(f"""
SELECT {RIDE_OUT_SQL} FROM rides_v
WHERE {nyc_sql('start_lon', 'start_lat')} AND {nyc_sql('end_lon', 'end_lat')}""", "rides_v"))
def q_ride_cleansing(spark, sf_dir):
    return ride_out(cleanse_rides(A.rides(spark, sf_dir)))


@register("q_hourly_tips", with_views("""
SELECT window_end_ms, driver_id, CAST(s AS DOUBLE) AS sum_tips FROM (
  SELECT (start_ms // 3600000 + 1) * 3600000 AS window_end_ms, driver_id,
         SUM(CAST(tip AS DECIMAL(12,2))) AS s
  FROM fares_v GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY window_end_ms ORDER BY s DESC, driver_id) = 1""", "fares_v"))
def q_hourly_tips(spark, sf_dir):
    r = hourly_tips(A.fares(spark, sf_dir))
    return r.select(ms("window_end").alias("window_end_ms"), "driver_id", d("sum_tips").alias("sum_tips"))


# --- step 1: geographic and small jobs --------------------------------------------

from fleetwise.operators import geo_jobs, status  # noqa: E402


def cell_sql(lon: str, lat: str) -> str:
    return (f"(CAST(floor((CAST(74.05 AS DOUBLE) - CAST(abs({lon}) AS DOUBLE)) / CAST(0.0014 AS DOUBLE)) AS INTEGER)"
            f" + CAST(floor((CAST(41.0 AS DOUBLE) - CAST({lat} AS DOUBLE)) / CAST(0.00125 AS DOUBLE)) AS INTEGER)"
            f" * 250)")


def center_lon_sql(c: str) -> str:
    return (f"CAST(CAST(CAST(74.05 AS DOUBLE) - ({c} % 250) * CAST(0.0014 AS DOUBLE) - CAST(0.0007 AS DOUBLE)"
            f" AS FLOAT) * CAST(-1.0 AS FLOAT) AS FLOAT)")


def center_lat_sql(c: str) -> str:
    return (f"CAST(CAST(41.0 AS DOUBLE) - (({c} - {c} % 250) // 250) * CAST(0.00125 AS DOUBLE)"
            f" - CAST(0.000625 AS DOUBLE) AS FLOAT)")


def dist_sql(lon1, lat1, lon2, lat2) -> str:
    x = f"CAST(CAST({lat1} AS FLOAT) - CAST({lat2} AS FLOAT) AS DOUBLE)"
    y = f"(CAST(CAST({lon1} AS FLOAT) - CAST({lon2} AS FLOAT) AS DOUBLE) * cos(CAST(CAST({lat2} AS FLOAT) AS DOUBLE)))"
    return f"(CAST(110.25 AS DOUBLE) * sqrt({x}*{x} + {y}*{y}))"


def angle_sql(lon1, lat1, lon2, lat2) -> str:
    x = f"CAST(CAST({lat2} AS FLOAT) - CAST({lat1} AS FLOAT) AS DOUBLE)"
    y = f"(CAST(CAST({lon2} AS FLOAT) - CAST({lon1} AS FLOAT) AS DOUBLE) * cos(CAST(CAST({lat1} AS FLOAT) AS DOUBLE)))"
    return f"(CAST(trunc(degrees(atan2({x}, {y}))) AS INTEGER) + 179)"


_EVENT_POINT_SQL = """SELECT *, CASE WHEN is_start THEN start_lon ELSE end_lon END AS lon,
       CASE WHEN is_start THEN start_lat ELSE end_lat END AS lat FROM rides_v"""


@register("q_cell_heatmap", with_views(f"""
SELECT (event_ms // 3600000 + 1) * 3600000 AS window_end_ms, {cell_sql('lon', 'lat')} AS cell_id,
       COUNT(*) AS n_events
FROM ({_EVENT_POINT_SQL}) p WHERE {nyc_sql('lon', 'lat')} GROUP BY 1, 2""", "rides_v"))
def q_cell_heatmap(spark, sf_dir):
    h = geo_jobs.cell_heatmap(A.rides(spark, sf_dir))
    return h.select(ms("window_end").alias("window_end_ms"), "cell_id", "n_events")


@register("q_cell_centers", with_views(f"""
SELECT cell_id, n_events, CAST({center_lon_sql('cell_id')} AS DOUBLE) AS center_lon,
       CAST({center_lat_sql('cell_id')} AS DOUBLE) AS center_lat
FROM (SELECT {cell_sql('lon', 'lat')} AS cell_id, COUNT(*) AS n_events
      FROM ({_EVENT_POINT_SQL}) p WHERE {nyc_sql('lon', 'lat')} GROUP BY 1)""", "rides_v"))
def q_cell_centers(spark, sf_dir):
    c = geo_jobs.cell_totals_with_centers(A.rides(spark, sf_dir))
    return c.select("cell_id", "n_events", d("center_lon").alias("center_lon"), d("center_lat").alias("center_lat"))


@register("q_direction_histogram", with_views(f"""
SELECT CAST(angle / 45 AS INTEGER) AS direction_bucket, COUNT(*) AS n_rides, MIN(angle) AS min_angle,
       MAX(angle) AS max_angle, CAST(CAST(SUM(km) AS DECIMAL(38,4)) AS DOUBLE) AS total_km
FROM (SELECT {angle_sql('start_lon', 'start_lat', 'end_lon', 'end_lat')} AS angle,
             {dist_sql('start_lon', 'start_lat', 'end_lon', 'end_lat')} AS km
      FROM rides_v WHERE is_start AND {nyc_sql('start_lon', 'start_lat')} AND {nyc_sql('end_lon', 'end_lat')})
GROUP BY 1""".replace("CAST(angle / 45 AS INTEGER)", "CAST(trunc(angle / 45) AS INTEGER)"), "rides_v"))
def q_direction_histogram(spark, sf_dir):
    h = geo_jobs.direction_histogram(A.rides(spark, sf_dir))
    return h.select("direction_bucket", "n_rides", "min_angle", "max_angle", rnd("total_km", 4).alias("total_km"))


@register("q_ride_duration", with_views("""
SELECT driver_id, COUNT(*) AS n_rides, CAST(SUM(end_ms - start_ms) AS BIGINT) AS total_ms,
       MIN(end_ms - start_ms) AS min_ms, MAX(end_ms - start_ms) AS max_ms
FROM rides_v WHERE NOT is_start GROUP BY driver_id""", "rides_v"))
def q_ride_duration(spark, sf_dir):
    r = geo_jobs.ride_durations(A.rides(spark, sf_dir))
    return r.select("driver_id", "n_rides", F.col("total_ms").cast("bigint").alias("total_ms"), "min_ms", "max_ms")


STATUS_SQL = """SELECT ride_id, taxi_id, driver_id, is_start,
  CAST(CASE WHEN is_start THEN start_lon ELSE end_lon END AS DOUBLE) AS longitude,
  CAST(CASE WHEN is_start THEN start_lat ELSE end_lat END AS DOUBLE) AS latitude,
  event_ms AS timestamp, CAST(passenger_cnt AS INTEGER) AS passenger_count"""


def status_out(df: DataFrame) -> DataFrame:
    return df.select("ride_id", "taxi_id", "driver_id", "is_start", d("longitude").alias("longitude"),
                     d("latitude").alias("latitude"), "timestamp",
                     F.col("passenger_count").cast("int").alias("passenger_count"))


@register("q_ride_status", with_views(f"{STATUS_SQL} FROM rides_v", "rides_v"))
def q_ride_status(spark, sf_dir):
    return status_out(status.ride_status(A.rides(spark, sf_dir)))


@register("q_latest_by_taxi", with_views(f"""{STATUS_SQL} FROM rides_v
QUALIFY row_number() OVER (PARTITION BY taxi_id ORDER BY event_ms DESC, is_start ASC, ride_id DESC) = 1""",
                                         "rides_v"))
def q_latest_by_taxi(spark, sf_dir):
    return status_out(status.ride_status(status.latest_by_taxi(A.rides(spark, sf_dir))))


# --- step 2: ingest / export, JSON in and out, points ------------------------------

from fleetwise.sinks import encode  # noqa: E402
from fleetwise.sources import control, text  # noqa: E402
from fleetwise.sources.tables import read_table  # noqa: E402
from fleetwise.operators.tips import tips_per_driver_hour  # noqa: E402


def spread(df: DataFrame) -> DataFrame:
    """Parsing is CPU-bound: spread a single-split source over the cores."""
    from fleetwise.session import spread_if_narrow
    return spread_if_narrow(df)


@register("q_ride_ingest", with_views(f"SELECT {RIDE_OUT_SQL} FROM rides_v", "rides_v"))
def q_ride_ingest(spark, sf_dir):
    """Ride log lines (exported from the ride view) parsed back, fail-fast."""
    lines = spread(text.format_ride_lines(A.rides(spark, sf_dir)).select("value"))
    return ride_out(text.parse_ride_lines(lines, mode="failfast"))


def _ts_sql(ms_col: str) -> str:
    return f"strftime(make_timestamp({ms_col} * 1000), '%Y-%m-%d %H:%M:%S')"


_RIDE_LINE_SQL = f"""concat_ws(',', CAST(ride_id AS VARCHAR), CASE WHEN is_start THEN 'START' ELSE 'END' END,
  CASE WHEN is_start THEN {_ts_sql('start_ms')} ELSE {_ts_sql('end_ms')} END,
  CASE WHEN is_start THEN {_ts_sql('end_ms')} ELSE {_ts_sql('start_ms')} END,
  CAST(start_lon AS VARCHAR), CAST(start_lat AS VARCHAR), CAST(end_lon AS VARCHAR), CAST(end_lat AS VARCHAR),
  CAST(passenger_cnt AS VARCHAR), CAST(taxi_id AS VARCHAR), CAST(driver_id AS VARCHAR))"""


@register("q_ride_export", with_views(f"SELECT ride_id, {_RIDE_LINE_SQL} AS value FROM rides_v", "rides_v"))
def q_ride_export(spark, sf_dir):
    return text.format_ride_lines(A.rides(spark, sf_dir))


FARE_OUT_SQL = """ride_id, taxi_id, driver_id, start_ms, payment_type, CAST(tip AS DOUBLE) AS tip,
  CAST(tolls AS DOUBLE) AS tolls, CAST(total_fare AS DOUBLE) AS total_fare"""


def fare_out(df: DataFrame, *more) -> DataFrame:
    return df.select(*more, "ride_id", "taxi_id", "driver_id", ms("start_time").alias("start_ms"), "payment_type",
                     d("tip").alias("tip"), d("tolls").alias("tolls"), d("total_fare").alias("total_fare"))


@register("q_fare_ingest", with_views(f"SELECT {FARE_OUT_SQL} FROM fares_v", "fares_v"))
def q_fare_ingest(spark, sf_dir):
    lines = spread(text.format_fare_lines(A.fares(spark, sf_dir)).select("value"))
    return fare_out(text.parse_fare_lines(lines, mode="failfast"))


CAR_OUT_SQL = """id, car_id, (epoch_us(date_trunc('second', event_time)) // 1000) AS event_ms,
  CAST(longitude AS DOUBLE) AS longitude, CAST(latitude AS DOUBLE) AS latitude,
  CAST(consumption AS DOUBLE) AS consumption, CAST(speed AS DOUBLE) AS speed,
  CAST(throttle AS DOUBLE) AS throttle, CAST(engineload AS DOUBLE) AS engineload"""


def car_out(df: DataFrame, *more) -> DataFrame:
    return df.select(*more, "id", "car_id", ms("event_time").alias("event_ms"),
                     *[d(n).alias(n) for n in ("longitude", "latitude", "consumption", "speed", "throttle", "engineload")])


@register("q_car_ingest", with_views(f"SELECT {CAR_OUT_SQL} FROM car_v", "car_v"))
def q_car_ingest(spark, sf_dir):
    """Car log lines (23 fields, mixed separators) parsed back; the line
    format keeps whole seconds."""
    lines = spread(text.format_car_lines(A.car_events(spark, sf_dir), filler="x").select("value"))
    lines = lines.select(F.regexp_replace("value", ",x,x,", ";x; x,").alias("value"))  # mixed separators
    return car_out(text.parse_car_lines(lines, mode="failfast"))


def call_messages(spark, sf_dir) -> DataFrame:
    """One control message per event: clicks and purchases are calls, views
    lack a field, signups carry a mistyped field, errors are not JSON."""
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    lon = F.lit(A.LON0) + ((k * A.P_START_LON) % 1000) * F.lit(A.DLON)
    lat = F.lit(A.LAT0) + ((k * A.P_START_LAT) % 1000) * F.lit(A.DLAT)
    full = F.to_json(F.struct(F.col("user_id").alias("userId"), F.unix_millis("ts").alias("timestamp"),
                              lon.alias("longitude"), lat.alias("latitude")))
    partial = F.to_json(F.struct(F.col("user_id").alias("userId"), F.unix_millis("ts").alias("timestamp"),
                                 lon.alias("longitude")))
    mistyped = F.concat(F.lit('{"userId":'), F.col("user_id").cast("string"), F.lit(',"timestamp":"t'),
                        k.cast("string"), F.lit('","longitude":1.5,"latitude":2.5}'))
    t = F.col("event_type")
    msg = (F.when(t.isin("click", "purchase"), full).when(t == "view", partial)
           .when(t == "signup", mistyped).otherwise(F.concat(F.lit("call "), k.cast("string"))))
    return e.select(msg.alias("value"))


@register("q_json_control", """
SELECT user_id, (epoch_us(ts) // 1000) AS timestamp,
  CAST(-74.10 AS DOUBLE) + (event_id*7919 % 1000)*CAST(0.0005 AS DOUBLE) AS longitude,
  CAST(40.45 AS DOUBLE) + (event_id*104729 % 1000)*CAST(0.0006 AS DOUBLE) AS latitude
FROM events WHERE event_type IN ('click', 'purchase')""")
def q_json_control(spark, sf_dir):
    return control.parse_calls(spread(call_messages(spark, sf_dir)))


STATUS_WIRE = {"rideId": "ride_id", "taxiId": "taxi_id", "driverId": "driver_id", "isStart": "is_start",
               "longitude": "longitude", "latitude": "latitude", "timestamp": "timestamp",
               "passengerCount": "passenger_count"}


@register("q_json_out", with_views("""
SELECT CAST(taxi_id AS VARCHAR) AS key, CAST(to_json(struct_pack(rideId := ride_id, taxiId := taxi_id,
  driverId := driver_id, isStart := is_start,
  longitude := CAST(CAST(CASE WHEN is_start THEN start_lon ELSE end_lon END AS VARCHAR) AS DOUBLE),
  latitude := CAST(CAST(CASE WHEN is_start THEN start_lat ELSE end_lat END AS VARCHAR) AS DOUBLE),
  timestamp := event_ms, passengerCount := passenger_cnt)) AS VARCHAR) AS value
FROM rides_v
QUALIFY row_number() OVER (PARTITION BY taxi_id ORDER BY event_ms DESC, is_start ASC, ride_id DESC) = 1""",
                                     "rides_v"))
def q_json_out(spark, sf_dir):
    """Latest status of every taxi as keyed JSON messages."""
    st = status.ride_status(status.latest_by_taxi(A.rides(spark, sf_dir)))
    return encode.json_records(st, STATUS_WIRE, key="taxi_id")


@register("q_datapoints", with_views("""
SELECT CAST(driver_id AS VARCHAR) AS key, window_end_ms AS time_ms, CAST(s AS DOUBLE) AS value,
  'tips,key=' || CAST(driver_id AS VARCHAR) || ' value=' || CAST(s AS VARCHAR) || ' '
    || CAST(window_end_ms * 1000000 AS VARCHAR) AS line
FROM (SELECT (start_ms // 3600000 + 1) * 3600000 AS window_end_ms, driver_id,
             SUM(CAST(tip AS DECIMAL(12,2))) AS s FROM fares_v GROUP BY 1, 2)""", "fares_v"))
def q_datapoints(spark, sf_dir):
    """Tips per driver and hour as keyed time-series points."""
    t = tips_per_driver_hour(A.fares(spark, sf_dir)).withColumn("time_ms", ms("window_end"))
    p = encode.datapoints(t, "tips", "time_ms", "sum_tips", key="driver_id")
    return p.select("key", "time_ms", d("value").alias("value"), "line")


# --- step 3: joins -------------------------------------------------------------------

from fleetwise.operators import asof, nearest, ongoing, pairing  # noqa: E402

PAIR_OUT_SQL = """r.ride_id, r.start_ms AS ride_start_ms, CAST(r.start_lon AS DOUBLE) AS ride_start_lon,
  CAST(r.start_lat AS DOUBLE) AS ride_start_lat, CAST(r.passenger_cnt AS INTEGER) AS ride_passenger_cnt,
  r.taxi_id AS ride_taxi_id, r.driver_id AS ride_driver_id, f.start_ms AS fare_start_ms,
  f.payment_type AS fare_payment_type, CAST(f.tip AS DOUBLE) AS fare_tip, CAST(f.total_fare AS DOUBLE) AS fare_total"""


def pair_out(df: DataFrame) -> DataFrame:
    return df.select("ride_id", ms("ride_start_time").alias("ride_start_ms"),
                     d("ride_start_lon").alias("ride_start_lon"), d("ride_start_lat").alias("ride_start_lat"),
                     F.col("ride_passenger_cnt").cast("int").alias("ride_passenger_cnt"),
                     "ride_taxi_id", "ride_driver_id", ms("fare_start_time").alias("fare_start_ms"),
                     "fare_payment_type", d("fare_tip").alias("fare_tip"), d("fare_total_fare").alias("fare_total"))


@register("q_rides_fares", with_views(f"""
SELECT {PAIR_OUT_SQL} FROM rides_v r JOIN fares_v f ON r.ride_id = f.ride_id WHERE r.is_start""",
                                      "rides_v", "fares_v"))
def q_rides_fares(spark, sf_dir):
    return pair_out(pairing.pair_rides_fares(A.rides(spark, sf_dir), A.fares(spark, sf_dir)))


_EXP_R = "(SELECT * FROM rides_v WHERE is_start AND driver_id % 1000 <> 0)"


@register("q_paired_rides", with_views(f"""
SELECT {PAIR_OUT_SQL} FROM {_EXP_R} r JOIN fares_some_v f ON r.ride_id = f.ride_id AND r.start_ms = f.start_ms""",
                                       "rides_v", "fares_v", "fares_some_v"))
def q_paired_rides(spark, sf_dir):
    return pair_out(pairing.expiring_pairs(A.rides(spark, sf_dir), A.fares(spark, sf_dir, some_missing=True))[0])


@register("q_solo_rides", with_views(f"""
SELECT ride_id, start_ms AS ride_start_ms, taxi_id AS ride_taxi_id, driver_id AS ride_driver_id
FROM {_EXP_R} r WHERE NOT EXISTS (SELECT 1 FROM fares_some_v f WHERE f.ride_id = r.ride_id AND f.start_ms = r.start_ms)""",
                                     "rides_v", "fares_v", "fares_some_v"))
def q_solo_rides(spark, sf_dir):
    s = pairing.expiring_pairs(A.rides(spark, sf_dir), A.fares(spark, sf_dir, some_missing=True))[1]
    return s.select("ride_id", ms("ride_start_time").alias("ride_start_ms"), "ride_taxi_id", "ride_driver_id")


@register("q_solo_fares", with_views(f"""
SELECT ride_id, start_ms AS fare_start_ms, taxi_id AS fare_taxi_id, driver_id AS fare_driver_id,
       CAST(tip AS DOUBLE) AS fare_tip
FROM fares_some_v f WHERE NOT EXISTS (SELECT 1 FROM {_EXP_R} r WHERE f.ride_id = r.ride_id AND f.start_ms = r.start_ms)""",
                                     "rides_v", "fares_v", "fares_some_v"))
def q_solo_fares(spark, sf_dir):
    s = pairing.expiring_pairs(A.rides(spark, sf_dir), A.fares(spark, sf_dir, some_missing=True))[2]
    return s.select("ride_id", ms("fare_start_time").alias("fare_start_ms"), "fare_taxi_id", "fare_driver_id",
                    d("fare_tip").alias("fare_tip"))


@register("q_trade_enrich", with_views("""
SELECT t.trade_ms, t.customer_id, t.trade_info, c.customer_ms, c.customer_info
FROM trades_v t LEFT JOIN customers_v c ON c.customer_id = t.customer_id AND c.customer_ts <= t.trade_ts
QUALIFY row_number() OVER (PARTITION BY t.customer_id, t.trade_ts, t.trade_info
                           ORDER BY c.customer_ts DESC NULLS LAST, c.customer_info DESC NULLS LAST) = 1""",
                                       "trades_v", "customers_v"))
def q_trade_enrich(spark, sf_dir):
    e = asof.asof_join(A.trades(spark, sf_dir), A.customers(spark, sf_dir), "customer_id", "trade_time",
                       "customer_time", ["customer_time", "customer_info"])
    return e.select(ms("trade_time").alias("trade_ms"), "customer_id", "trade_info",
                    ms("customer_time").alias("customer_ms"), "customer_info")


def taxi_positions(rides: DataFrame) -> DataFrame:
    """Latest END position of every taxi (the broadcast taxi state)."""
    ends = rides.where(~F.col("is_start"))
    last = status.latest_per_key(ends, "taxi_id", [F.col("event_time"), F.col("ride_id")])
    return last.select("taxi_id", F.unix_millis("end_time").alias("timestamp"),
                       F.col("end_lon").alias("longitude"), F.col("end_lat").alias("latitude"))


@register("q_nearest_taxi", with_views(f"""
, pos AS (SELECT taxi_id, end_ms AS taxi_timestamp, end_lon AS lon, end_lat AS lat FROM rides_v WHERE NOT is_start
          QUALIFY row_number() OVER (PARTITION BY taxi_id ORDER BY end_ms DESC, ride_id DESC) = 1)
SELECT c.call_id, c.user_id, c.timestamp, c.longitude, c.latitude, p.taxi_id, p.taxi_timestamp,
       CAST(p.lon AS DOUBLE) AS taxi_longitude, CAST(p.lat AS DOUBLE) AS taxi_latitude,
       CAST(CAST({dist_sql('c.longitude', 'c.latitude', 'p.lon', 'p.lat')} AS DECIMAL(38,9)) AS DOUBLE) AS distance
FROM calls_v c, pos p
QUALIFY row_number() OVER (PARTITION BY c.call_id ORDER BY {dist_sql('c.longitude', 'c.latitude', 'p.lon', 'p.lat')},
                           p.taxi_id) = 1""", "rides_v", "calls_v").replace("\n\n, pos", ",\npos").replace("\n, pos", ",\npos"))
def q_nearest_taxi(spark, sf_dir):
    pos = taxi_positions(A.rides(spark, sf_dir))
    n = nearest.nearest_taxi(A.calls(spark, sf_dir), pos)
    return n.select("call_id", "user_id", "timestamp", "longitude", "latitude", "taxi_id", "taxi_timestamp",
                    d("taxi_longitude").alias("taxi_longitude"), d("taxi_latitude").alias("taxi_latitude"),
                    rnd("distance", 9).alias("distance"))


POINT = (-73.9857, 40.7484)  # the point of the distance query


@register("q_event_distance", with_views(f"""
SELECT ride_id, is_start, CAST(CAST(CASE WHEN is_start
  THEN {dist_sql(f'CAST({POINT[0]} AS DOUBLE)', f'CAST({POINT[1]} AS DOUBLE)', 'start_lon', 'start_lat')}
  ELSE {dist_sql(f'CAST({POINT[0]} AS DOUBLE)', f'CAST({POINT[1]} AS DOUBLE)', 'end_lon', 'end_lat')} END AS DECIMAL(38,9)) AS DOUBLE) AS distance
FROM rides_v""", "rides_v"))
def q_event_distance(spark, sf_dir):
    """How far from one point every ride event is: its start for a START, its end for an END."""
    return A.rides(spark, sf_dir).select("ride_id", "is_start", rnd(geo.event_distance(F.lit(POINT[0]), F.lit(POINT[1])), 9).alias("distance"))


AT_MS = 1357300000000
REQUESTS = [(5,), (30,), (60,)]

OPEN_SQL = f"""SELECT s.ride_id, s.taxi_id, s.driver_id, s.start_ms, CAST(s.start_lon AS DOUBLE) AS start_lon,
  CAST(s.start_lat AS DOUBLE) AS start_lat, CAST(s.passenger_cnt AS INTEGER) AS passenger_cnt
FROM rides_v s WHERE s.is_start AND s.event_ms <= {AT_MS}
  AND NOT EXISTS (SELECT 1 FROM rides_v e WHERE NOT e.is_start AND e.ride_id = s.ride_id AND e.event_ms <= {AT_MS})"""


def open_out(df: DataFrame) -> DataFrame:
    return df.select("ride_id", "taxi_id", "driver_id", ms("start_time").alias("start_ms"),
                     d("start_lon").alias("start_lon"), d("start_lat").alias("start_lat"),
                     F.col("passenger_cnt").cast("int").alias("passenger_cnt"))


@register("q_open_rides", with_views(OPEN_SQL, "rides_v"))
def q_open_rides(spark, sf_dir):
    return open_out(ongoing.open_rides(A.rides(spark, sf_dir), AT_MS))


@register("q_ongoing_rides", with_views(f"""
SELECT {AT_MS} AS at_ms, CAST(r.during * 60000 AS BIGINT) AS during_ms, o.*
FROM ({OPEN_SQL}) o, (VALUES {', '.join(f'({x[0]})' for x in REQUESTS)}) AS r(during)
WHERE o.start_ms <= {AT_MS} - r.during * 60000""", "rides_v"))
def q_ongoing_rides(spark, sf_dir):
    req = spark.createDataFrame(REQUESTS, "during bigint")
    o = ongoing.ongoing_for_requests(ongoing.open_rides(A.rides(spark, sf_dir), AT_MS), req, AT_MS)
    return o.select(
        "at_ms", "during_ms", "ride_id", "taxi_id", "driver_id", ms("start_time").alias("start_ms"),
        d("start_lon").alias("start_lon"), d("start_lat").alias("start_lat"),
        F.col("passenger_cnt").cast("int").alias("passenger_cnt"))


# --- step 4: segments and travel-time model ---------------------------------------

from fleetwise.operators import segments, travel_time  # noqa: E402

SEGMENT_GAP = "6 hours"
SEGMENT_GAP_US = 6 * 3600 * 1_000_000
_LABEL_SQL = """CASE CAST(trunc(CAST(e AS FLOAT) / CAST(2.5 AS FLOAT)) AS INTEGER) WHEN 0 THEN 'calm'
  WHEN 1 THEN 'busy' ELSE 'crazy' END"""
_SEG_STATS_SQL = f"""min(event_ms) AS start_ms, COUNT(*) AS length, CAST(trunc(max(speed)) AS INTEGER) AS max_speed,
  stddev_pop(CAST(throttle AS DOUBLE)) AS e"""


def segment_out(df: DataFrame, extra: list | None = None) -> DataFrame:
    return df.select("car_id", ms("start_time").alias("start_ms"), "length", "max_speed",
                     rnd("erraticness", 4).alias("erraticness"), "description", *(extra or []))


@register("q_gap_segments", with_views(f"""
SELECT car_id, start_ms, length, max_speed, CAST(CAST(e AS DECIMAL(38,4)) AS DOUBLE) AS erraticness, {_LABEL_SQL} AS description FROM (
  SELECT car_id, sid, {_SEG_STATS_SQL} FROM (
    SELECT *, SUM(CASE WHEN prev IS NULL OR epoch_us(event_time) - epoch_us(prev) > {SEGMENT_GAP_US}
                       THEN 1 ELSE 0 END)
              OVER (PARTITION BY car_id ORDER BY event_time, id ROWS UNBOUNDED PRECEDING) AS sid
    FROM (SELECT *, lag(event_time) OVER (PARTITION BY car_id ORDER BY event_time, id) AS prev FROM car_v))
  GROUP BY car_id, sid)""", "car_v"))
def q_gap_segments(spark, sf_dir):
    return segment_out(segments.gap_segments(A.car_events(spark, sf_dir), SEGMENT_GAP))


@register("q_stopped_segments", with_views(f"""
SELECT car_id, start_ms, length, max_speed, CAST(CAST(e AS DECIMAL(38,4)) AS DOUBLE) AS erraticness, {_LABEL_SQL} AS description,
       stop_ms FROM (
  SELECT car_id, prev_stop, {_SEG_STATS_SQL}, min(next_stop) // 1000 AS stop_ms FROM (
    SELECT *,
      max(CASE WHEN speed = 0 THEN epoch_us(event_time) END) OVER (PARTITION BY car_id ORDER BY event_time
          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prev_stop,
      min(CASE WHEN speed = 0 THEN epoch_us(event_time) END) OVER (PARTITION BY car_id ORDER BY event_time
          RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_stop
    FROM car_v)
  WHERE speed <> 0 AND next_stop IS NOT NULL AND (prev_stop IS NULL OR prev_stop <> epoch_us(event_time))
  GROUP BY car_id, prev_stop)""", "car_v"))
def q_stopped_segments(spark, sf_dir):
    s = segments.stopped_segments(A.car_events(spark, sf_dir))
    return segment_out(s, [ms("stop_time").alias("stop_ms")])


_FEAT_SQL = f"""{angle_sql('start_lon', 'start_lat', 'end_lon', 'end_lat')} AS direction,
  {dist_sql('start_lon', 'start_lat', 'end_lon', 'end_lat')} AS distance,
  (end_ms - start_ms) / CAST(60000 AS DOUBLE) AS travel_min"""
_MODEL_SQL = f"""SELECT CAST(trunc(direction / 45) AS INTEGER) AS bucket, COUNT(*) AS n,
    SUM(distance * distance) AS sxx, SUM(distance * travel_min) AS sxy
  FROM (SELECT {_FEAT_SQL} FROM rides_v
        WHERE NOT is_start AND {nyc_sql('start_lon', 'start_lat')} AND {nyc_sql('end_lon', 'end_lat')})
  GROUP BY 1"""


@register("q_travel_time_model", with_views(f"""
SELECT bucket, n, CAST(CAST(sxx AS DECIMAL(38,4)) AS DOUBLE) AS sxx, CAST(CAST(sxy AS DECIMAL(38,4)) AS DOUBLE) AS sxy,
       CAST(CAST(CASE WHEN n >= 2 AND abs(sxx) >= 4.9e-323 THEN sxy / sxx END AS DECIMAL(38,9)) AS DOUBLE) AS slope
FROM ({_MODEL_SQL})""", "rides_v"))
def q_travel_time_model(spark, sf_dir):
    m = travel_time.train(A.rides(spark, sf_dir))
    return m.select("bucket", "n", rnd("sxx", 4).alias("sxx"), rnd("sxy", 4).alias("sxy"),
                    rnd("slope", 9).alias("slope"))


@register("q_travel_time_predict", with_views(f"""
SELECT r.ride_id, r.direction, CAST(CAST(r.distance AS DECIMAL(38,9)) AS DOUBLE) AS distance,
       COALESCE(CAST(trunc(m.slope * r.distance) AS INTEGER), -1) AS predicted_min
FROM (SELECT ride_id, {_FEAT_SQL} FROM rides_v
      WHERE is_start AND {nyc_sql('start_lon', 'start_lat')} AND {nyc_sql('end_lon', 'end_lat')}) r
LEFT JOIN (SELECT bucket, CASE WHEN n >= 2 AND abs(sxx) >= 4.9e-323 THEN sxy / sxx END AS slope
           FROM ({_MODEL_SQL})) m ON m.bucket = CAST(trunc(r.direction / 45) AS INTEGER)""", "rides_v"))
def q_travel_time_predict(spark, sf_dir):
    r = A.rides(spark, sf_dir)
    p = travel_time.predict(r, travel_time.train(r))
    return p.select("ride_id", "direction", rnd("distance", 9).alias("distance"), "predicted_min")


@register("q_travel_time_as_of", with_views(f"""
SELECT ride_id, CAST(bucket AS INTEGER) AS bucket, n,
       CASE WHEN n >= 2 AND abs(sxx) >= 4.9e-323 THEN CAST(trunc(sxy / sxx * distance) AS INTEGER) ELSE -1 END AS predicted_min
FROM (SELECT *, count(*) FILTER (NOT is_start) OVER w AS n, sum(distance * distance) FILTER (NOT is_start) OVER w AS sxx,
             sum(distance * travel_min) FILTER (NOT is_start) OVER w AS sxy
      FROM (SELECT *, trunc(direction / 45) AS bucket FROM (SELECT ride_id, is_start, event_ms, {_FEAT_SQL} FROM rides_v
            WHERE {nyc_sql('start_lon', 'start_lat')} AND {nyc_sql('end_lon', 'end_lat')}))
      WINDOW w AS (PARTITION BY bucket ORDER BY event_ms, is_start, ride_id ROWS UNBOUNDED PRECEDING))
WHERE is_start""", "rides_v"))
def q_travel_time_as_of(spark, sf_dir):
    """Every ride's travel time as the model of its moment would have predicted it."""
    p = travel_time.predict_as_of(A.rides(spark, sf_dir))
    return p.select("ride_id", F.col("bucket").cast("int").alias("bucket"), F.col("n").cast("bigint").alias("n"), "predicted_min")


# --- step 5: rules and control -----------------------------------------------------

from fleetwise.operators import rules as rules_op, toggle  # noqa: E402

# Rule table of the registered query: Spark SQL predicates over the latest
# status of every taxi (snake_case columns, ``watermark`` in epoch ms).
RULES = [
    (1, "passenger_count >= 4 AND NOT is_start"),
    (2, "timestamp <= watermark - 3600000"),
    (3, "no_such_column > 1"),
]
# The same predicates in the oracle's SQL dialect (rule 3 is rejected).
RULES_ORACLE = {1: "passenger_count >= 4 AND NOT is_start", 2: "timestamp <= watermark - 3600000"}


def _latest_status(spark, sf_dir):
    rides = A.rides(spark, sf_dir)
    return rides, status.ride_status(status.latest_by_taxi(rides))


@register("q_rules_engine", with_views(f"""
, st AS ({STATUS_SQL}, (SELECT max(event_ms) - 1 FROM rides_v) AS watermark FROM rides_v
         QUALIFY row_number() OVER (PARTITION BY taxi_id ORDER BY event_ms DESC, is_start ASC, ride_id DESC) = 1)
""".strip() + "\n" + "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS BIGINT) AS rule_id, ride_id, taxi_id, driver_id, is_start, longitude, latitude, timestamp, "
    f"passenger_count FROM st WHERE {c}" for i, c in RULES_ORACLE.items()), "rides_v").replace(",\n, st", ",\nst"))
def q_rules_engine(spark, sf_dir):
    rides, st = _latest_status(spark, sf_dir)
    wm = rides.agg(F.max(F.unix_millis("event_time"))).first()[0] - 1  # ride-side watermark
    rules = spark.createDataFrame(RULES, "rule_id bigint, condition string")
    matches, _ = rules_op.evaluate_rules(st, rules, wm)
    return matches.select("rule_id", *status_out(matches).columns).select(
        "rule_id", "ride_id", "taxi_id", "driver_id", "is_start", d("longitude").alias("longitude"),
        d("latitude").alias("latitude"), "timestamp", F.col("passenger_count").cast("int").alias("passenger_count"))


def day_controls(spark, sf_dir) -> DataFrame:
    """Control elements: the first event of every day (value = its id)."""
    e = read_table(spark, sf_dir, "events")
    first = e.groupBy(utc_day(F.col("ts")).alias("day")).agg(
        F.min_by(F.struct("ts", "event_id"), F.struct("ts", "event_id")).alias("f"))
    return first.select(F.col("f.ts").alias("time"), F.col("f.event_id").alias("value"))


@register("q_toggle_broadcast", """
WITH c AS (SELECT ts AS ctime, event_id AS cvalue FROM events
           QUALIFY row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY ts, event_id) = 1),
k AS (SELECT user_id AS key, ts FROM events WHERE event_type = 'view')
SELECT epoch_us(c.ctime) // 1000 AS control_ms, c.cvalue AS control_value, k.key
FROM c JOIN k ON k.ts <= c.ctime GROUP BY c.ctime, c.cvalue, k.key HAVING COUNT(*) % 2 = 1""")
def q_toggle_broadcast(spark, sf_dir):
    keyed = read_table(spark, sf_dir, "events").where(F.col("event_type") == "view").select(
        F.col("user_id").alias("key"), F.col("ts").alias("time"))
    out = toggle.apply_controls(keyed, day_controls(spark, sf_dir))
    return out.select(ms("control_time").alias("control_ms"), "control_value", "key")


_DAY_CONTROLS_SQL = """c AS (SELECT ts AS ctime, event_id AS cvalue FROM events
           QUALIFY row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY ts, event_id) = 1)"""


@register("q_toggle_all", f"""
WITH {_DAY_CONTROLS_SQL},
n AS (SELECT user_id AS key, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS n FROM events),
k AS (SELECT DISTINCT key, ts, n FROM n),
a AS (SELECT c.ctime, c.cvalue, u.key, (SELECT max(n) FROM k WHERE k.key = u.key AND k.ts <= c.ctime) AS n FROM c, (SELECT DISTINCT key FROM k) u)
SELECT epoch_us(ctime) // 1000 AS control_ms, cvalue AS control_value, key FROM a WHERE n % 2 = 1""")
def q_toggle_all(spark, sf_dir):
    """Every event toggles its user; the first event of a day is also a control."""
    keyed = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("ts").alias("time"))
    out = toggle.apply_controls(keyed, day_controls(spark, sf_dir))
    return out.select(ms("control_time").alias("control_ms"), "control_value", "key")


# Rules that fail on some rows, or are refused, beside good ones; and what they say in the oracle's SQL.
FAULTY_RULES = {
    1: ("passenger_count >= 4", "passenger_count >= 4"),
    2: ("10 / (passenger_count - 1) > 4", "10 / nullif(passenger_count - 1, 0) > 4"),
    3: ("cast(concat('x', taxi_id) as int) = 1 OR is_start", "TRY_CAST('x' || taxi_id AS INTEGER) = 1 OR is_start"),
    4: ("get(array(1, 2), passenger_count) = 2", "passenger_count = 1"),
    5: ("element_at(array(1), 5) = 1", None),
    6: ("reflect('java.lang.System', 'nanoTime') = '1'", None),
    7: ("ride_id % (taxi_id - taxi_id) = 0 OR taxi_id < 10", "taxi_id < 10"),
}


@register("q_rules_faulty", with_views(f"""
, st AS ({STATUS_SQL} FROM rides_v QUALIFY row_number() OVER (PARTITION BY taxi_id ORDER BY event_ms DESC, is_start ASC, ride_id DESC) = 1)
""".strip() + "\n" + "\nUNION ALL\n".join(f"SELECT CAST({i} AS BIGINT) AS rule_id, ride_id, taxi_id FROM st WHERE {c}"
                                         for i, (_, c) in FAULTY_RULES.items() if c), "rides_v").replace(",\n, st", ",\nst"))
def q_rules_faulty(spark, sf_dir):
    rides, st = _latest_status(spark, sf_dir)
    given = spark.createDataFrame([(i, c) for i, (c, _) in FAULTY_RULES.items()], "rule_id bigint, condition string")
    matches, _ = rules_op.evaluate_rules(st, given, 0)
    return matches.select("rule_id", "ride_id", "taxi_id")


# --- lines with faults ----------------------------------------------------------

# Fault planted in a line, by its number modulo 50: pattern and replacement.  Numbers 4 (an empty coordinate, tip or
# speed reads as 0) leave a valid record, the others a reject.
LINE_FAULTS = {
    "ride": {1: ("$", ",x"), 2: ("(START|END)", "STOP"), 3: ("^([^,]*,[^,]*),[^,]*", "{1},soon"), 4: ("^([^,]*,[^,]*,[^,]*,[^,]*),[^,]*", "{1},"),
             5: ("^(([^,]*,){8})[^,]*", "{1}"), 6: ("[^,]+$", ""), 7: ("^", "n")},
    "fare": {1: ("$", ",x"), 3: ("^([^,]*,[^,]*,[^,]*),[^,]*", "{1},soon"), 4: ("^(([^,]*,){5})[^,]*", "{1}"), 5: ("^(([^,]*,){6})[^,]*", "{1}?"),
             6: ("[^,]+$", "")},
    "car": {1: (",[^,]*$", ""), 3: (",[^,]*$", ",soon"), 4: ("^(([^,]*,){9})[^,]*", "{1}"), 5: ("^(([^,]*,){12})[^,]*", "{1}1,5"), 6: ("[^,]+$", "")},
}


def with_faults(lines: DataFrame, number: str, what: str) -> DataFrame:
    """``value`` lines, some of them made faulty by their number."""
    value = F.col("value")
    for n, (pattern, to) in LINE_FAULTS[what].items():
        value = F.when(F.col(number).cast("bigint") % 50 == n, F.regexp_replace("value", pattern, to.replace("{1}", "$1"))).otherwise(value)
    return lines.select(value.alias("value"))


def _faulty_sql(number: str, what: str) -> str:
    cases = " ".join(f"WHEN {n} THEN regexp_replace(value, '{p}', '{to.replace('{1}', chr(92) + '1')}')" for n, (p, to) in LINE_FAULTS[what].items())
    return f"CASE CAST({number} AS BIGINT) % 50 {cases} ELSE value END"


def _rejected(what: str) -> list[int]:
    return [n for n in LINE_FAULTS[what] if n != 4]


def _with_rejects_sql(good: str, number: str, what: str, view: str, line: str, rejected: str, zero: str) -> str:
    """Valid records (the column ``zero`` is 0 where it was emptied), then the rejected lines."""
    nr = f"CAST({number} AS BIGINT) % 50"
    bad = ", ".join(map(str, _rejected(what)))
    return f"""
SELECT CAST(NULL AS VARCHAR) AS rejected, {good} FROM (SELECT * REPLACE (CASE WHEN {nr} = 4 THEN CAST(0 AS FLOAT) ELSE {zero} END AS {zero}) FROM {view})
WHERE {nr} NOT IN ({bad})
UNION ALL BY NAME
SELECT {rejected} AS rejected FROM (SELECT {_faulty_sql(number, what)} AS value FROM (SELECT *, {line} AS value FROM {view}) WHERE {nr} IN ({bad}))"""


_FARE_LINE_SQL = f"""concat_ws(',', CAST(ride_id AS VARCHAR), CAST(taxi_id AS VARCHAR), CAST(driver_id AS VARCHAR), {_ts_sql('start_ms')}, payment_type,
  CAST(tip AS VARCHAR), CAST(tolls AS VARCHAR), CAST(total_fare AS VARCHAR))"""
_CAR_LINE_SQL = "concat_ws(',', car_id, id, repeat('x,', 20) || 'time')"
_HEAD_SQL = "regexp_extract(value, '^[^,]*,[^,]*')"  # the other fields are written as each engine writes single-precision numbers


def _head(rejected) -> Column:
    return F.when(rejected.isNotNull(), F.regexp_extract(rejected, "^[^,]*,[^,]*", 0)).alias("rejected")


@register("q_ride_rejects", with_views(_with_rejects_sql(RIDE_OUT_SQL, "ride_id", "ride", "rides_v", _RIDE_LINE_SQL, "value", "start_lon"), "rides_v"))
def q_ride_rejects(spark, sf_dir):
    """Ride lines, some with faults: records and rejected lines from one pass."""
    lines = with_faults(text.format_ride_lines(A.rides(spark, sf_dir)), "ride_id", "ride")
    return ride_out(text.parse_ride_lines(spread(lines), mode="tag"), "rejected")


@register("q_fare_rejects", with_views(_with_rejects_sql(FARE_OUT_SQL, "ride_id", "fare", "fares_v", _FARE_LINE_SQL, _HEAD_SQL, "tip"), "fares_v"))
def q_fare_rejects(spark, sf_dir):
    lines = with_faults(text.format_fare_lines(A.fares(spark, sf_dir)), "ride_id", "fare")
    return fare_out(text.parse_fare_lines(spread(lines), mode="tag"), _head(F.col("rejected")))


@register("q_car_rejects", with_views(_with_rejects_sql(CAR_OUT_SQL, "id", "car", "car_v", _CAR_LINE_SQL, _HEAD_SQL, "speed"), "car_v"))
def q_car_rejects(spark, sf_dir):
    lines = with_faults(text.format_car_lines(A.car_events(spark, sf_dir), filler="x"), "id", "car")
    return car_out(text.parse_car_lines(spread(lines), mode="tag"), _head(F.col("rejected")))


# --- step 6: route cells, early-firing windows -------------------------------------

from fleetwise.operators import routes  # noqa: E402


def _gx(lon):
    return f"CAST(floor((CAST(74.05 AS DOUBLE) - CAST(abs({lon}) AS DOUBLE)) / CAST(0.0014 AS DOUBLE)) AS BIGINT)"


def _gy(lat):
    return f"CAST(floor((CAST(41.0 AS DOUBLE) - CAST({lat} AS DOUBLE)) / CAST(0.00125 AS DOUBLE)) AS BIGINT)"


ROUTE_SQL = f"""WITH RECURSIVE {{views}},
g AS (SELECT ride_id, {_gx('start_lon')} AS x1, {_gy('start_lat')} AS y1, {_gx('end_lon')} AS x2,
             {_gy('end_lat')} AS y2
      FROM rides_v WHERE is_start AND {nyc_sql('start_lon', 'start_lat')} AND {nyc_sql('end_lon', 'end_lat')}),
o AS (SELECT ride_id, CASE WHEN x1 <= x2 THEN x1 ELSE x2 END AS sx, CASE WHEN x1 <= x2 THEN y1 ELSE y2 END AS sy,
             CASE WHEN x1 <= x2 THEN x2 ELSE x1 END AS ex, CASE WHEN x1 <= x2 THEN y2 ELSE y1 END AS ey FROM g),
walk(ride_id, sx, sy, ex, ey, slope, cx, cy) AS (
  SELECT ride_id, sx, sy, ex, ey, (ey - sy) / ((ex - sx) + CAST(0.00000001 AS DOUBLE)), sx, sy FROM o
  UNION ALL
  SELECT ride_id, sx, sy, ex, ey, slope,
    CASE WHEN slope > 0 THEN (CASE WHEN diag OR yp < cy THEN cx + 1 ELSE cx END)
         ELSE (CASE WHEN yp > cy - CAST(diag AS BIGINT) THEN cx + CAST(diag AS BIGINT) + 1
                    ELSE cx + CAST(diag AS BIGINT) END) END,
    CASE WHEN slope > 0 THEN (CASE WHEN diag THEN cy + 1 WHEN yp < cy THEN cy ELSE cy + 1 END)
         ELSE (CASE WHEN yp > cy - CAST(diag AS BIGINT) THEN cy - CAST(diag AS BIGINT)
                    ELSE cy - CAST(diag AS BIGINT) - 1 END) END
  FROM (SELECT *, yp > cy - CAST(0.05 AS DOUBLE) AND yp < cy + CAST(0.05 AS DOUBLE) AS diag
        FROM (SELECT *, CASE WHEN slope > 0 THEN (cx - sx + CAST(0.5 AS DOUBLE)) * slope + sy - CAST(0.5 AS DOUBLE)
                             ELSE (cx - sx + CAST(0.5 AS DOUBLE)) * slope + sy + CAST(0.5 AS DOUBLE) END AS yp
              FROM walk WHERE cx < ex OR cy <> ey) a) b)
SELECT CAST(cx + cy * 250 AS INTEGER) AS cell_id, COUNT(*) AS n_passes FROM walk GROUP BY 1"""


def _route_oracle() -> str:
    from fleetwise.plans.oracle_views import VIEWS
    return ROUTE_SQL.replace("{views}", VIEWS["rides_v"])


@register("q_route_cells", _route_oracle())
def q_route_cells(spark, sf_dir):
    return routes.route_traffic(A.rides(spark, sf_dir))


from fleetwise.operators import early  # noqa: E402

EARLY_SIZE_MS = 6 * 3_600_000     # tumbling window of the early-tumbling query
EARLY_GAP_MS = 6 * 3_600_000      # session gap of the early-session query
FINISH = 5

_TL_SQL = """t AS (SELECT *, max(CASE WHEN kind = 'W' THEN time END)
                    OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wm FROM timeline_v),
levels AS (SELECT wm AS lvl, min(seq) AS gseq FROM t WHERE kind = 'W' GROUP BY wm)"""


@register("q_early_tumbling", with_views(f"""
WITH {_TL_SQL},
e AS (SELECT *, (time // {EARLY_SIZE_MS}) * {EARLY_SIZE_MS} AS ws,
             (time // {EARLY_SIZE_MS}) * {EARLY_SIZE_MS} + {EARLY_SIZE_MS} AS window_end
      FROM t WHERE kind = 'E'),
ok AS (SELECT * FROM e WHERE wm IS NULL OR window_end - 1 > wm),
fin AS (SELECT key, window_end, CAST(SUM(value) AS BIGINT) AS total FROM ok GROUP BY key, window_end)
SELECT key, window_end, COALESCE(wm, -9223372036854775808) AS fired_at,
       CAST(SUM(value) OVER (PARTITION BY key, ws ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total,
       false AS is_final
FROM ok QUALIFY (time // 1000) % 2 = 0
UNION ALL
SELECT key, window_end, fired_at, total, window_end <= fired_at AS is_final FROM (
  SELECT key, window_end, total,
         COALESCE((SELECT min(lvl) FROM levels WHERE lvl >= window_end - 1), 9223372036854775807) AS fired_at
  FROM fin)""", "timeline_v"))
def q_early_tumbling(spark, sf_dir):
    r = early.early_tumbling(A.element_timeline(spark, sf_dir), EARLY_SIZE_MS)
    return r.select("key", "window_end", "fired_at", F.col("total").cast("bigint").alias("total"), "is_final")


@register("q_early_session", with_views(f"""
WITH {_TL_SQL},
e0 AS (SELECT * FROM t WHERE kind = 'E' AND (wm IS NULL OR time + {EARLY_GAP_MS} - 1 > wm)),
e AS (SELECT *, max(CASE WHEN prev IS NULL OR time - prev > {EARLY_GAP_MS} THEN time END)
                OVER (PARTITION BY key ORDER BY time, seq ROWS UNBOUNDED PRECEDING) AS sid
      FROM (SELECT *, lag(time) OVER (PARTITION BY key ORDER BY time, seq) AS prev FROM e0)),
checks AS (SELECT key, sid, greatest(time, COALESCE(wm + 1, time)) AS thr FROM e WHERE value = {FINISH}
           UNION ALL SELECT key, sid, max(time) + {EARLY_GAP_MS} - 1 FROM e GROUP BY key, sid),
looked AS (SELECT key, sid, (SELECT min(lvl) FROM levels WHERE lvl >= thr) AS lvl FROM checks),
fired AS (SELECT key, sid, COALESCE(l.gseq, 9223372036854775807) AS g,
                 min(COALESCE(k.lvl, 9223372036854775807)) AS fired_at
          FROM looked k LEFT JOIN levels l ON l.lvl = k.lvl GROUP BY 1, 2, 3),
counted AS (SELECT f.key, f.sid, f.g, f.fired_at, COUNT(*) AS n, max(e.time) AS tmax
            FROM fired f JOIN e ON e.key = f.key AND e.sid = f.sid AND e.seq < f.g GROUP BY 1, 2, 3, 4),
emitted AS (SELECT * FROM counted QUALIFY n > COALESCE(lag(n) OVER (PARTITION BY key, sid ORDER BY g), 0))
SELECT m.key, m.tmax + {EARLY_GAP_MS} AS window_end, m.fired_at, m.n, m.tmax + {EARLY_GAP_MS} <= m.fired_at AS is_final,
       row_number() OVER (PARTITION BY m.key, m.sid, m.g ORDER BY (e.value = {FINISH}), e.seq) AS position, e.value
FROM emitted m JOIN e ON e.key = m.key AND e.sid = m.sid AND e.seq < m.g""", "timeline_v"))
def q_early_session(spark, sf_dir):
    """Early-result session windows; each firing's finish-ordered list in row
    form (one row per position)."""
    r = early.early_session(A.element_timeline(spark, sf_dir), EARLY_GAP_MS, FINISH, lists=False)
    return r.select("key", "window_end", "fired_at", "n", "is_final",
                    F.col("position").cast("bigint").alias("position"), "value")


LATE_TL_SQL = """late_v AS (
  SELECT event_id*2 AS seq, 'E' AS kind, (epoch_us(ts) // 1000) - CASE WHEN event_id % 9 = 4 THEN (event_id % 13) * 3600000 ELSE 0 END AS time,
         user_id AS key, CAST(CASE WHEN event_type = 'purchase' THEN 5 ELSE 4 END AS BIGINT) AS value FROM events
  UNION ALL SELECT event_id*2 + 1, 'W', (epoch_us(ts) // 1000) - 3600000, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM events)"""


def late_timeline(spark, sf_dir) -> DataFrame:
    """The element timeline with every ninth element up to twelve hours late, behind a watermark delay of one hour:
    some come in time, some after their window has closed."""
    tl = A.element_timeline(spark, sf_dir, delay_ms=3_600_000)
    event_id = F.floor(F.col("seq") / 2)
    late = F.when((F.col("kind") == "E") & (event_id % 9 == 4), (event_id % 13) * 3_600_000).otherwise(F.lit(0))
    return tl.withColumn("time", F.col("time") - late)


@register("q_early_tumbling_late", f"""
WITH {LATE_TL_SQL},
{_TL_SQL.replace('timeline_v', 'late_v')},
e AS (SELECT *, (time // {EARLY_SIZE_MS}) * {EARLY_SIZE_MS} AS ws, (time // {EARLY_SIZE_MS}) * {EARLY_SIZE_MS} + {EARLY_SIZE_MS} AS window_end
      FROM t WHERE kind = 'E'),
ok AS (SELECT * FROM e WHERE wm IS NULL OR window_end - 1 > wm),
fin AS (SELECT key, window_end, CAST(SUM(value) AS BIGINT) AS total FROM ok GROUP BY key, window_end)
SELECT key, window_end, COALESCE(wm, -9223372036854775808) AS fired_at,
       CAST(SUM(value) OVER (PARTITION BY key, ws ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total, false AS is_final
FROM ok QUALIFY (time // 1000) % 2 = 0
UNION ALL
SELECT key, window_end, COALESCE(lvl, 9223372036854775807) AS fired_at, total, window_end <= COALESCE(lvl, 9223372036854775807) AS is_final
FROM (SELECT * FROM fin ASOF LEFT JOIN levels ON lvl >= window_end - 1)""")
def q_early_tumbling_late(spark, sf_dir):
    r = early.early_tumbling(late_timeline(spark, sf_dir), EARLY_SIZE_MS)
    return r.select("key", "window_end", "fired_at", F.col("total").cast("bigint").alias("total"), "is_final")


_FIRINGS_SQL = f"""e0 AS (SELECT * FROM t WHERE kind = 'E' AND (wm IS NULL OR time + {EARLY_GAP_MS} - 1 > wm)),
e AS (SELECT *, max(CASE WHEN prev IS NULL OR time - prev > {EARLY_GAP_MS} THEN time END)
                OVER (PARTITION BY key ORDER BY time, seq ROWS UNBOUNDED PRECEDING) AS sid
      FROM (SELECT *, lag(time) OVER (PARTITION BY key ORDER BY time, seq) AS prev FROM e0)),
checks AS (SELECT key, sid, greatest(time, COALESCE(wm + 1, time)) AS thr FROM e WHERE value = {FINISH}
           UNION ALL SELECT key, sid, max(time) + {EARLY_GAP_MS} - 1 FROM e GROUP BY key, sid),
looked AS (SELECT key, sid, lvl FROM checks ASOF LEFT JOIN levels ON lvl >= thr),
fired AS (SELECT key, sid, COALESCE(l.gseq, 9223372036854775807) AS g,
                 min(COALESCE(k.lvl, 9223372036854775807)) AS fired_at
          FROM looked k LEFT JOIN levels l ON l.lvl = k.lvl GROUP BY 1, 2, 3),
arrived AS (SELECT *, row_number() OVER w AS upto, max(time) OVER w AS tmax FROM e WINDOW w AS (PARTITION BY key, sid ORDER BY seq ROWS UNBOUNDED PRECEDING)),
counted AS (SELECT f.key, f.sid, f.g, f.fired_at, a.upto AS n, a.tmax
            FROM fired f ASOF JOIN arrived a ON a.key = f.key AND a.sid = f.sid AND a.seq < f.g),
emitted AS (SELECT * FROM counted QUALIFY n > COALESCE(lag(n) OVER (PARTITION BY key, sid ORDER BY g), 0))"""
_ELEMENTS_SQL = f"""SELECT a.key, a.sid AS session_start, a.seq AS arrival, a.value,
       count(*) OVER (PARTITION BY a.key, a.sid, a.value = {FINISH} ORDER BY a.seq ROWS UNBOUNDED PRECEDING) AS rank,
       m.fired_at, m.tmax + {EARLY_GAP_MS} AS window_end, m.n, m.tmax + {EARLY_GAP_MS} <= m.fired_at AS is_final
FROM e a ASOF JOIN emitted m ON m.key = a.key AND m.sid = a.sid AND a.seq < m.g"""


def _elements_out(df: DataFrame) -> DataFrame:
    return df.select("key", "session_start", "arrival", "value", F.col("rank").cast("bigint").alias("rank"), "fired_at", "window_end",
                     F.col("n").cast("bigint").alias("n"), "is_final")


@register("q_early_session_elements", with_views(f"""
WITH {_TL_SQL},
{_FIRINGS_SQL}
{_ELEMENTS_SQL}""", "timeline_v"))
def q_early_session_elements(spark, sf_dir):
    """Early-result session windows, one row per element: its place and the first firing that covers it."""
    return _elements_out(early.early_session_elements(A.element_timeline(spark, sf_dir), EARLY_GAP_MS, FINISH))


@register("q_early_session_late", f"""
WITH {LATE_TL_SQL},
{_TL_SQL.replace('timeline_v', 'late_v')},
{_FIRINGS_SQL}
{_ELEMENTS_SQL}""")
def q_early_session_late(spark, sf_dir):
    """As q_early_session_elements, over elements that come late: those behind the watermark by the gap are dropped."""
    return _elements_out(early.early_session_elements(late_timeline(spark, sf_dir), EARLY_GAP_MS, FINISH))


@register("q_finish_ordered_list", with_views(f"""
WITH e AS (SELECT *, max(CASE WHEN prev IS NULL OR time - prev > {EARLY_GAP_MS} THEN time END)
                OVER (PARTITION BY key ORDER BY time, seq ROWS UNBOUNDED PRECEDING) AS sid
      FROM (SELECT *, lag(time) OVER (PARTITION BY key ORDER BY time, seq) AS prev
            FROM timeline_v WHERE kind = 'E'))
SELECT key, sid AS session_start, max(time) OVER (PARTITION BY key, sid) + {EARLY_GAP_MS} AS session_end,
       row_number() OVER (PARTITION BY key, sid ORDER BY (value = {FINISH}), seq) AS position, value
FROM e""", "timeline_v"))
def q_finish_ordered_list(spark, sf_dir):
    """Finish-ordered list per key and session (gap 6 h) over whole sessions,
    one row per list position."""
    e = A.element_timeline(spark, sf_dir).where(F.col("kind") == "E")
    r = early.finish_ordered_rows(e, EARLY_GAP_MS, FINISH)
    return r.select("key", "session_start", "session_end", F.col("position").cast("bigint").alias("position"),
                    "value")
