"""Domain views derived from the provided tables.

The provided data is a generic star schema plus an event table; the jobs work
on taxi rides, fares, car events, trades/customers, calls and scripted
element timelines.  Each function here maps provided rows to one domain
record type with plain column expressions (one scan, no shuffle), so the
domain data grows with the provided data.  The same mapping is written in SQL
for the DuckDB oracle in ``fleetwise.plans.oracle_views``; both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwise.sources.tables import read_table

# Fixed values of the mapping (shared with the oracle SQL):
# rides start in the week after 2013-01-01 00:00 UTC (epoch ms 1356998400000),
# minute offset (orderkey * 37) mod 10080, duration 1 + orderkey mod 120 minutes;
# coordinates -74.10 + (k * p mod 1000) * 0.0005 for longitude and
# 40.45 + (k * p mod 1000) * 0.0006 for latitude, with p = 7919, 104729,
# 15485863, 32452843 for start lon, start lat, end lon, end lat;
# taxi = custkey mod 100, driver = custkey mod 200; orders with status 'O' have no END.
RIDE_EPOCH_MS = 1356998400000
LON0, DLON = -74.10, 0.0005
LAT0, DLAT = 40.45, 0.0006
P_START_LON, P_START_LAT, P_END_LON, P_END_LAT = 7919, 104729, 15485863, 32452843


def _lon(k, p):
    return (F.lit(LON0) + ((k * F.lit(p)) % 1000) * F.lit(DLON)).cast("float")


def _lat(k, p):
    return (F.lit(LAT0) + ((k * F.lit(p)) % 1000) * F.lit(DLAT)).cast("float")


def _start_ms(k):
    return F.lit(RIDE_EPOCH_MS) + ((k * 37) % 10080) * F.lit(60000)


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TaxiRide events: a START row per order and an END row unless status 'O'.

    One scan of ``orders``; the END row is produced by a generator, not by a
    second scan and a union.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    k = F.col("o_orderkey")
    start_ms = _start_ms(k)
    end_ms = start_ms + (F.lit(1) + k % 120) * F.lit(60000)
    kinds = F.when(F.col("o_orderstatus") != "O", F.array(F.lit(True), F.lit(False))) \
             .otherwise(F.array(F.lit(True)))
    df = o.select(
        k.alias("ride_id"),
        F.explode(kinds).alias("is_start"),
        F.timestamp_millis(start_ms).alias("start_time"),
        F.timestamp_millis(end_ms).alias("end_time"),
        _lon(k, P_START_LON).alias("start_lon"),
        _lat(k, P_START_LAT).alias("start_lat"),
        _lon(k, P_END_LON).alias("end_lon"),
        _lat(k, P_END_LAT).alias("end_lat"),
        (F.lit(1) + k % 5).cast("smallint").alias("passenger_cnt"),
        (F.col("o_custkey") % 100).alias("taxi_id"),
        (F.col("o_custkey") % 200).alias("driver_id"),
    )
    return with_ride_event_time(df)


def with_ride_event_time(df: DataFrame) -> DataFrame:
    """Event time of a ride event: start time for START, end time for END."""
    return df.withColumn("event_time", F.when(F.col("is_start"), F.col("start_time"))
                         .otherwise(F.col("end_time")))


def fares(spark: SparkSession, sf_dir: str, some_missing: bool = False) -> DataFrame:
    """TaxiFare records: one per order; with ``some_missing``, for the jobs
    about unmatched sides, only orders whose key is not a multiple of 11."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    k = F.col("o_orderkey")
    return (o.where((k % 11 != 0) if some_missing else F.lit(True)).select(
        k.alias("ride_id"),
        (F.col("o_custkey") % 100).alias("taxi_id"),
        (F.col("o_custkey") % 200).alias("driver_id"),
        F.timestamp_millis(_start_ms(k)).alias("start_time"),
        F.when(k % 3 == 0, F.lit("CSH")).otherwise(F.lit("CRD")).alias("payment_type"),
        (((k * 13) % 2000) / F.lit(100.0)).cast("float").alias("tip"),
        F.when(k % 4 == 0, F.lit(5.76)).otherwise(F.lit(0.0)).cast("float").alias("tolls"),
        (F.col("o_totalprice") / F.lit(10000.0)).cast("float").alias("total_fare"),
    ).withColumn("event_time", F.col("start_time")))


def car_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ConnectedCarEvent records from ``events`` (car = user)."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.col("event_id")
    return e.select(
        k.cast("string").alias("id"),
        F.col("user_id").cast("string").alias("car_id"),
        F.col("ts").alias("event_time"),
        _lon(k, P_START_LON).alias("longitude"),
        _lat(k, P_START_LAT).alias("latitude"),
        (F.col("value") / F.lit(10.0)).cast("float").alias("consumption"),
        F.when(F.col("event_type") == "error", F.lit(0.0))
         .otherwise(F.col("value")).cast("float").alias("speed"),
        F.get_json_object("props", "$.k").cast("float").alias("throttle"),
        F.col("value").cast("float").alias("engineload"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return e.select(F.col("ts").alias("trade_time"), F.col("user_id").alias("customer_id"),
                    F.col("event_id").cast("string").alias("trade_info"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    return e.select(F.col("ts").alias("customer_time"), F.col("user_id").alias("customer_id"),
                    F.col("event_id").cast("string").alias("customer_info"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TaxiCall records: every click event is a call for a taxi."""
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    k = F.col("event_id")
    return e.select(
        k.alias("call_id"),
        F.col("user_id"),
        F.unix_millis("ts").alias("timestamp"),
        (F.lit(LON0) + ((k * P_START_LON) % 1000) * F.lit(DLON)).alias("longitude"),
        (F.lit(LAT0) + ((k * P_START_LAT) % 1000) * F.lit(DLAT)).alias("latitude"),
    )


def element_timeline(spark: SparkSession, sf_dir: str, delay_ms: int = 0) -> DataFrame:
    """Scripted-element timeline from ``events``.

    Each event becomes an element ``E`` (key = user, value = 5 for a purchase,
    else 4) followed by a watermark ``W`` at its time minus ``delay_ms``,
    the per-element watermark of a bounded-disorder source.  Columns:
    ``seq, kind, time, key, value`` (times in epoch ms).
    """
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    t = F.unix_millis("ts")
    code = F.when(F.col("event_type") == "purchase", F.lit(5)).otherwise(F.lit(4)).cast("bigint")
    rows = F.array(
        F.struct((F.col("event_id") * 2).alias("seq"), F.lit("E").alias("kind"), t.alias("time"),
                 F.col("user_id").alias("key"), code.alias("value")),
        F.struct((F.col("event_id") * 2 + 1).alias("seq"), F.lit("W").alias("kind"),
                 (t - F.lit(delay_ms)).alias("time"), F.lit(None).cast("bigint").alias("key"),
                 F.lit(None).cast("bigint").alias("value")),
    )
    return e.select(F.inline(rows))
