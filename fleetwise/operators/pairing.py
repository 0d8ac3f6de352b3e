"""Ride-fare pairing (inner, one-to-one) and pairing with expiry (unmatched
rides and fares reported separately).

Identity of a ride and a fare is the ride id.  Each side is first reduced to
one row per ride id (the latest by event time: a newer unmatched row
overwrites an older one); that aggregation hash-partitions both sides on
``ride_id``, and the join reuses that partitioning, so each side crosses the
network once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.operators.status import latest_per_key

RIDE_PAIR_COLS = ["ride_id", "is_start", "start_time", "end_time", "start_lon", "start_lat", "end_lon", "end_lat",
                  "passenger_cnt", "taxi_id", "driver_id", "event_time"]
FARE_PAIR_COLS = ["ride_id", "taxi_id", "driver_id", "start_time", "payment_type", "tip", "tolls", "total_fare",
                  "event_time"]


def _one_per_ride(df: DataFrame, cols: list[str]) -> DataFrame:
    # latest by event time; the whole row breaks ties so the pick is deterministic
    rest = [c for c in cols if c not in ("ride_id", "event_time")]
    return latest_per_key(df.select(*cols), "ride_id", [F.col("event_time"), F.struct(*rest)])


def _prefixed(df: DataFrame, prefix: str, keep: str = "ride_id") -> DataFrame:
    return df.select(*[F.col(c).alias(c if c == keep else prefix + c) for c in df.columns])


def pair_rides_fares(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """START rides joined with their fare; columns ``ride_*`` and ``fare_*``."""
    r = _prefixed(_one_per_ride(rides.where(F.col("is_start")), RIDE_PAIR_COLS), "ride_")
    f = _prefixed(_one_per_ride(fares, FARE_PAIR_COLS), "fare_")
    return r.join(f, "ride_id", "inner")


def expiring_pairs(rides: DataFrame, fares: DataFrame, driver_modulus: int = 1000,
                   tolerance_ms: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(paired, solo_rides, solo_fares).

    Rides are START events whose driver id is not a multiple of
    ``driver_modulus`` (the filter drops some rides on purpose, leaving their
    fares unmatched).  A ride and a fare pair when ride ids are equal and their
    event times differ by at most ``tolerance_ms`` (default: equal times, the
    case in which the expiry timers of both sides agree); anything else
    expires unmatched.  One full outer join produces all three outputs.
    """
    r = rides.where(F.col("is_start") & (F.col("driver_id") % driver_modulus != 0))
    r = _prefixed(_one_per_ride(r, RIDE_PAIR_COLS), "ride_")
    f = _prefixed(_one_per_ride(fares, FARE_PAIR_COLS), "fare_")
    dt = F.abs(F.unix_millis(r["ride_event_time"]) - F.unix_millis(f["fare_event_time"]))
    j = r.join(f.withColumnRenamed("ride_id", "fare_ride_id"),
               (r["ride_id"] == F.col("fare_ride_id")) & (dt <= F.lit(tolerance_ms)), "full_outer")
    paired = j.where(F.col("ride_id").isNotNull() & F.col("fare_ride_id").isNotNull()).drop("fare_ride_id")
    solo_rides = j.where(F.col("fare_ride_id").isNull()).select(*[c for c in r.columns])
    solo_fares = j.where(F.col("ride_id").isNull()).select(
        F.col("fare_ride_id").alias("ride_id"), *[c for c in f.columns if c != "ride_id"])
    return paired, solo_rides, solo_fares
