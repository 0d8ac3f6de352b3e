"""Drive segments of connected cars.

* Gap segments: a car's events split where more than ``gap`` passes without
  data (an exactly-``gap`` pause stays in the segment); sessions from the
  skew-safe scans, statistics per (car, session).
* Stopped segments: the events of a car between two stops (speed 0), closed
  by the later stop.  Each event looks up the last stop at or before it and
  the next stop after it with the skew-safe scan; events that share their
  time with a stop, and the open segment after the last stop, are left out.

Statistics per segment: number of events, first time, maximum speed truncated
to an integer, population standard deviation of the throttle
("erraticness") and its label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwise.functions.geo import java_int
from fleetwise.operators.scan import carry_last, sessionize


# Fixed label rule: int(erraticness / 2.5) -> 0 "calm", 1 "busy", otherwise "crazy".
LABEL_STEP = 2.5
LABELS = ("calm", "busy", "crazy")


def erraticness_label(erraticness: Column) -> Column:
    q = java_int(erraticness.cast("float") / F.lit(LABEL_STEP))
    return F.when(q == 0, F.lit(LABELS[0])).when(q == 1, F.lit(LABELS[1])).otherwise(F.lit(LABELS[2]))


def _stats():
    return [F.min("event_time").alias("start_time"), F.count(F.lit(1)).alias("length"),
            java_int(F.max("speed")).alias("max_speed"),
            F.stddev_pop(F.col("throttle").cast("double")).alias("erraticness")]


_UNIT_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000}


def _duration_us(gap) -> int:
    """'15 seconds' / '6 hours' / milliseconds as a number -> microseconds."""
    if isinstance(gap, (int, float)):
        return int(gap * 1000)
    n, unit = gap.split()
    return int(float(n) * _UNIT_US[unit.rstrip("s")])


def gap_segments(cars: DataFrame, gap="15 seconds") -> DataFrame:
    """Segments split where more than ``gap`` passes without an event.

    Sessions come from the skew-safe scans (a car with most of the events is
    split over buckets); the statistics are then a partially aggregated
    group-by on (car, session), which spreads even one car's sessions."""
    s = sessionize(cars, ["car_id"], F.unix_micros("event_time"), [F.col("id")], _duration_us(gap))
    g = s.groupBy("car_id", "sid").agg(*_stats()).drop("sid")
    return g.withColumn("description", erraticness_label(F.col("erraticness")))


def stopped_segments(cars: DataFrame, bucket_us: int | None = None) -> DataFrame:
    t = F.unix_micros("event_time")
    stop = F.col("speed") == 0
    c = cars.withColumn("_t", t).withColumn("_stop", stop.cast("int"))
    stop_t = F.when(F.col("_stop") == 1, F.col("_t"))
    # last stop at or before each event (stops sort first on equal times)
    c = carry_last(c, ["car_id"], [F.col("_t"), -F.col("_stop")], stop_t, "_prev_stop",
                   F.floor(F.col("_t") / F.lit(bucket_us)) if bucket_us else None)
    # next stop at or after each event, scanning the timeline backwards
    c = carry_last(c, ["car_id"], [-F.col("_t"), -F.col("_stop")], stop_t, "_next_stop",
                   F.floor(-F.col("_t") / F.lit(bucket_us)) if bucket_us else None)
    kept = c.where((F.col("_stop") == 0) & F.col("_next_stop").isNotNull()
                   & (F.col("_prev_stop").isNull() | (F.col("_prev_stop") != F.col("_t"))))
    g = kept.groupBy("car_id", "_prev_stop").agg(*_stats(), F.first("_next_stop").alias("_ns"))
    return (g.withColumn("stop_time", F.timestamp_micros("_ns")).drop("_prev_stop", "_ns")
            .withColumn("description", erraticness_label(F.col("erraticness"))))
