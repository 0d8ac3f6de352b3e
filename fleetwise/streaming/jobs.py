"""Streaming forms of the jobs built from Structured Streaming's own operators.

The transformation code is the batch code; these wrappers add the event-time
watermark (``withWatermark`` needs a zoned ``timestamp`` column) and, where
the batch plan uses operators streaming lacks, the streaming equivalent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.operators.cleansing import cleanse_rides


def ride_cleansing(rides: DataFrame) -> DataFrame:
    """Stateless filter, any output mode."""
    return cleanse_rides(rides)


def hourly_tips(fares: DataFrame, delay: str = "0 seconds", window: str = "1 hour") -> DataFrame:
    """Top driver per hour over a fare stream (append mode).

    Two chained event-time aggregations: per (window, driver), then per window
    on ``window_time`` of the first.  A window's rows are emitted once the
    watermark passes its end.
    """
    per = (fares.withWatermark("event_time", delay)
           .groupBy(F.window("event_time", window).alias("w"), "driver_id")
           .agg(F.sum(F.col("tip").cast("decimal(12,2)")).alias("sum_tips"))
           .select(F.window_time("w").alias("wt"), "driver_id", "sum_tips"))
    best = F.max_by(F.struct("driver_id", "sum_tips"), F.struct(F.col("sum_tips"), -F.col("driver_id")))
    return (per.groupBy(F.window("wt", window).alias("w")).agg(best.alias("b"))
            .select(F.col("w.end").alias("window_end"), "b.driver_id", "b.sum_tips"))


def expiring_pairs(rides: DataFrame, fares: DataFrame, delay: str = "0 seconds",
                   driver_modulus: int = 1000) -> DataFrame:
    """Stream-stream full outer join of START rides and fares on ride id and
    equal event time.  Rows with a null side are the solo rides / fares; they
    are emitted when the watermark passes their event time (append mode)."""
    r = (rides.where(F.col("is_start") & (F.col("driver_id") % driver_modulus != 0))
         .select(F.col("ride_id").alias("r_ride_id"), F.col("event_time").alias("r_time"),
                 F.col("taxi_id").alias("r_taxi_id"), F.col("driver_id").alias("r_driver_id"))
         .withWatermark("r_time", delay))
    f = (fares.select(F.col("ride_id").alias("f_ride_id"), F.col("event_time").alias("f_time"),
                      F.col("tip").alias("f_tip"), F.col("driver_id").alias("f_driver_id"))
         .withWatermark("f_time", delay))
    j = r.join(f, (F.col("r_ride_id") == F.col("f_ride_id")) & (F.col("r_time") == F.col("f_time")), "full_outer")
    return j.select(F.coalesce("r_ride_id", "f_ride_id").alias("ride_id"),
                    F.when(F.col("r_ride_id").isNull(), F.lit("solo_fare"))
                     .when(F.col("f_ride_id").isNull(), F.lit("solo_ride")).otherwise(F.lit("pair")).alias("kind"),
                    F.coalesce("r_time", "f_time").alias("event_time"), "r_driver_id", "f_driver_id", "f_tip")
