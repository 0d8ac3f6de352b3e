"""Hourly tips: the driver with the largest tip sum in each hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tips_per_driver_hour(fares: DataFrame, window: str = "1 hour") -> DataFrame:
    """Sum of tips per driver and tumbling event-time window.

    Tips are single-precision amounts in cents; summing them as
    ``decimal(12,2)`` makes the result exact and independent of the order in
    which partial sums meet.  The aggregation is partial on the map side, so
    only one row per (window, driver) and input partition crosses the shuffle.
    """
    return (fares.select("event_time", "driver_id", F.col("tip").cast("decimal(12,2)").alias("tip"))
            .groupBy(F.window("event_time", window).alias("w"), "driver_id")
            .agg(F.sum("tip").alias("sum_tips"))
            .select(F.col("w.end").alias("window_end"), "driver_id", "sum_tips"))


def top_driver_per_window(per_driver: DataFrame) -> DataFrame:
    """Row with the largest sum per window end; ties go to the lowest driver id.

    ``max_by`` is a partial aggregate: each task keeps one candidate per
    window before the shuffle, so a window holding most rows is not a hot spot.
    """
    best = F.max_by(F.struct("driver_id", "sum_tips"),
                    F.struct(F.col("sum_tips"), -F.col("driver_id")))
    return (per_driver.groupBy("window_end").agg(best.alias("b"))
            .select("window_end", F.col("b.driver_id").alias("driver_id"),
                    F.col("b.sum_tips").alias("sum_tips")))


def hourly_tips(fares: DataFrame, window: str = "1 hour") -> DataFrame:
    return top_driver_per_window(tips_per_driver_hour(fares, window))
