"""Small geographic jobs over ride events: grid heatmap, cell centres,
direction histogram and ride durations.  All are narrow projections followed
by one partially-aggregated group-by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.functions import geo


def event_point(rides: DataFrame) -> DataFrame:
    """Location of a ride event: start point for START, end point for END."""
    return rides.withColumn("lon", F.when(F.col("is_start"), F.col("start_lon")).otherwise(F.col("end_lon"))) \
                .withColumn("lat", F.when(F.col("is_start"), F.col("start_lat")).otherwise(F.col("end_lat")))


def cell_heatmap(rides: DataFrame, window: str = "1 hour") -> DataFrame:
    """Ride events per grid cell and tumbling window (NYC points only)."""
    p = event_point(rides).where(geo.in_nyc("lon", "lat"))
    return (p.groupBy(F.window("event_time", window).alias("w"), geo.cell_id("lon", "lat").alias("cell_id"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(F.col("w.end").alias("window_end"), "cell_id", "n_events"))


def cell_totals_with_centers(rides: DataFrame) -> DataFrame:
    """Total events per cell (NYC points) with the cell's centre coordinates;
    one partially aggregated group-by on the cell."""
    p = event_point(rides).where(geo.in_nyc("lon", "lat"))
    return (p.groupBy(geo.cell_id("lon", "lat").alias("cell_id")).agg(F.count(F.lit(1)).alias("n_events"))
            .withColumn("center_lon", geo.cell_center_lon("cell_id"))
            .withColumn("center_lat", geo.cell_center_lat("cell_id")))


def direction_histogram(rides: DataFrame) -> DataFrame:
    """START rides inside NYC per direction bucket: count, angle range, total km."""
    s = rides.where(F.col("is_start") & geo.in_nyc("start_lon", "start_lat") & geo.in_nyc("end_lon", "end_lat"))
    s = s.select(geo.direction_angle("start_lon", "start_lat", "end_lon", "end_lat").alias("angle"),
                 geo.euclidean_distance("start_lon", "start_lat", "end_lon", "end_lat").alias("km"))
    return (s.groupBy(geo.direction_bucket("angle").alias("direction_bucket"))
            .agg(F.count(F.lit(1)).alias("n_rides"), F.min("angle").alias("min_angle"),
                 F.max("angle").alias("max_angle"), F.sum("km").alias("total_km")))


def ride_durations(rides: DataFrame) -> DataFrame:
    """Completed rides (END events) per driver: count and duration statistics in ms."""
    e = rides.where(~F.col("is_start")).select("driver_id", geo.time_diff_ms("start_time", "end_time").alias("dur"))
    return e.groupBy("driver_id").agg(F.count(F.lit(1)).alias("n_rides"), F.sum("dur").alias("total_ms"),
                                      F.min("dur").alias("min_ms"), F.max("dur").alias("max_ms"))
