"""Travel-time model: per direction bucket (8 x 45 degrees) a least-squares
line through the origin, travel minutes = slope * distance.

Training is one group-by with partial aggregation of the sums; the model has
at most 8 rows, so scoring joins it by broadcast (its size is bounded by the
bucket count, not by the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.functions import geo
from fleetwise.operators.scan import running_aggs

# A slope needs at least 2 points and a sum of squares above 10 * the smallest
# positive double; otherwise there is no prediction (-1).
MIN_POINTS = 2
MIN_SXX = 10 * 4.9e-324


def ride_features(rides: DataFrame) -> DataFrame:
    """direction, bucket and distance from start to end, and travel minutes."""
    return rides.select(
        "*",
        geo.direction_angle("start_lon", "start_lat", "end_lon", "end_lat").alias("direction"),
        geo.euclidean_distance("start_lon", "start_lat", "end_lon", "end_lat").alias("distance"),
        ((F.unix_millis("end_time") - F.unix_millis("start_time")) / F.lit(60000.0)).alias("travel_min"),
    ).withColumn("bucket", geo.direction_bucket("direction"))


def train(rides: DataFrame) -> DataFrame:
    """Completed rides (END events) inside NYC -> (bucket, n, sxx, sxy, slope)."""
    f = ride_features(rides.where(~F.col("is_start") & geo.in_nyc("start_lon", "start_lat")
                                  & geo.in_nyc("end_lon", "end_lat")))
    m = f.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                F.sum(F.col("distance") * F.col("distance")).alias("sxx"),
                                F.sum(F.col("distance") * F.col("travel_min")).alias("sxy"))
    ok = (F.col("n") >= MIN_POINTS) & (F.abs("sxx") >= F.lit(MIN_SXX))
    return m.withColumn("slope", F.when(ok, F.col("sxy") / F.col("sxx")))


def predict(rides: DataFrame, model: DataFrame) -> DataFrame:
    """START rides inside NYC with the predicted travel minutes (-1: none)."""
    f = ride_features(rides.where(F.col("is_start") & geo.in_nyc("start_lon", "start_lat")
                                  & geo.in_nyc("end_lon", "end_lat")))
    j = f.join(F.broadcast(model.select("bucket", "slope")), "bucket", "left")
    pred = F.when(F.col("slope").isNull(), F.lit(-1)).otherwise(geo.java_int(F.col("slope") * F.col("distance")))
    return j.withColumn("predicted_min", pred)


def predict_as_of(rides: DataFrame) -> DataFrame:
    """START rides inside NYC with the travel minutes the model would have predicted at their time: the regression of
    their bucket over the rides that had ended by then (an END at the same time counts).  ``n`` is their number.

    Running sums from the skew-safe scan, so a bucket with most of the rides is spread over ranges of time."""
    f = ride_features(rides.where(geo.in_nyc("start_lon", "start_lat") & geo.in_nyc("end_lon", "end_lat"))).where(~F.isnan("distance"))
    f = f.withColumn("_ms", F.unix_millis("event_time"))
    x, y, ended = F.col("distance"), F.col("travel_min"), ~F.col("is_start")
    f = running_aggs(f, ["bucket"], [F.col("_ms"), F.col("is_start"), F.col("ride_id")],
                     [(F.when(ended, F.lit(1)), "n", "count"), (F.when(ended, x * x), "sxx", "sum"), (F.when(ended, x * y), "sxy", "sum")])
    ok = (F.col("n") >= MIN_POINTS) & (F.abs("sxx") >= F.lit(MIN_SXX))
    slope = F.when(ok, F.col("sxy") / F.when(ok, F.col("sxx")))
    pred = F.when(slope.isNull(), F.lit(-1)).otherwise(geo.java_int(slope * x))
    return f.where("is_start").withColumn("predicted_min", pred).drop("_ms", "sxx", "sxy")
