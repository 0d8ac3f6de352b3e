"""Open rides and ongoing-ride requests.

State of a ride: a START opens it, an END of the same ride closes it.  As of
time ``at`` a ride is open when its START happened at or before ``at`` and no
END of it happened at or before ``at`` (an END that arrives before its START
also closes the ride here).  One scan and one partially aggregated group-by
on ``ride_id``: each task keeps at most one START candidate and one "closed"
flag per ride before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.operators.asof import asof_numeric
from fleetwise.operators.scan import running_agg
from fleetwise.session import stored

BROADCAST_REQUESTS = 64  # above this many requests the join avoids the rides x requests comparison
ONGOING_COLS = ["ride_id", "taxi_id", "driver_id", "start_time", "start_lon", "start_lat", "passenger_cnt"]


def open_rides(rides: DataFrame, at_ms: int) -> DataFrame:
    """Ride summaries (id, taxi, driver, start time/point, passengers) open at ``at_ms``."""
    at = F.timestamp_millis(F.lit(at_ms))
    r = rides.where(F.col("event_time") <= at)
    g = r.groupBy("ride_id").agg(
        F.max_by(F.struct(*ONGOING_COLS),
                 F.when(F.col("is_start"), F.struct("event_time", *ONGOING_COLS))).alias("s"),
        F.max(F.when(~F.col("is_start"), F.lit(1))).alias("closed"))
    return g.where(F.col("s").isNotNull() & F.col("closed").isNull()).select("s.*")


def ongoing_for_requests(open_: DataFrame, requests: DataFrame, at_ms: int,
                         broadcast_limit: int = BROADCAST_REQUESTS) -> DataFrame:
    """For every request ``during`` (minutes), the rides open for at least that
    long at ``at_ms``: ``start <= at - during``.  Output: ``at``, ``during``
    (ms) and the ride summary.

    Requests are control messages, usually a handful.  Up to
    ``broadcast_limit`` of them (counted first) are broadcast and every open
    ride is tested against each.  Beyond that the cost would grow with rides x
    requests, so requests are numbered by duration and each ride finds, with a
    global as-of scan on its age, the longest request it satisfies; the
    requests it satisfies are exactly those numbered up to that one, exploded
    into output rows and equi-joined to the request table.
    """
    start_ms = F.unix_millis(F.col("start_time"))
    # a null duration asks for nothing
    req = requests.where(F.col("during").isNotNull()).select((F.col("during") * F.lit(60000)).alias("during_ms"))
    n = req.count()
    if n <= broadcast_limit:
        j = open_.join(F.broadcast(req), start_ms <= F.lit(at_ms) - F.col("during_ms"), "inner")
        return j.select(F.lit(at_ms).alias("at_ms"), "during_ms", *open_.columns)
    numbered = stored(running_agg(req, [], [F.col("during_ms")], F.lit(1), "_j", fn="count").withColumn("_j", F.col("_j") - 1), "requests")
    rides = open_.withColumn("_age", F.lit(at_ms) - start_ms)
    m = asof_numeric(rides, numbered.select("during_ms", "_j"), [], "_age", "during_ms", ["_j"])
    rows = m.where(F.col("_j").isNotNull()).select(*open_.columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_j"))).alias("_j"))
    return rows.join(numbered, "_j").select(F.lit(at_ms).alias("at_ms"), "during_ms", *open_.columns)
