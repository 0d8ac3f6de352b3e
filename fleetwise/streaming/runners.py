"""``foreachBatch`` runners: keyed state tables updated per micro-batch and
queried by the control messages of the same batch.

The state table (latest END position per taxi) is written as one parquet
version per batch id under the shared checkpoint folder; re-running a batch id
after a failure overwrites the same version, so output and state stay
exactly-once together with the query's own offset log.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwise.operators.nearest import nearest_taxi
from fleetwise.operators.ongoing import ONGOING_COLS, ongoing_for_requests
from fleetwise.operators.rules import evaluate_rules
from fleetwise.operators.status import latest_per_key, ride_status
from fleetwise.operators.toggle import apply_controls
from fleetwise.session import checkpoint_dir
from fleetwise.sources.control import parse_requests, parse_rules

POS_SCHEMA = "taxi_id bigint, timestamp bigint, longitude float, latitude float"


class VersionedTable:
    """A keyed state table stored as one parquet version per batch id.

    The versions are the folders ``batch=<id>`` that a writer finished.  Only
    the newest one before the running batch is read, and older ones are
    deleted once the next is written.  A version that cannot be read fails the
    batch: it never counts as an empty state.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, batch_id: int) -> str:
        return posixpath.join(self.path, f"batch={batch_id}")

    def versions(self) -> list[int]:
        """Batch ids with a finished version, ascending."""
        if not self._fs.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._folder)]
        ids = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(i for i in ids if self._fs.exists(done(posixpath.join(self._at(i), "_SUCCESS"))))

    def previous(self, batch_id: int) -> DataFrame:
        before = [i for i in self.versions() if i < batch_id]
        if not before:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._at(before[-1]))

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._at(batch_id))
        before = [i for i in self.versions() if i < batch_id]
        for old in before[:-1]:  # the one before stays, in case this batch is run again
            self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self._at(old)), True)
        return self.spark.read.schema(self.schema).parquet(self._at(batch_id))


def _ride_rows(batch: DataFrame) -> DataFrame:
    return batch.where(F.col("kind") == "ride").select(
        "ride_id", "is_start", "start_time", "end_time", "start_lon", "start_lat", "end_lon", "end_lat",
        "passenger_cnt", "taxi_id", "driver_id", "event_time")


class OngoingRidesRunner:
    """Open-ride state per ride id, and ``{"during": minutes}`` requests.

    Input: a tagged stream of ride events (``kind='ride'``, ride columns) and
    requests (``kind='request'``, JSON text in ``value``).  A START opens a
    ride and its END closes it; events are ordered by event time (START first
    on ties), so an END that arrives before its START still closes the ride,
    as in the batch form.  For that, an END stays in the state until the
    ride-side watermark is ``hold_ms`` past it.  Each request is answered
    against the state after the batch, at the ride-side watermark (latest ride
    event time - 1 ms): rides open since at least ``during`` minutes.
    """

    STATE = ("ride_id bigint, is_start boolean, start_time timestamp, end_time timestamp, start_lon float, "
             "start_lat float, end_lon float, end_lat float, passenger_cnt smallint, taxi_id bigint, "
             "driver_id bigint, event_time timestamp")

    def __init__(self, spark: SparkSession, out_path: str, state_path: str | None = None, hold_ms: int = 24 * 3_600_000):
        self.spark = spark
        self.out_path = out_path
        self.hold_ms = hold_ms
        base = state_path or posixpath.join(checkpoint_dir(spark), "open_rides")
        self.table = VersionedTable(spark, posixpath.join(base, "state"), self.STATE)
        self.marks = VersionedTable(spark, posixpath.join(base, "watermark"), "wm bigint")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rides = _ride_rows(batch)
        last = latest_per_key(self.table.previous(batch_id).unionByName(rides), "ride_id",
                              [F.col("event_time"), ~F.col("is_start")])
        wm = self.marks.previous(batch_id).unionByName(
            rides.select((F.unix_millis(F.max("event_time")) - 1).alias("wm")).where(F.col("wm").isNotNull()))
        wm = self.marks.write(wm.agg(F.max("wm").alias("wm")).where(F.col("wm").isNotNull()), batch_id).first()
        passed = F.lit(False) if wm is None else F.unix_millis("event_time") < F.lit(wm["wm"] - self.hold_ms)
        state = self.table.write(last.where(F.col("is_start") | ~passed), batch_id).where(F.col("is_start"))
        reqs = parse_requests(batch.where(F.col("kind") == "request").select("value"))
        if wm is None or reqs.isEmpty():
            return
        ans = ongoing_for_requests(state.select(*ONGOING_COLS), reqs, wm["wm"])
        ans.write.mode("overwrite").parquet(posixpath.join(self.out_path, f"batch={batch_id}"))


class RulesRunner:
    """Latest ride event per taxi, and ``{"condition": "..."}`` rule messages.

    Each batch merges its ride events into the per-taxi state, then evaluates
    the batch's rules against it with the ride-side watermark; matches go to
    ``out_path/matches/batch=<id>``, refused rules to ``out_path/rejects/batch=<id>``.
    """

    def __init__(self, spark: SparkSession, out_path: str, state_path: str | None = None):
        self.spark = spark
        self.out_path = out_path
        base = state_path or posixpath.join(checkpoint_dir(spark), "latest_rides")
        self.table = VersionedTable(spark, posixpath.join(base, "state"), OngoingRidesRunner.STATE)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rides = _ride_rows(batch)
        last = latest_per_key(self.table.previous(batch_id).unionByName(rides), "taxi_id",
                              [F.col("event_time"), ~F.col("is_start"), F.col("ride_id")])
        state = self.table.write(last, batch_id)
        rules = parse_rules(batch.where(F.col("kind") == "rule").select("value"))
        if rules.isEmpty():
            return
        newest = state.agg(F.max(F.unix_millis("event_time"))).first()[0]
        if newest is None:  # no ride yet: nothing to match, and a rule is not kept
            return
        wm = newest - 1
        numbered = rules.select(F.monotonically_increasing_id().alias("rule_id"), "condition")
        matches, rejects = evaluate_rules(ride_status(state), numbered, wm)
        matches.write.mode("overwrite").parquet(posixpath.join(self.out_path, "matches", f"batch={batch_id}"))
        rejects.write.mode("overwrite").parquet(posixpath.join(self.out_path, "rejects", f"batch={batch_id}"))


class ToggleRunner:
    """Keyed toggle flags and control elements.

    Input: a tagged stream of keyed elements (``kind='element'``, columns
    ``key, time``) and controls (``kind='control'``, columns ``time, value``).
    The state is the number of elements per key, modulo 2.  Each batch applies
    its controls to the flags as of their time, flags set in earlier batches
    standing before all elements of the batch, and writes (control_time,
    control_value, key) to ``out_path/batch=<id>``.
    """

    def __init__(self, spark: SparkSession, out_path: str, state_path: str | None = None):
        self.out_path = out_path
        self.table = VersionedTable(spark, state_path or posixpath.join(checkpoint_dir(spark), "toggles"), "key bigint, odd bigint")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.table.previous(batch_id)
        elements = batch.where(F.col("kind") == "element").select("key", "time")
        controls = batch.where(F.col("kind") == "control").select("time", "value")
        counts = before.unionByName(elements.select("key", F.lit(1).cast("bigint").alias("odd")))
        self.table.write(counts.groupBy("key").agg((F.sum("odd") % 2).alias("odd")).where("odd = 1"), batch_id)
        set_before = before.select("key", F.timestamp_micros(F.lit(0)).alias("time"))
        answers = apply_controls(set_before.unionByName(elements), controls)
        answers.write.mode("overwrite").parquet(posixpath.join(self.out_path, f"batch={batch_id}"))


class NearestTaxiRunner:
    """Tagged input stream: ride events (``kind='ride'``) and calls
    (``kind='call'``).  Per batch: merge END rides into the position table,
    drop positions older than ``max_age_ms`` before the batch's newest event,
    answer the batch's calls against the table, append answers under
    ``out_path/batch=<id>``."""

    def __init__(self, spark: SparkSession, out_path: str, state_path: str | None = None,
                 max_age_ms: int | None = 3_600_000):
        self.spark = spark
        self.out_path = out_path
        self.table = VersionedTable(spark, state_path or posixpath.join(checkpoint_dir(spark), "taxi_positions"),
                                    POS_SCHEMA)
        self.max_age_ms = max_age_ms

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rides = batch.where((F.col("kind") == "ride") & ~F.col("is_start"))
        new_pos = rides.select("taxi_id", F.unix_millis("end_time").alias("timestamp"),
                               F.col("end_lon").alias("longitude"), F.col("end_lat").alias("latitude"))
        merged = latest_per_key(self.table.previous(batch_id).unionByName(new_pos), "taxi_id",
                                [F.col("timestamp"), F.col("longitude"), F.col("latitude")])
        if self.max_age_ms is not None:
            newest = merged.agg(F.max("timestamp")).first()[0]
            if newest is not None:
                merged = merged.where(F.col("timestamp") >= F.lit(newest - self.max_age_ms))
        pos = self.table.write(merged, batch_id)
        calls = batch.where(F.col("kind") == "call").select("call_id", "user_id", F.col("call_ms").alias("timestamp"),
                                                            "longitude", "latitude")
        if calls.isEmpty():
            return
        ans = nearest_taxi(calls, pos)
        ans.write.mode("overwrite").parquet(posixpath.join(self.out_path, f"batch={batch_id}"))
