"""Streams in event-time order: equal to the batch jobs, however the rows are dealt to micro-batches."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from fleetwise.operators import ongoing, segments, toggle, travel_time
from fleetwise.sources import adapters as A
from fleetwise.streaming import processors, timeline as T

FAR_MS = 4_000_000_000_000


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", processors.ROCKSDB)


def batches(spark, df, n, seed, slack_ms=0):
    """A source of ``n`` micro-batches of ``df`` by event time, out of order by up to ``slack_ms``."""
    rows = df.collect()
    rnd = random.Random(seed)
    rows.sort(key=lambda r: r.event_time.timestamp() * 1000 + rnd.uniform(0, slack_ms))
    path, size = tempfile.mkdtemp(prefix="timeline-"), -(-len(rows) // n)
    for i in range(0, len(rows), size):
        part = rows[i:i + size]
        rnd.shuffle(part)
        spark.createDataFrame(part, df.schema).coalesce(1).write.parquet(f"{path}/f{i:07d}")
    return path


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def run(spark, df, name, checkpoint=None):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint or tempfile.mkdtemp(prefix="ckpt-" + name)).trigger(availableNow=True).start())
    q.awaitTermination(600)
    return spark.table(name)


def far(df, **values):
    """One row far in the future, which lets every timer fire."""
    row = df.limit(1).withColumn("event_time", F.timestamp_millis(F.lit(FAR_MS)))
    for k, v in values.items():
        row = row.withColumn(k, F.lit(v).cast(df.schema[k].dataType))
    return row.select(*df.columns)


def test_toggles_of_shuffled_batches_equal_batch(spark):
    e = A.car_events(spark, SF_DIR).select(F.col("car_id").cast("bigint").alias("key"), "event_time", F.lit(None).cast("bigint").alias("value"))
    low, high = e.agg(F.min(F.unix_millis("event_time")), F.max(F.unix_millis("event_time"))).first()
    times = [low + (high - low) * i // 12 for i in range(1, 12)]
    c = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "value bigint, ms bigint").select(
        F.lit(None).cast("bigint").alias("key"), F.timestamp_millis("ms").alias("event_time"), "value")
    every = e.unionByName(c)
    slack = (high - low) // 10
    src = batches(spark, every.unionByName(far(every, key=-1)), 5, 1, slack)
    s = stream(spark, src, every.schema)
    got = run(spark, T.toggles(s.where("value is null"), s.where("value is not null"), delay=f"{slack + 1} milliseconds", groups=3,
                               bucket_ms=max(1000, slack // 7)), "toggles_t")
    want = toggle.apply_controls(e.withColumnRenamed("event_time", "time"), c.select(F.col("event_time").alias("time"), "value"))
    a = sorted((r.control_ms, r.control_value, r.key) for r in got.collect())
    b = sorted((r.ms, r.control_value, r.key) for r in want.select(F.unix_millis("control_time").alias("ms"), "control_value", "key").collect())
    assert a == b and len(a) > 50


def test_asof_on_a_key_with_many_rows(spark):
    n = 10_000
    rnd = random.Random(4)
    rows = [(rnd.choice(["trade", "customer"]), 7 if i % 10 else 1 + i % 3, 1_600_000_000_000 + i * 37 % 500_000, f"i{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "side string, customer_id bigint, ms bigint, info string").withColumn("event_time", F.timestamp_millis("ms"))
    src = batches(spark, df.unionByName(far(df, side="trade", customer_id=-1)).unionByName(far(df, side="customer", customer_id=-1)), 4, 2, 20_000)
    s = stream(spark, src, df.schema)
    t = lambda d: d.where("side = 'trade'").select(F.col("event_time").alias("trade_time"), "customer_id", F.col("info").alias("trade_info"))
    c = lambda d: d.where("side = 'customer'").select(F.col("event_time").alias("customer_time"), "customer_id", F.col("info").alias("customer_info"))
    got = run(spark, T.enrich_trades(t(s), c(s), delay="30 seconds"), "asof_t").where("customer_id > 0")
    want = {}
    past = {}
    for side, key, ms, info in sorted(rows, key=lambda r: (r[2], r[0] == "trade", r[3])):
        if side == "customer":
            past[key] = (ms, info)
        else:
            want[info] = past.get(key, (None, None))
    assert {r.trade_info: (r.customer_ms, r.customer_info) for r in got.collect()} == want and len(want) > 4000


def test_stopped_segments_equal_batch(spark):
    cars = A.car_events(spark, SF_DIR)
    low, high = cars.agg(F.min(F.unix_millis("event_time")), F.max(F.unix_millis("event_time"))).first()
    slack = (high - low) // 8
    src = batches(spark, cars.unionByName(far(cars, car_id="-1")), 4, 3, slack)
    got = run(spark, T.stopped_segments(stream(spark, src, cars.schema), f"{slack + 1} milliseconds", bucket_ms=slack), "stopped_t")
    key = lambda r: (r.car_id, r.start_ms, r.length, r.max_speed, round(r.erraticness, 6), r.description, r.stop_ms)
    want = segments.stopped_segments(cars).withColumn("start_ms", F.unix_millis("start_time")).withColumn("stop_ms", F.unix_millis("stop_time"))
    a, b = sorted(map(key, got.collect())), sorted(map(key, want.collect()))
    assert a == b and len(a) > 20


def test_travel_times_equal_running_sums(spark):
    rides = A.rides(spark, SF_DIR)
    # the watermark counts only rides inside NYC
    inside = far(rides, ride_id=-1, start_lon=-73.9, start_lat=40.7, end_lon=-73.8, end_lat=40.8)
    src = batches(spark, rides.unionByName(inside), 4, 5, 3_600_000)
    got = run(spark, T.travel_times(stream(spark, src, rides.schema), "2 hours"), "travel_t").where("ride_id > 0")
    f = travel_time.ride_features(rides.where(travel_time.geo.in_nyc("start_lon", "start_lat") & travel_time.geo.in_nyc("end_lon", "end_lat")))
    rows = f.select("bucket", F.unix_millis("event_time").alias("ms"), "is_start", "ride_id", "distance", "travel_min").collect()
    sums, want = {}, {}
    for r in sorted(rows, key=lambda r: (r.ms, r.is_start, r.ride_id)):
        n, xx, xy = sums.get(r.bucket, (0, 0.0, 0.0))
        if r.is_start:
            want[r.ride_id] = (r.bucket, n, int(xy / xx * r.distance) if n >= 2 else -1)
        else:
            sums[r.bucket] = (n + 1, xx + r.distance ** 2, xy + r.distance * r.travel_min)
    assert {r.ride_id: (r.bucket, r.n, r.predicted_min) for r in got.collect()} == want and len(want) > 200


def _ongoing_input(spark, rides, requests_after, n, seed, slack):
    """Ride batches with request rows (during set, no event time) put after some of them."""
    tagged = rides.withColumn("during", F.lit(None).cast("bigint"))
    path = batches(spark, tagged, n, seed, slack)
    for after, during in requests_after:
        spark.createDataFrame([(during,)], "during bigint").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in rides.schema.fields], "during").coalesce(1).write.parquet(f"{path}/f{after:07d}q{during}")
    return path, tagged.schema


def test_ongoing_rides_equal_batch_over_batches_and_a_restart(spark):
    base = 1_600_000_000_000
    rnd = random.Random(8)
    rows = []
    for i in range(120):
        start = base + rnd.randrange(0, 5_000_000)
        end = start + rnd.randrange(0, 2_000_000)
        if i % 10 == 3:  # timed before its START: it closes all the same
            end = start - rnd.randrange(1, 300_000)
        rows.append((i, True, start, end, start))
        if i % 4:
            rows.append((i, False, start, end, end))
    df = spark.createDataFrame(rows, "ride_id bigint, is_start boolean, s bigint, e bigint, ms bigint").select(
        "ride_id", "is_start", F.timestamp_millis("s").alias("start_time"), F.timestamp_millis("e").alias("end_time"),
        F.lit(-74.0).cast("float").alias("start_lon"), F.lit(40.7).cast("float").alias("start_lat"), F.lit(1).cast("smallint").alias("passenger_cnt"),
        (F.col("ride_id") % 7).alias("taxi_id"), (F.col("ride_id") % 5).alias("driver_id"), F.timestamp_millis("ms").alias("event_time"))
    path, schema = _ongoing_input(spark, df, [(60, 5), (110, 0), (110, 20)], 6, 9, 400_000)
    s = stream(spark, path, schema)
    plan = lambda: T.ongoing_rides(s.where("during is null").drop("during"), s.where("during is not null").select("during"),
                                   delay="500 seconds", groups=3, bucket_ms=50_000)
    ckpt = tempfile.mkdtemp(prefix="ckpt-ongoing")
    first = run(spark, plan(), "ongoing_a", ckpt).collect()
    # a restart from the checkpoint, with more rides and requests; the first run's state must still hold
    more = [(1000, True, base + 9_000_000, base + 9_100_000, base + 9_000_000)]
    extra = spark.createDataFrame(more, "ride_id bigint, is_start boolean, s bigint, e bigint, ms bigint").select(
        "ride_id", "is_start", F.timestamp_millis("s").alias("start_time"), F.timestamp_millis("e").alias("end_time"),
        F.lit(-74.0).cast("float").alias("start_lon"), F.lit(40.7).cast("float").alias("start_lat"), F.lit(1).cast("smallint").alias("passenger_cnt"),
        F.lit(1).cast("bigint").alias("taxi_id"), F.lit(1).cast("bigint").alias("driver_id"), F.timestamp_millis("ms").alias("event_time"))
    extra.withColumn("during", F.lit(None).cast("bigint")).coalesce(1).write.parquet(f"{path}/g0")
    spark.createDataFrame([(30,)], "during bigint").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields], "during") \
        .coalesce(1).write.parquet(f"{path}/g1")
    q = (plan().writeStream.foreachBatch(lambda b, i: b.write.mode("append").parquet(f"{ckpt}-out")).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(600)
    second = spark.read.parquet(f"{ckpt}-out").collect()
    answers = {}
    for r in first + second:
        answers.setdefault((r.at_ms, r.during_ms), set()).add(r.ride_id)
    assert {d for _, d in answers} == {0, 300_000, 1_200_000, 1_800_000}
    for (at, during), got in answers.items():
        open_ = ongoing.open_rides(df.unionByName(extra), at)
        assert got == {r.ride_id for r in open_.collect() if r.start_time.timestamp() * 1000 <= at - during + 0.5}


def test_early_session_elements_tell_the_firings(spark):
    """Random sessions with merges and finish codes: the lists put together from the elements' first firings are those
    of the list form, over the same micro-batches, and every element comes once."""
    base, gap = 1_600_000_000_000, 5_000
    rnd = random.Random(12)
    files, seq, t = [], 0, base
    for _ in range(10):
        part = []
        for _ in range(12):
            t += rnd.choice([300, 900, 2_000, 7_000])
            part.append((seq, t - rnd.choice([0, 0, 1_500, 4_000]), rnd.randrange(3), rnd.choice([1, 2, 4, 5])))
            seq += 1
        files.append(part)
    files.append([(seq, FAR_MS, 9, 1)])
    path = tempfile.mkdtemp(prefix="elements-")
    for i, part in enumerate(files):
        spark.createDataFrame(part, "seq bigint, time bigint, key bigint, value bigint").withColumn("event_time", F.timestamp_millis("time")) \
            .coalesce(1).write.parquet(f"{path}/f{i:03d}")
    schema = "seq bigint, time bigint, key bigint, value bigint, event_time timestamp"
    lists = run(spark, processors.early_session_stream(stream(spark, path, schema), gap, delay="6 seconds"), "lists_t").where("key < 9").collect()
    got = run(spark, processors.early_session_elements_stream(stream(spark, path, schema), gap, delay="6 seconds"), "elements_t").where("key < 9").collect()
    assert sorted(r.arrival for r in got) == list(range(seq))
    firings = {}
    for r in got:
        firings.setdefault((r.key, r.fired_at, r.n, r.window_end, r.is_final), []).append(r)
    # the list of a firing: its new elements and those of the session's earlier firings
    built = []
    for (key, fired_at, n, end, final), new in firings.items():
        covered = [r for r in got if r.key == key and (r.fired_at, r.n) <= (fired_at, n)]
        mine = sorted(covered, key=lambda r: -r.arrival)
        start = min(r.session_start for r in new)
        mine = [r for r in mine if r.session_start >= start and r.window_end <= end]
        values = [r.value for r in sorted(mine, key=lambda r: (r.value == 5, r.arrival))]
        built.append((key, end, n, final, tuple(values)))
    want = [(r.key, r.window_end, r.n, r.is_final, tuple(r["values"])) for r in lists]
    assert sorted(built) == sorted(want) and len(want) > 20 and any(len(v) > 1 for *_, v in want)
