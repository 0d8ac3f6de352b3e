"""Streaming forms: each micro-batch is one file (maxFilesPerTrigger=1,
availableNow), outputs compared with the batch jobs.  A far-future sentinel
row closes the event-time windows that end-of-input would close."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_DIR
from fleetwise.operators import pairing
from fleetwise.operators.tips import hourly_tips
from fleetwise.sources import adapters as A
from fleetwise.streaming import jobs, processors

SENTINEL_MS = 4_000_000_000_000
# Scripted times are shifted away from epoch 0 (Spark's initial watermark); the base
# is a multiple of 3 s and 5 s with an even second, so windows and parities keep.
BASE_T = 1_599_999_990_000


def _split_files(df, path, col, n):
    """Write ``df`` as ``n`` files ordered by ``col`` (one micro-batch each)."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    step = (hi - lo) / n + 1
    for i in range(n):
        part = df.where((F.col(col) >= lo + i * step) & (F.col(col) < lo + (i + 1) * step))
        part.coalesce(1).write.mode("overwrite").parquet(f"{path}/part{i:03d}")
    return [f"{path}/part{i:03d}" for i in range(n)]


def _run(spark, stream_df, name, mode="append"):
    q = (stream_df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="ckpt-" + name))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    return spark.table(name)


def _stream_of(spark, files, schema):
    d = tempfile.mkdtemp(prefix="stream-src-")
    for i, f in enumerate(files):
        spark.read.parquet(f).coalesce(1).write.mode("overwrite").parquet(f"{d}/f{i:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true") \
        .parquet(d)


def test_ride_cleansing_stream(spark):
    rides = A.rides(spark, SF_DIR)
    src = tempfile.mkdtemp()
    files = _split_files(rides.withColumn("ms", F.unix_millis("event_time")), src, "ms", 3)
    s = _stream_of(spark, files, rides.withColumn("ms", F.unix_millis("event_time")).schema)
    out = _run(spark, jobs.ride_cleansing(s).drop("ms"), "cleansing")
    from fleetwise.operators.cleansing import cleanse_rides
    assert out.exceptAll(cleanse_rides(rides)).count() == 0
    assert out.count() == cleanse_rides(rides).count()


def test_hourly_tips_stream_equals_batch(spark):
    fares = A.fares(spark, SF_DIR)
    sentinel = fares.limit(1).withColumn("event_time", F.timestamp_millis(F.lit(SENTINEL_MS))) \
                    .withColumn("tip", F.lit(0.0).cast("float")).withColumn("driver_id", F.lit(-1).cast("bigint"))
    src = tempfile.mkdtemp()
    f2 = fares.withColumn("ms", F.unix_millis("event_time"))
    files = _split_files(f2, src, "ms", 4)
    sentinel.withColumn("ms", F.lit(SENTINEL_MS)).coalesce(1).write.parquet(f"{src}/zz")
    s = _stream_of(spark, files + [f"{src}/zz"], f2.schema)
    out = _run(spark, jobs.hourly_tips(s), "tips")
    batch = hourly_tips(fares)
    got = {(r.window_end, r.driver_id, float(r.sum_tips)) for r in out.collect()}
    exp = {(r.window_end, r.driver_id, float(r.sum_tips)) for r in batch.collect()}
    assert got == exp


def test_pairing_processor_equals_batch(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", processors.ROCKSDB)
    rides, fares = A.rides(spark, SF_DIR), A.fares(spark, SF_DIR)
    u = processors.pairing_input(rides, fares)
    sentinel = u.limit(1).withColumn("ride_id", F.lit(-1).cast("bigint")) \
                .withColumn("event_time", F.timestamp_millis(F.lit(SENTINEL_MS))) \
                .withColumn("ms", F.lit(SENTINEL_MS))
    src = tempfile.mkdtemp()
    files = _split_files(u, src, "ms", 3)
    sentinel.coalesce(1).write.parquet(f"{src}/zz")
    s = _stream_of(spark, files + [f"{src}/zz"], u.schema)
    out = _run(spark, s.withWatermark("event_time", "0 seconds").groupBy("ride_id").transformWithState(
        processors.PairingProcessor(), processors.PAIR_OUT, "Append", "EventTime"), "pairs")
    got = {(r.kind, r.ride_id) for r in out.collect() if r.ride_id != -1}
    paired, solo_r, solo_f = pairing.expiring_pairs(rides, fares)
    exp = ({("pair", r.ride_id) for r in paired.collect()} | {("solo_ride", r.ride_id) for r in solo_r.collect()}
           | {("solo_fare", r.ride_id) for r in solo_f.collect()})
    assert got == exp


def test_early_tumbling_processor_golden(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", processors.ROCKSDB)
    # demo B, one watermark step per micro-batch; the last file is a sentinel
    batches = [[(0, 1, 0, 1), (1, 1, 0, 2)], [(2, 2, 0, 2), (3, 3, 0, 2)], [(4, 4, 0, 2), (5, 5, 0, 2)],
               [(6, 100000, 99, 0)]]
    src = tempfile.mkdtemp()
    files = []
    for i, b in enumerate(batches):
        df = spark.createDataFrame([(s, BASE_T + t * 1000, k, v) for s, t, k, v in b],
                                   "seq bigint, time bigint, key bigint, value bigint") \
                  .withColumn("event_time", F.timestamp_millis("time"))
        df.coalesce(1).write.parquet(f"{src}/b{i}")
        files.append(f"{src}/b{i}")
    s = _stream_of(spark, files, "seq bigint, time bigint, key bigint, value bigint, event_time timestamp")
    out = _run(spark, processors.early_tumbling_stream(s, 3000), "early3")
    got = sorted((r.is_final, r.total, r.window_end - BASE_T) for r in out.collect() if r.key == 0)
    # content of the firings of the golden: early 5 and 4, final 5 and 6
    assert got == [(False, 4, 6000), (False, 5, 3000), (True, 5, 3000), (True, 6, 6000)]


def test_asof_enrich_processor_fixture(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", processors.ROCKSDB)
    base = 1_600_000_000_000
    big = 3_000_000_000_000
    tfiles = [[1000, 1200, 1500], [1700, 1800, 2000], [big - base]]
    cfiles = [[0, 500], [1500], [1600, 2100], [big - base]]

    def write(batches, kind):
        d = tempfile.mkdtemp(prefix=kind)
        for i, b in enumerate(batches):
            df = spark.createDataFrame([(base + t, 0, f"{kind[0]}{t}") for t in b], "ms bigint, id bigint, info string")
            df.coalesce(1).write.parquet(f"{d}/f{i:02d}")
        return d
    td, cd = write(tfiles, "trade"), write(cfiles, "cust")
    ts = spark.readStream.schema("ms bigint, id bigint, info string").option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(td) \
        .select(F.timestamp_millis("ms").alias("trade_time"), F.col("id").alias("customer_id"),
                F.col("info").alias("trade_info"))
    cs = spark.readStream.schema("ms bigint, id bigint, info string").option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(cd) \
        .select(F.timestamp_millis("ms").alias("customer_time"), F.col("id").alias("customer_id"),
                F.col("info").alias("customer_info"))
    out = _run(spark, processors.enrich_trades_stream(ts, cs), "enrich")
    got = {r.trade_ms - base: (r.customer_ms - base if r.customer_ms else None) for r in out.collect()
           if r.trade_ms < big}
    assert got == {1000: 500, 1200: 500, 1500: 1500, 1700: 1600, 1800: 1600, 2000: 1600}


def test_nearest_taxi_runner(spark):
    from fleetwise.operators.nearest import nearest_taxi
    from fleetwise.plans.catalog import taxi_positions
    from fleetwise.streaming.runners import NearestTaxiRunner
    rides, calls = A.rides(spark, SF_DIR), A.calls(spark, SF_DIR)
    ride_cols = rides.select("ride_id", "is_start", "end_time", "end_lon", "end_lat", "taxi_id")
    tagged_r = ride_cols.select(F.lit("ride").alias("kind"), "*", *[F.lit(None).cast(t).alias(c) for c, t in
                                [("call_id", "bigint"), ("user_id", "bigint"), ("call_ms", "bigint"),
                                 ("longitude", "double"), ("latitude", "double")]])
    tagged_c = calls.select(F.lit("call").alias("kind"), *[F.lit(None).cast(f.dataType).alias(f.name)
                                                          for f in ride_cols.schema.fields],
                            "call_id", "user_id", F.col("timestamp").alias("call_ms"), "longitude", "latitude")
    src = tempfile.mkdtemp()
    tagged_r.where("ride_id % 2 = 0").coalesce(1).write.parquet(f"{src}/f0")
    tagged_r.where("ride_id % 2 = 1").coalesce(1).write.parquet(f"{src}/f1")
    tagged_c.coalesce(1).write.parquet(f"{src}/f2")
    s = spark.readStream.schema(tagged_r.schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    out = tempfile.mkdtemp()
    runner = NearestTaxiRunner(spark, out, state_path=tempfile.mkdtemp(), max_age_ms=None)
    q = (s.writeStream.foreachBatch(runner).option("checkpointLocation", tempfile.mkdtemp())
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {(r.call_id, r.taxi_id) for r in spark.read.parquet(out).collect()}
    exp = {(r.call_id, r.taxi_id) for r in nearest_taxi(calls, taxi_positions(rides)).collect()}
    assert got == exp and len(got) == calls.count()


def _tagged_rides(spark):
    rides = A.rides(spark, SF_DIR)
    cols = ["ride_id", "is_start", "start_time", "end_time", "start_lon", "start_lat", "end_lon", "end_lat",
            "passenger_cnt", "taxi_id", "driver_id", "event_time"]
    r = rides.select(F.lit("ride").alias("kind"), *cols, F.lit(None).cast("string").alias("value"))
    return rides, r


def _control_rows(spark, r, kind, messages):
    return spark.createDataFrame([(m,) for m in messages], "value string").select(
        F.lit(kind).alias("kind"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in r.schema.fields
                                     if f.name not in ("kind", "value")], "value")


def _run_batches(spark, parts, runner):
    src = tempfile.mkdtemp()
    for i, p in enumerate(parts):
        p.coalesce(1).write.parquet(f"{src}/f{i}")
    s = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    q = s.writeStream.foreachBatch(runner).option("checkpointLocation", tempfile.mkdtemp()) \
        .trigger(availableNow=True).start()
    q.awaitTermination(300)


def test_ongoing_rides_runner(spark):
    from fleetwise.operators.ongoing import ongoing_for_requests, open_rides
    from fleetwise.streaming.runners import OngoingRidesRunner
    rides, r = _tagged_rides(spark)
    reqs = _control_rows(spark, r, "request", ['{"during": 30}', '{"during": 5}', 'not json'])
    out = tempfile.mkdtemp()
    _run_batches(spark, [r.where("ride_id % 2 = 0"), r.where("ride_id % 2 = 1"), reqs],
                 OngoingRidesRunner(spark, out, state_path=tempfile.mkdtemp()))
    got = spark.read.parquet(out)
    at = rides.agg(F.max(F.unix_millis("event_time"))).first()[0] - 1
    # state holds every event processed (up to watermark + 1 ms); requests are judged at the watermark
    exp = ongoing_for_requests(open_rides(rides, at + 1), spark.createDataFrame([(30,), (5,)], "during bigint"), at)
    key = lambda df: sorted((x.during_ms, x.ride_id) for x in df.select("during_ms", "ride_id").collect())  # noqa
    assert key(got) == key(exp)


def test_rules_runner(spark):
    from fleetwise.operators.rules import evaluate_rules
    from fleetwise.operators.status import latest_by_taxi, ride_status
    from fleetwise.streaming.runners import RulesRunner
    rides, r = _tagged_rides(spark)
    rules = _control_rows(spark, r, "rule", ['{"condition": "passenger_count >= 4"}', '{"condition": "nope("}'])
    out = tempfile.mkdtemp()
    _run_batches(spark, [r.where("ride_id % 2 = 0"), r.where("ride_id % 2 = 1"), rules],
                 RulesRunner(spark, out, state_path=tempfile.mkdtemp()))
    got = sorted(x.ride_id for x in spark.read.parquet(f"{out}/matches").where("batch = 2").collect())
    wm = rides.agg(F.max(F.unix_millis("event_time"))).first()[0] - 1
    m, _ = evaluate_rules(ride_status(latest_by_taxi(rides)),
                          spark.createDataFrame([(1, "passenger_count >= 4")], "rule_id bigint, condition string"), wm)
    assert got == sorted(x.ride_id for x in m.collect())
    assert spark.read.parquet(f"{out}/rejects").count() == 1


def _element_batches(spark, batches, base=0):
    src = tempfile.mkdtemp()
    for i, b in enumerate(batches):
        spark.createDataFrame([(q, t + base, k, v) for q, t, k, v in b], "seq bigint, time bigint, key bigint, value bigint") \
             .withColumn("event_time", F.timestamp_millis("time")).coalesce(1).write.parquet(f"{src}/b{i:02d}")
    return spark.readStream.schema("seq bigint, time bigint, key bigint, value bigint, event_time timestamp") \
        .option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)


C_B1 = [(1, 1000, 0, 1), (2, 2000, 0, 4), (3, 3000, 0, 4), (4, 4000, 0, 4)]
SENT = [(99, 100000, 9, 1)]


def test_early_session_processor_case1(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", processors.ROCKSDB)
    # the reference's intermediate watermark W(6500) is a batch of its own (another key at 6500)
    s = _element_batches(spark, [C_B1, [(5, 6000, 0, 5)], [(6, 6500, 7, 1)], [(7, 7000, 0, 4)], SENT], BASE_T)
    out = _run(spark, processors.early_session_stream(s, 5000), "sess1")
    got = sorted((r.window_end - BASE_T, r.values, r.is_final) for r in out.collect() if r.key == 0)
    assert got == [(11000, [1, 4, 4, 4, 5], False), (12000, [1, 4, 4, 4, 4, 5], True)]


def test_early_session_processor_case2(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", processors.ROCKSDB)
    s = _element_batches(spark, [C_B1, [(5, 6000, 0, 5)], [(7, 7000, 0, 4)], SENT], BASE_T)
    out = _run(spark, processors.early_session_stream(s, 5000), "sess2")
    got = sorted((r.window_end - BASE_T, r.values, r.is_final) for r in out.collect() if r.key == 0)
    assert got == [(12000, [1, 4, 4, 4, 4, 5], False)]


def test_start_stream_restarts_from_checkpoint(spark):
    """A query stopped and started again on the same checkpoint resumes
    (no file is processed twice, none is skipped)."""
    from fleetwise.streaming.run import start_stream
    rides = A.rides(spark, SF_DIR)
    src, out, ck = tempfile.mkdtemp(), tempfile.mkdtemp(), tempfile.mkdtemp()
    rides.where("ride_id % 2 = 0").coalesce(1).write.parquet(f"{src}/a")
    s = spark.readStream.schema(rides.schema).option("recursiveFileLookup", "true").parquet(src)
    q = start_stream(jobs.ride_cleansing(s), "restart1", path=out, checkpoint=ck, trigger=None)
    q.processAllAvailable()
    q.stop()
    rides.where("ride_id % 2 = 1").coalesce(1).write.parquet(f"{src}/b")
    q = start_stream(jobs.ride_cleansing(s), "restart2", path=out, checkpoint=ck, trigger=None)
    q.processAllAvailable()
    q.stop()
    from fleetwise.operators.cleansing import cleanse_rides
    assert spark.read.parquet(out).count() == cleanse_rides(rides).count()


def test_hourly_tips_stream_out_of_order_within_delay(spark):
    """Bounded disorder: micro-batches arrive out of event-time order but
    within the watermark delay, so nothing is late and the result equals batch."""
    fares = A.fares(spark, SF_DIR)
    f2 = fares.withColumn("ms", F.unix_millis("event_time"))
    src = tempfile.mkdtemp()
    files = _split_files(f2, src, "ms", 4)
    sentinel = fares.limit(1).withColumn("event_time", F.timestamp_millis(F.lit(SENTINEL_MS))) \
                    .withColumn("tip", F.lit(0.0).cast("float")).withColumn("driver_id", F.lit(-1).cast("bigint")) \
                    .withColumn("ms", F.lit(SENTINEL_MS))
    sentinel.coalesce(1).write.parquet(f"{src}/zz")
    order = [files[1], files[0], files[3], files[2], f"{src}/zz"]
    s = _stream_of(spark, order, f2.schema)
    out = _run(spark, jobs.hourly_tips(s, delay="8 days"), "tips_disorder")
    got = {(r.window_end, r.driver_id, float(r.sum_tips)) for r in out.collect()}
    exp = {(r.window_end, r.driver_id, float(r.sum_tips)) for r in hourly_tips(fares).collect()}
    assert got == exp


def test_early_session_processor_disorder_equals_batch(spark):
    """Demo D (gap 1 h, a 4 arriving after the finish code): one element per
    micro-batch, each followed by its watermark; the firings' contents and
    early/final labels equal the batch form's on the same timeline."""
    from conftest import timeline
    from fleetwise.operators.early import early_session
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", processors.ROCKSDB)
    pts = [(1552319238044, 0, 1), (1552319550448, 0, 4), (1552319851529, 0, 4), (1552320152653, 0, 4),
           (1552320237880, 0, 2), (1552320538612, 0, 4), (1552320839585, 0, 4), (1552320994646, 0, 5),
           (1552320945515, 0, 4), (1552321005515, 1, 1), (1552400000000, 9, 1)]
    # after each element a batch of another key at the running maximum time: timers
    # reached by the element's watermark fire before the next element arrives,
    # as with the per-element watermarks of the batch timeline
    batches, mx = [], 0
    for i, (t, k, v) in enumerate(pts):
        mx = max(mx, t)
        batches += [[(2 * i, t, k, v)], [(2 * i + 1, mx, 8, 1)]]
    s = _element_batches(spark, batches)
    out = _run(spark, processors.early_session_stream(s, 3_600_000), "sessD")
    got = sorted((r.key, r.window_end, r.values, r.is_final) for r in out.collect() if r.key not in (8, 9))
    script, wm = [], None
    for t, k, v in pts:
        script.append(("E", t, k, v))
        wm = t if wm is None else max(wm, t)
        script.append(("W", wm))
    b = early_session(timeline(spark, script), 3_600_000)
    exp = sorted((r.key, r.window_end, r.values, r.is_final) for r in b.collect() if r.key != 9)
    assert got == exp
