"""Results that must not depend on size, order of arrival or how a rule is written."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwise.operators import early, ongoing, routes, rules, scan, toggle
from fleetwise.sources import control
from fleetwise.streaming import processors, runners


@pytest.mark.parametrize("target", [7, 1 << 20])
def test_null_keys_and_null_times(spark, target):
    rows = [(None if i % 3 == 0 else i % 3, None if i % 50 == 0 else i * 37 % 1000, i) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, t long, i long")
    order = [F.col("t"), F.col("i")]
    got = scan.running_agg(df, ["k"], order, F.lit(1), "n", fn="count", target=target)
    got = scan.carry_last(got, ["k"], order, F.when(F.col("i") % 5 == 0, F.col("i")), "last", target=target)
    w = W.partitionBy("k").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    want = df.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("last", F.last(F.when(F.col("i") % 5 == 0, F.col("i")), True).over(w))
    assert sorted(map(tuple, got.select("i", "n", "last").collect())) == sorted(map(tuple, want.select("i", "n", "last").collect()))


def test_a_burst_is_spread(spark):
    rows = [(1, i if i >= 19_000 else 500_000 + i // 19) for i in range(20_000)] + [(1, 10 ** 15)]
    df = spark.createDataFrame(rows, "k long, t long")
    for keys in (["k"], []):
        b, single = scan._bucketed(df, keys, [F.col("t")], None, 1000)
        assert not single
        assert b.groupBy("_bkt").count().agg(F.max("count")).first()[0] <= 2000


def test_session_open_at_the_end_from_position_zero(spark, monkeypatch):
    rows = [(i, "E", 1000 + i, 1, 5 if i % 40 == 0 else 2) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, kind string, time long, key long, value long")
    whole = sorted(map(str, early.early_session(df, 1000).collect()))
    monkeypatch.setattr(scan, "TARGET_ROWS", 50)
    assert sorted(map(str, early.early_session(df, 1000).collect())) == whole and whole


def test_routes_take_nan_as_the_first_cell():
    nan = np.float32("nan")
    lon, lat = np.float32(-73.99), np.float32(40.75)
    cells = routes.walk_cells(np.array([nan, lon]), np.array([lat, nan]), np.array([lon, lon]), np.array([lat, lat]))
    assert [len(c) > 0 for c in cells] == [True, True]
    x, y = routes._grid(np.array([nan, lon]), np.array([lat, nan]))
    assert x[0] == 0 and y[1] == 0


def test_many_controls_and_requests(spark):
    t = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    keyed = spark.createDataFrame([(1, t + dt.timedelta(seconds=5)), (2, t + dt.timedelta(seconds=7)), (2, t + dt.timedelta(seconds=9))],
                                  "key long, time timestamp")
    controls = spark.range(20_000).select((F.lit(t) + F.make_interval(secs=F.col("id"))).alias("time"), F.col("id").alias("value"))
    got = toggle.apply_controls(keyed, controls)
    assert sorted((r.key, r.control_value) for r in got.where("control_value < 12").collect()) == sorted(
        [(1, i) for i in range(5, 12)] + [(2, 7), (2, 8)])
    assert got.count() == 19_995 + 2
    rides = spark.createDataFrame([(1, 1, 1, t, 0.0, 0.0, 1)], ", ".join(f"{c} {k}" for c, k in zip(ongoing.ONGOING_COLS, (
        "long", "long", "long", "timestamp", "float", "float", "smallint"))))
    at = int(t.timestamp() * 1000) + 600_000
    asked = spark.createDataFrame([(5,), (None,), (20,)], "during long")
    few, many = (ongoing.ongoing_for_requests(rides, asked, at, n).select("during_ms").collect() for n in (64, 0))
    assert few == many and [r.during_ms for r in few] == [300_000]


def test_rules_are_judged_by_their_plan(spark):
    state = spark.createDataFrame([(1, 3), (2, 9)], "taxi_id long, n long")
    bad = ["`java_method`('java.lang.System', 'nanoTime') = '1'", "java_method /* x */ ('java.lang.System', 'nanoTime') = '1'",
           "reflect('java.lang.System', 'nanoTime') = '1'", "max(n) > 1", "explode(array(true))", "rand() > 0.5",
           "row_number() over (order by n) = 1", "n > (select 1)", "n +", "n"]
    many = [(100 + i, f"n > {i % 10}") for i in range(450)]
    given = spark.createDataFrame([(1, "n > 5"), *((10 + i, b) for i, b in enumerate(bad)), *many], "rule_id long, condition string")
    matches, rejects = rules.evaluate_rules(state, given, 0)
    assert sorted(r.rule_id for r in rejects.collect()) == [10 + i for i in range(len(bad))]
    found = sorted((r.rule_id, r.taxi_id) for r in matches.collect())
    want = [(1, 2)] + [(100 + i, t) for i in range(450) for t, n in ((1, 3), (2, 9)) if n > i % 10]
    assert found == sorted(want)


def test_messages_are_parsed_once(spark):
    df = control.parse_calls(spark.createDataFrame([('{"userId":1,"timestamp":2,"longitude":3.0,"latitude":4.0}',), ("{",), (None,)], "value string"))
    assert df.count() == 1
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


RIDE = ("kind string, value string, ride_id long, is_start boolean, start_time timestamp, end_time timestamp, start_lon float, "
        "start_lat float, end_lon float, end_lat float, passenger_cnt smallint, taxi_id long, driver_id long, event_time timestamp")


def ride(ride_id, start, minute):
    t = dt.datetime(2020, 1, 1, 0, minute, tzinfo=dt.timezone.utc)
    return ("ride", None, ride_id, start, t, t, 0.0, 0.0, 0.0, 0.0, 1, ride_id, 1, t)


def test_an_end_before_its_start_closes_the_ride(spark, tmp_path):
    run = runners.OngoingRidesRunner(spark, f"{tmp_path}/out", f"{tmp_path}/state")
    ask = ("request", '{"during": 0}', *[None] * 12)
    run(spark.createDataFrame([ride(1, False, 20)], RIDE), 0)
    run(spark.createDataFrame([ride(1, True, 10), ride(2, True, 11), ask], RIDE), 1)
    run(spark.createDataFrame([ride(3, True, 30), ask], RIDE), 2)
    answers = {(r.batch, r.ride_id) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert answers == {(1, 2), (2, 2)}
    assert run.table.versions() == [1, 2]


def test_a_rule_before_any_ride_matches_nothing(spark, tmp_path):
    run = runners.RulesRunner(spark, f"{tmp_path}/out", f"{tmp_path}/state")
    run(spark.createDataFrame([("rule", '{"condition": "true"}', *[None] * 12)], RIDE), 0)
    assert run.table.versions() == [0]


def test_unreadable_state_fails(spark, tmp_path):
    table = runners.VersionedTable(spark, f"{tmp_path}/t", "a long")
    assert table.previous(0).count() == 0
    table.write(spark.range(3).toDF("a"), 0)
    for f in (tmp_path / "t" / "batch=0").glob("part-*"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception):
        table.previous(1).count()


def test_toggle_runner_equals_batch(spark, tmp_path):
    rng = random.Random(4)
    t0 = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(rng.choice(["element"] * 3 + ["control"]), rng.randrange(6), t0 + dt.timedelta(seconds=i), i) for i in range(90)]
    schema = "kind string, key long, time timestamp, value long"
    run = runners.ToggleRunner(spark, f"{tmp_path}/out", f"{tmp_path}/state")
    for b in range(3):
        run(spark.createDataFrame(rows[b * 30:b * 30 + 30], schema), b)
    every = spark.createDataFrame(rows, schema)
    want = toggle.apply_controls(every.where("kind = 'element'"), every.where("kind = 'control'"))
    got = spark.read.parquet(f"{tmp_path}/out").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 20


def test_streaming_pairs_by_id_alone(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", processors.ROCKSDB)
    schema = "side string, ride_id long, is_start boolean, event_time timestamp, driver_id long, tip float"
    t = lambda m: dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=m)
    batches = [[("ride", 1, True, t(900), 1000, None), ("fare", 2, None, t(1), 7, 2.0), ("ride", 3, False, t(2), 7, None)],
               [("fare", 1, None, t(0), 1000, 1.0), ("ride", 4, True, t(5), 7, None)], [("ride", 2, True, t(5000), 7, None)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/b{i}")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    out = processors.pair_rides_fares(s.where("side = 'ride'"), s.where("side = 'fare'"))
    q = out.writeStream.format("memory").queryName("pairs_by_id").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.ride_id, r.kind, r.tip) for r in spark.table("pairs_by_id").collect()) == [(1, "pair", 1.0), (2, "pair", 2.0)]
