"""Scripted fixtures: as-of enrichment, toggle broadcast, route walk, pairing
properties, rules safety, text codecs."""

import pytest
from pyspark.sql import functions as F

from fleetwise.operators import asof, pairing, routes, rules, toggle
from fleetwise.sources import text

BASE = 1_600_000_000_000  # shift scripted times away from epoch 0


def test_asof_trades_customers(spark):
    cust = spark.createDataFrame([(BASE + t, 0, f"c{t}") for t in (0, 500, 1500, 1600, 2100)],
                                 "ms bigint, customer_id bigint, customer_info string") \
                .select(F.timestamp_millis("ms").alias("customer_time"), "customer_id", "customer_info")
    trades = spark.createDataFrame([(BASE + t, 0, f"t{t}") for t in (1000, 1200, 1500, 1700, 1800, 2000)],
                                   "ms bigint, customer_id bigint, trade_info string") \
                  .select(F.timestamp_millis("ms").alias("trade_time"), "customer_id", "trade_info")
    out = asof.asof_join(trades, cust, "customer_id", "trade_time", "customer_time", ["customer_info"],
                         bucket_ms=700)
    got = {r.trade_info: r.customer_info for r in out.collect()}
    assert got == {"t1000": "c500", "t1200": "c500", "t1500": "c1500", "t1700": "c1600", "t1800": "c1600",
                   "t2000": "c1600"}


def test_asof_never_later_than_left(spark):
    left = spark.range(200).select((F.col("id") * 7 % 50).alias("k"), (F.col("id") * 13 % 1000).alias("t"))
    right = spark.range(300).select((F.col("id") * 11 % 50).alias("k"), (F.col("id") * 17 % 1000).alias("rt"),
                                    F.col("id").alias("rid"))
    out = asof.asof_numeric(left, right, ["k"], "t", "rt", ["rt", "rid"], 100.0)
    rows = out.collect()
    assert len(rows) == 200
    rmap = {}
    for r in right.collect():
        rmap.setdefault(r.k, []).append(r.rt)
    for r in rows:
        cands = [x for x in rmap.get(r.k, []) if x <= r.t]
        assert r.rt == (max(cands) if cands else None)


def test_toggle_fixture(spark):
    keyed = spark.createDataFrame([(BASE + 1, 0), (BASE + 3, 1)], "ms bigint, key bigint") \
                 .select("key", F.timestamp_millis("ms").alias("time"))
    controls = spark.createDataFrame([(BASE + 0, 1), (BASE + 2, 2)], "ms bigint, value bigint") \
                    .select(F.timestamp_millis("ms").alias("time"), "value")
    out = toggle.apply_controls(keyed, controls).collect()
    assert [(r.control_value, r.key) for r in out] == [(2, 0)]


def test_route_fixture_values():
    def pt(x, y):
        return -(74.05 - (x + 0.5) * 0.0014), 41.0 - (y + 0.5) * 0.00125

    def cells(a, b, strict=False):
        (l1, t1), (l2, t2) = pt(*a), pt(*b)
        return [(int(c) % 250, int(c) // 250) for c in routes.walk_cells([l1], [t1], [l2], [t2], strict)[0]]
    assert cells((0, 0), (3, 3)) == [(0, 0), (1, 1), (2, 2), (3, 3)]
    assert cells((0, 0), (3, 0)) == [(0, 0), (1, 0), (2, 0), (3, 0)]
    assert cells((0, 5), (1, 4)) == [(0, 5), (2, 4)]
    assert cells((0, 5), (1, 4), strict=True) == [(0, 5), (1, 4)]


def test_route_walk_terminates_on_offsets():
    import numpy as np
    xs, ys = np.meshgrid(np.arange(0, 40), np.arange(-20, 21))
    n = xs.size
    lon0, lat0 = -74.0, 40.7
    lon1 = lon0 + xs.ravel() * 0.0014
    lat1 = lat0 - ys.ravel() * 0.00125
    out = routes.walk_cells(np.full(n, lon0), np.full(n, lat0), lon1, lat1)
    assert len(out) == n and all(len(c) >= 1 for c in out)


def test_pairing_partitions_input(spark):
    from conftest import SF_DIR
    from fleetwise.sources import adapters as A
    rides, fares = A.rides(spark, SF_DIR), A.fares(spark, SF_DIR)
    paired, solo_r, solo_f = pairing.expiring_pairs(rides, fares)
    n_r = rides.where("is_start AND driver_id % 1000 <> 0").count()
    assert paired.count() + solo_r.count() == n_r
    assert paired.count() + solo_f.count() == fares.count()


def test_rules_reject_bad_and_denied(spark):
    st = spark.createDataFrame([(1, 3), (2, 5)], "ride_id bigint, passenger_count int")
    rl = spark.createDataFrame([(1, "passenger_count > 4"), (2, "nope >"), (3, "reflect('java.lang.System','exit','0') IS NULL"),
                                (4, "passenger_count + 1"), (5, "EXISTS (SELECT 1)")], "rule_id bigint, condition string")
    m, rej = rules.evaluate_rules(st, rl, 0)
    assert [(r.rule_id, r.ride_id) for r in m.collect()] == [(1, 2)]
    assert sorted(r.rule_id for r in rej.collect()) == [2, 3, 4, 5]


def test_text_modes(spark):
    lines = spark.createDataFrame([("1,START,2013-01-01 00:00:00,2013-01-01 00:10:00,-73.9,40.7,-73.8,40.8,1,5,7",),
                                   ("2,END,2013-01-01 00:20:00,2013-01-01 00:05:00,,,-73.8,40.8,2,5,7",),
                                   ("3,MIDDLE,2013-01-01 00:20:00,2013-01-01 00:05:00,1,1,1,1,2,5,7",),
                                   ("4,START,2013-01-01 00:20:00,2013-01-01 00:05:00,1,1,1,1,2,5,",)], "value string")
    good, bad = text.parse_ride_lines(lines, mode="split")
    g = {r.ride_id: r for r in good.collect()}
    assert set(g) == {1, 2} and bad.count() == 2
    assert g[2].start_lon == 0.0 and g[2].is_start is False
    assert str(g[2].start_time) == "2013-01-01 00:05:00" and str(g[2].end_time) == "2013-01-01 00:20:00"
    with pytest.raises(Exception, match="Invalid ride record"):
        text.parse_ride_lines(lines, mode="failfast").collect()


def test_ride_line_roundtrip(spark):
    from conftest import SF_DIR
    from fleetwise.sources import adapters as A
    r = A.rides(spark, SF_DIR)
    back = text.parse_ride_lines(text.format_ride_lines(r).select("value"))
    assert back.exceptAll(r.select(*back.columns)).count() == 0
    assert r.count() == back.count()


def test_gzip_logs_roundtrip_batch_and_stream(spark):
    import tempfile
    from conftest import SF_DIR
    from fleetwise.sources import adapters as A
    fares = A.fares(spark, SF_DIR)
    d = tempfile.mkdtemp()
    text.write_log(text.format_fare_lines(fares).repartition(3), f"{d}/fares")
    back = text.read_fare_log(spark, f"{d}/fares")
    assert back.count() == fares.count() and back.exceptAll(fares.select(*back.columns)).count() == 0
    s = text.read_fare_log(spark, f"{d}/fares", streaming=True, max_files_per_trigger=1)
    q = (s.writeStream.format("memory").queryName("fare_log").option("checkpointLocation", tempfile.mkdtemp())
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.table("fare_log").count() == fares.count()


def test_points_and_json_encoders(spark):
    import tempfile
    from fleetwise.sinks import encode, writers
    df = spark.createDataFrame([("a b,c", 1_600_000_000_000, 1.5), ("k", 1_600_000_001_000, 2.0)],
                               "k string, t bigint, v double")
    p = encode.datapoints(df, "tips", "t", "v", key="k")
    lines = sorted(r.line for r in p.collect())
    assert lines == [r"tips,key=a\ b\,c value=1.5 1600000000000000000", "tips,key=k value=2.0 1600000001000000000"]
    d = tempfile.mkdtemp()
    writers.write_points(p, f"{d}/points", "pts")
    assert sorted(r.value for r in spark.read.text(f"{d}/points").collect()) == lines
    j = encode.json_records(df.select("k", "v"), {"key": "k", "value": "v"}, key="k")
    assert sorted(r.value for r in j.collect()) == ['{"key":"a b,c","value":1.5}', '{"key":"k","value":2.0}']


def test_toggle_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    base = 1_600_000_000_000
    els = [(rnd.choice([0, 0, 0, 1, 2, 3]), base + rnd.randint(0, 60) * 1000) for _ in range(80)]
    ctl = sorted({base + rnd.randint(-5, 65) * 1000 for _ in range(12)})
    keyed = spark.createDataFrame(els, "key bigint, ms bigint").select("key", F.timestamp_millis("ms").alias("time"))
    controls = spark.createDataFrame([(t, i) for i, t in enumerate(ctl)], "ms bigint, value bigint") \
                    .select(F.timestamp_millis("ms").alias("time"), "value")
    got = sorted((r.control_value, r.key) for r in toggle.apply_controls(keyed, controls).collect())
    exp = sorted((i, k) for i, t in enumerate(ctl) for k in {k for k, _ in els}
                 if sum(1 for kk, tt in els if kk == k and tt <= t) % 2 == 1)
    assert got == exp


def test_ongoing_requests_paths_agree(spark):
    """The broadcast range join and the as-of path give the same rows, with
    duplicate and unmatched request durations."""
    from conftest import SF_DIR
    from fleetwise.operators import ongoing
    from fleetwise.sources import adapters as A
    at = 1357300000000
    op = ongoing.open_rides(A.rides(spark, SF_DIR), at)
    reqs = spark.createDataFrame([(d,) for d in [5, 30, 30, 60, 240, 100000] * 12], "during bigint")
    a = ongoing.ongoing_for_requests(op, reqs, at, broadcast_limit=1000)
    b = ongoing.ongoing_for_requests(op, reqs, at, broadcast_limit=0)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_nearest_taxi_exact_against_brute_force(spark):
    """Dense taxis in NYC plus far and NaN positions; calls near and far (the
    far ones are settled only at coarse levels or the final catch-all)."""
    import numpy as np
    from fleetwise.operators import nearest
    rng = np.random.default_rng(3)
    tx = [(i, float(-74.0 + rng.random() * 0.3), float(40.6 + rng.random() * 0.3)) for i in range(60)]
    tx += [(60, -70.0, 42.0), (61, float("nan"), 40.7), (62, -73.9, 10.0)]
    calls = [(j, float(-74.0 + rng.random() * 0.3), float(40.6 + rng.random() * 0.3)) for j in range(40)]
    calls += [(40, -73.95, 40.75), (41, -71.0, 41.5), (42, -120.0, 35.0), (43, -73.9, 11.0)]
    taxis = spark.createDataFrame(tx, "taxi_id bigint, longitude double, latitude double")
    cdf = spark.createDataFrame(calls, "call_id bigint, longitude double, latitude double")
    got = {r.call_id: r.taxi_id for r in nearest.nearest_taxi(cdf, taxis).collect()}

    def dist(lon1, lat1, lon2, lat2):
        x = np.float64(np.float32(lat1) - np.float32(lat2))
        y = np.float64(np.float32(lon1) - np.float32(lon2)) * np.cos(np.float64(np.float32(lat2)))
        return 110.25 * np.sqrt(x * x + y * y)
    exp = {}
    for cid, lo, la in calls:
        ds = [(dist(lo, la, tlo, tla), tid) for tid, tlo, tla in tx if not np.isnan(dist(lo, la, tlo, tla))]
        exp[cid] = min(ds)[1]
    assert got == exp


def test_checkpoint_dir_is_read_not_replaced(spark):
    """The configured folder (set at session build, as a cluster would) is
    the one jobs checkpoint into."""
    from fleetwise.session import checkpoint_dir
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    got = checkpoint_dir(spark)
    # Spark places each application's checkpoints in a subfolder of the configured one
    assert configured and got.split(":", 1)[-1].startswith(configured.rstrip("/"))
