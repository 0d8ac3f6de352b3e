"""The spatial tree: exact, and its work does not depend on stray taxis."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwise.operators import nearest as N


def dist(lon1, lat1, lon2, lat2):
    x = np.float64(np.float32(lat1) - np.float32(lat2))
    y = np.float64(np.float32(lon1) - np.float32(lon2)) * np.cos(np.float64(np.float32(lat2)))
    return 110.25 * np.sqrt(x * x + y * y)


def city(n, rng):
    """Positions crowded around a few places."""
    hot = rng.random((5, 2)) * 0.3
    p = hot[rng.integers(0, 5, n)] + rng.normal(0, 0.02, (n, 2))
    return [(i, float(-74.0 + x), float(40.55 + y)) for i, (x, y) in enumerate(p)]


def frames(spark, calls, taxis):
    return (spark.createDataFrame(calls, "call_id bigint, longitude double, latitude double"),
            spark.createDataFrame(taxis, "taxi_id bigint, longitude double, latitude double"))


STRAY = {"none": [], "gulf": [(9000, 0.0, 0.0)], "no_cosine": [(9000, -74.0, 39.26990816987241)], "pole": [(9000, 10.0, 90.0)],
         "beyond": [(9000, 999.0, -1234.0)]}


@pytest.mark.parametrize("stray", sorted(STRAY))
def test_exact_with_few_candidates(spark, stray):
    rng = np.random.default_rng(7)
    taxis = city(1500, rng) + STRAY[stray]
    calls = [(j, lo, la) for j, lo, la in city(150, rng)] + [(500, -120.0, 35.0), (501, 0.01, 0.01), (502, -74.0, 39.2), (503, -74.0, 39.3)]
    c, t = frames(spark, calls, taxis)
    got = {r.call_id: (r.taxi_id, r.distance) for r in N.nearest_taxi(c, t).collect()}
    for cid, lo, la in calls:
        best = min((dist(lo, la, x, y), i) for i, x, y in taxis)
        assert got[cid][0] == best[1] and abs(got[cid][1] - best[0]) <= 1e-12 * max(1, best[0])
    asked = c.where("call_id < 500").select(F.col("call_id").alias("_call"), N._single("longitude").alias("_lon"), N._single("latitude").alias("_lat"))
    places = t.select("taxi_id", N._single("longitude").alias("lon"), N._single("latitude").alias("lat"))
    pairs = N.candidates(asked, places.withColumn("z", N.z_order(F.col("lon"), F.col("lat")))).count()
    assert pairs < 2 * 150 * 40  # of 150 x 1,500; without a stray taxi about 3,600


def test_repeated_call_ids_ties_and_rows_without_position(spark):
    nan, inf = float("nan"), float("inf")
    taxis = [(5, -74.0, 40.7), (3, -74.0, 40.7), (7, -73.9, 40.7), (8, None, 40.7), (9, nan, 40.7), (10, inf, 40.7)]
    taxis += [(100 + i, -73.8, 40.8) for i in range(300)]  # more on one point than a leaf holds
    calls = [(1, -74.0, 40.7), (1, -73.9, 40.7), (1, -73.9, 40.7), (2, -73.95, 40.7), (3, None, 40.7), (4, nan, 40.7), (6, -73.8, 40.8), (None, -73.9, 40.7)]
    c, t = frames(spark, calls, taxis)
    got = N.nearest_taxi(c.withColumn("node", F.lit(1)), t.withColumn("z", F.lit(2)))
    assert got.columns == ["call_id", "longitude", "latitude", "node", "distance", "taxi_id", "taxi_longitude", "taxi_latitude", "taxi_z"]
    found = sorted(((r.call_id, r.longitude, r.taxi_id) for r in got.collect()), key=str)
    exact = min((dist(-73.95, 40.7, x, y), i) for i, x, y in taxis[:3])[1]
    assert found == sorted([(1, -74.0, 3), (1, -73.9, 7), (1, -73.9, 7), (2, -73.95, exact), (6, -73.8, 100), (None, -73.9, 7)], key=str)
    assert N.nearest_taxi(c, t.limit(0)).count() == 0 and N.nearest_taxi(c.limit(0), t).count() == 0
    assert N.nearest_taxi(c, t.limit(0)).columns == N.nearest_taxi(c, t).columns


def test_z_order_interleaves(spark):
    rng = np.random.default_rng(1)
    pts = [(float(x), float(y)) for x, y in zip(rng.uniform(-180, 180, 50), rng.uniform(-90, 90, 50))] + [(-180.0, -90.0), (180.0, 90.0), (1e9, -1e9)]
    got = spark.createDataFrame(pts, "lon double, lat double").select("lon", "lat", N.z_order(F.col("lon"), F.col("lat")).alias("z")).collect()
    for r in got:
        clip = lambda v, low, high: int(min(max((v - low) / (high - low) * (1 << 24) // 1, 0), (1 << 24) - 1))
        x, y = clip(r.lon, -180, 180), clip(r.lat, -90, 90)
        assert r.z == sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(24))
