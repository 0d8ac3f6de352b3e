"""Scalar geo functions at the fixture points, and the cleansing fixture."""

import math

import pytest
from pyspark.sql import functions as F

from fleetwise.functions import geo

STATION = (-73.9947, 40.750626)
POLE = (0.0, 90.0)


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_cell_id_and_center(spark):
    r = _one(spark, geo.cell_id(F.lit(STATION[0]), F.lit(STATION[1])).alias("c"))
    assert r.c == 49789
    r = _one(spark, geo.cell_center_lon(F.lit(49789)).alias("lon"), geo.cell_center_lat(F.lit(49789)).alias("lat"))
    assert r.lon == pytest.approx(-73.9946976, abs=1e-6)
    assert r.lat == pytest.approx(40.7506256, abs=1e-6)


def test_distance(spark):
    r = _one(spark, geo.euclidean_distance(F.lit(STATION[0]), F.lit(STATION[1]), F.lit(-73.99), F.lit(40.75))
             .alias("d"))
    assert r.d == pytest.approx(0.5206020149, abs=1e-9)


@pytest.mark.parametrize("dlon,dlat,expected", [(0.01, 0, 359), (0, -0.01, 89), (-0.01, 0, 179), (0, 0.01, 269),
                                                (0, 0, 359)])
def test_direction(spark, dlon, dlat, expected):
    lon, lat = -73.98, 40.75
    r = _one(spark, geo.direction_angle(F.lit(lon), F.lit(lat), F.lit(lon + dlon), F.lit(lat + dlat)).alias("a"))
    assert r.a == expected


def test_direction_bucket(spark):
    r = _one(spark, geo.direction_bucket(F.lit(-1)).alias("a"), geo.direction_bucket(F.lit(359)).alias("b"))
    assert (r.a, r.b) == (0, 7)


def test_in_nyc_bounds_and_nan(spark):
    # 41.0 is exact in single precision: the bound is inclusive.  -73.7 as a
    # float is -73.69999695, east of the (double) bound, so it is outside.
    r = _one(spark, geo.in_nyc(F.lit(-73.75), F.lit(41.0)).alias("edge"),
             geo.in_nyc(F.lit(-73.7), F.lit(40.7)).alias("east"),
             geo.in_nyc(F.lit(float("nan")), F.lit(40.7)).alias("nan"))
    assert (r.edge, r.east, r.nan) == (True, False, True)


def test_ride_cleansing_fixture(spark):
    from fleetwise.operators.cleansing import cleanse_rides
    rows = [("aPennStation", *STATION, *STATION), ("toThePole", *STATION, *POLE),
            ("fromThePole", *POLE, *STATION), ("atNorthPole", *POLE, *POLE)]
    df = spark.createDataFrame(rows, "name string, start_lon float, start_lat float, end_lon float, end_lat float")
    assert [r.name for r in cleanse_rides(df).collect()] == ["aPennStation"]


def test_sql_functions(spark):
    geo.register_sql_functions(spark)
    r = spark.sql(f"SELECT to_cell_id(CAST({STATION[0]} AS FLOAT), CAST({STATION[1]} AS FLOAT)) AS c, "
                  f"is_in_nyc(CAST(0 AS FLOAT), CAST(90 AS FLOAT)) AS n, to_coords(49789) AS p, "
                  f"time_diff_ms(TIMESTAMP'2013-01-01 00:00:00', TIMESTAMP'2013-01-01 00:00:01.5') AS d").first()
    assert r.c == 49789 and r.n is False and r.d == 1500
    assert math.isclose(r.p.lon, -73.9946976, abs_tol=1e-6)


def test_java_narrowing_under_ansi(spark):
    # NaN -> 0 and saturation, as a Java (int) cast; a plain cast fails under ANSI mode
    nan = F.lit(float("nan"))
    r = _one(spark, geo.direction_angle(nan, F.lit(40.7), F.lit(-73.9), F.lit(40.8)).alias("a"),
             geo.java_int(F.lit(1e12)).alias("big"), geo.java_int(F.lit(-2.9)).alias("neg"),
             geo.cell_id(nan, F.lit(40.7)).alias("c"))
    assert (r.a, r.big, r.neg, r.c) == (179, 2147483647, -2, 59750)
