"""Geographic Column functions over the NYC grid.

Every function returns a Column built from Spark built-ins, so it runs inside
whole-stage codegen; nothing here is a Python UDF.  Arguments may be Column
objects or column names.  Float inputs are treated the way the domain treats
them: coordinates are single precision, differences of two coordinates are
taken in single precision, everything after that in double precision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the domain grid (must stay equal for identical results):
# NYC box east/west longitude -73.7 / -74.05, north/south latitude 41.0 / 40.5,
# cell size 0.0014 deg longitude x 0.00125 deg latitude, 250 cells per grid row,
# 400 grid rows, 110.25 km per degree.
LON_EAST = -73.7
LON_WEST = -74.05
LAT_NORTH = 41.0
LAT_SOUTH = 40.5
DELTA_LON = 0.0014
DELTA_LAT = 0.00125
GRID_X = 250
GRID_Y = 400
DEG_LEN = 110.25


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _f32(x) -> Column:
    return _c(x).cast("float")


def _f64(x) -> Column:
    return _c(x).cast("double")


INT_MAX, INT_MIN = 2147483647, -2147483648


def java_int(x) -> Column:
    """Double -> int the way a Java ``(int)`` narrowing does: truncation toward
    zero, NaN -> 0, saturation at the int range.  (A plain cast fails on NaN
    or overflow under ANSI mode.)"""
    c = _f64(x)
    return (F.when(F.isnan(c), F.lit(0))
            .when(c >= F.lit(float(INT_MAX)), F.lit(INT_MAX))
            .when(c <= F.lit(float(INT_MIN)), F.lit(INT_MIN))
            .otherwise(c.cast("int")))


def in_nyc(lon, lat) -> Column:
    """True when the point lies in the NYC box, bounds inclusive.

    Written as negated "outside" tests, so a NaN coordinate counts as inside
    (every comparison with NaN is false in the reference's arithmetic).  Spark
    orders NaN above all numbers, so NaN is tested explicitly.
    """
    lon, lat = _f64(_f32(lon)), _f64(_f32(lat))
    lon_out = ~F.isnan(lon) & ((lon > F.lit(LON_EAST)) | (lon < F.lit(LON_WEST)))
    lat_out = ~F.isnan(lat) & ((lat > F.lit(LAT_NORTH)) | (lat < F.lit(LAT_SOUTH)))
    return ~lon_out & ~lat_out


def grid_x(lon) -> Column:
    return java_int(F.floor((F.lit(abs(LON_WEST)) - _f64(F.abs(_f32(lon)))) / F.lit(DELTA_LON)))


def grid_y(lat) -> Column:
    return java_int(F.floor((F.lit(LAT_NORTH) - _f64(_f32(lat))) / F.lit(DELTA_LAT)))


def cell_id(lon, lat) -> Column:
    """Grid cell of a point: x + y * 250, counted from the north-west corner."""
    return grid_x(lon) + grid_y(lat) * F.lit(GRID_X)


def cell_center_lon(cell) -> Column:
    # Integer remainder keeps the sign of the dividend, as ``%`` does in Spark.
    x = _c(cell).cast("int") % F.lit(GRID_X)
    v = (F.lit(abs(LON_WEST)) - x * F.lit(DELTA_LON) - F.lit(DELTA_LON / 2)).cast("float")
    return (v * F.lit(-1.0).cast("float")).cast("float")


def cell_center_lat(cell) -> Column:
    c = _c(cell).cast("int")
    x = c % F.lit(GRID_X)
    y = ((c - x) / F.lit(GRID_X)).cast("int")
    return (F.lit(LAT_NORTH) - y * F.lit(DELTA_LAT) - F.lit(DELTA_LAT / 2)).cast("float")


def euclidean_distance(lon1, lat1, lon2, lat2) -> Column:
    """Planar distance in km: 110.25 * sqrt(dlat^2 + (dlon * cos(lat2))^2).

    ``lat2`` (degrees) is passed to cos as radians, which is what the domain
    formula does; the differences are taken in single precision.
    """
    x = _f64(_f32(lat1) - _f32(lat2))
    y = _f64(_f32(lon1) - _f32(lon2)) * F.cos(_f64(_f32(lat2)))
    return F.lit(DEG_LEN) * F.sqrt(x * x + y * y)


def event_distance(lon, lat) -> Column:
    """Distance from a point to the place of a ride event: where the ride starts for a START event, where it ends for
    an END event (columns of a ride record)."""
    at_start = F.col("is_start")
    return euclidean_distance(lon, lat, F.when(at_start, F.col("start_lon")).otherwise(F.col("end_lon")),
                              F.when(at_start, F.col("start_lat")).otherwise(F.col("end_lat")))


def direction_angle(start_lon, start_lat, dest_lon, dest_lat) -> Column:
    """Integer direction from start to destination, range -1..359.

    ``int(degrees(atan2(dlat, dlon * cos(start_lat)))) + 179`` with the same
    radians-as-degrees cosine as the distance.  East 359, south 89, west 179,
    north 269 for NYC points.
    """
    x = _f64(_f32(dest_lat) - _f32(start_lat))
    cos_lat = F.cos(_f64(_f32(start_lat)))
    y = _f64(_f32(dest_lon) - _f32(start_lon)) * cos_lat
    # Spark's atan2 turns -0.0 into +0.0; IEEE atan2(+0, -0) is 180 degrees.  A
    # zero-length move has y = +0 * cos, i.e. -0.0 whenever the cosine is negative.
    neg_zero = (x == 0) & (y == 0) & (cos_lat < 0)
    return F.when(neg_zero, F.lit(180 + 179)).otherwise(java_int(F.degrees(F.atan2(x, y))) + F.lit(179))


def direction_bucket(angle) -> Column:
    """One of 8 buckets of 45 degrees; integer division truncates -1 to 0."""
    return (_c(angle) / F.lit(45)).cast("int")


def time_diff_ms(first, second) -> Column:
    """Milliseconds from ``first`` to ``second`` (timestamps)."""
    return F.unix_millis(_c(second)) - F.unix_millis(_c(first))


def register_sql_functions(spark) -> None:
    """Expose the scalar functions to SQL as SQL-bodied temporary functions.

    Catalyst inlines SQL functions, so ``SELECT is_in_nyc(lon, lat)`` compiles
    to the same code as the Column form.
    """
    stmts = [
        f"""CREATE OR REPLACE TEMPORARY FUNCTION is_in_nyc(lon FLOAT, lat FLOAT) RETURNS BOOLEAN
            RETURN NOT (NOT isnan(lon) AND (lon > {LON_EAST} OR lon < {LON_WEST}))
               AND NOT (NOT isnan(lat) AND (lat > {LAT_NORTH} OR lat < {LAT_SOUTH}))""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION to_cell_id(lon FLOAT, lat FLOAT) RETURNS INT
            RETURN CAST(floor(({abs(LON_WEST)}D - CAST(abs(lon) AS DOUBLE)) / {DELTA_LON}D) AS INT)
                 + CAST(floor(({LAT_NORTH}D - CAST(lat AS DOUBLE)) / {DELTA_LAT}D) AS INT) * {GRID_X}""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION to_coords(cell INT)
            RETURNS STRUCT<lon: FLOAT, lat: FLOAT>
            RETURN named_struct(
              'lon', CAST(CAST({abs(LON_WEST)}D - (cell % {GRID_X}) * {DELTA_LON}D - {DELTA_LON / 2}D AS FLOAT)
                          * CAST(-1.0 AS FLOAT) AS FLOAT),
              'lat', CAST({LAT_NORTH}D - CAST((cell - cell % {GRID_X}) / {GRID_X} AS INT) * {DELTA_LAT}D
                          - {DELTA_LAT / 2}D AS FLOAT))""",
        """CREATE OR REPLACE TEMPORARY FUNCTION time_diff_ms(first TIMESTAMP, second TIMESTAMP) RETURNS BIGINT
            RETURN unix_millis(second) - unix_millis(first)""",
    ]
    for s in stmts:
        spark.sql(s)
