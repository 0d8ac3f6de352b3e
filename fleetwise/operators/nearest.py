"""Nearest taxi for each call, exact, by a spatial tree over the taxis.

The tree is a quadtree on Z-order prefixes, four cells by four at a step.  A
cell is split while it holds more than ``TAXIS_PER_LEAF`` positions, so crowded
areas get small cells and empty ones none; a taxi far from all others is a cell
of its own and widens no other.  Every node holds the bounds of the positions
below it (not of its cell) and the least and greatest |cos(latitude)| of them,
by which the distance scales their longitude difference.  So its distance
bounds hold for its own band of latitudes: a taxi where the cosine vanishes
weakens the bound of its own small cells only.

Calls descend the tree together, one equi-join with the next level's nodes a
step: from the (at most ``TOP_NODES``) uppermost nodes, which are literals of
the plan, through every node whose least possible distance is not beyond the
least of the greatest possible ones seen for the call, down to the taxis.  A
call meets a few nodes a level, whatever the fleet's size or shape; there is
no pass over all pairs and no key that all rows share.  Levels of few nodes
are broadcast by their measured size, the others shuffled.

Taxis at equal positions are one (the lowest id answers).  Rows that repeat a
call id are calls of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwise.functions.geo import DEG_LEN, euclidean_distance
from fleetwise.session import stored

TAXIS_PER_LEAF = 16
TOP_NODES = 64
STEPS = 12  # four bits of Z-order each: cells of 360 / 2^24 degrees at the deepest
# float32 differences may be off by a few ulps
_LESS, _MORE = 1 - 1e-6, 1 + 1e-6


def _single(c) -> Column:
    """The single-precision value the distance is computed from, as a double."""
    return F.col(c).cast("float").cast("double")


def _finite(*columns: str) -> Column:
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    return ok


def z_order(lon: Column, lat: Column) -> Column:
    """Interleaved bits (2 * 24) of the position on the globe; positions off it go to its edge."""
    def bits(x: Column, low: float, high: float) -> Column:
        cell = F.least(F.greatest(F.floor((x - low) / (high - low) * (1 << 24)), F.lit(0)), F.lit((1 << 24) - 1))
        return cell.cast("long")

    def spread(v: Column) -> Column:
        """One zero bit above each of the 24 bits."""
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                            (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(bits(lat, -90.0, 90.0)), 1).bitwiseOR(spread(bits(lon, -180.0, 180.0)))


def _node(z: Column, step: int) -> Column:
    """Name of the cell at a step: a leading 1 before its prefix, so that names of different steps differ."""
    return F.shiftright(z, 4 * (STEPS - step)).bitwiseOR(F.lit(1 << (4 * step)))


_BOX = ["la0", "la1", "lo0", "lo1", "c0", "c1"]


def _nodes(places: DataFrame) -> DataFrame:
    """The tree: node, parent, step, bounds, and whether it is a leaf.  Only nodes below split ones are kept."""
    cos = F.abs(F.cos("lat"))
    each = places.select("lat", "lon", F.explode(F.array(*[
        F.struct(F.lit(s).alias("step"), _node(F.col("z"), s).alias("node")) for s in range(STEPS + 1)])).alias("at"))
    every = each.groupBy("at.node", "at.step").agg(
        F.count(F.lit(1)).alias("n"), F.min("lat").alias("la0"), F.max("lat").alias("la1"),
        F.min("lon").alias("lo0"), F.max("lon").alias("lo1"), F.min(cos).alias("c0"), F.max(cos).alias("c1"))
    every = stored(every.withColumn("parent", F.shiftright("node", 4)), "nodes")
    split = every.where((F.col("n") > TAXIS_PER_LEAF) & (F.col("step") < STEPS)).select(F.col("node").alias("parent"))
    below = every.join(split, "parent", "left_semi").unionByName(every.where(F.col("step") == 0))
    return stored(below.withColumn("leaf", (F.col("n") <= TAXIS_PER_LEAF) | (F.col("step") == STEPS)), "tree")


def _bounds() -> tuple[Column, Column]:
    """Least and greatest possible distance of the call to a taxi of the node."""
    la0, la1, lo0, lo1, c0, c1 = map(F.col, _BOX)
    x, y = F.col("_lat"), F.col("_lon")
    zero = F.lit(0.0)
    near = F.sqrt(F.pow(F.greatest(la0 - x, x - la1, zero), F.lit(2)) + F.pow(F.greatest(lo0 - y, y - lo1, zero) * c0, F.lit(2)))
    far = F.sqrt(F.pow(F.greatest(la1 - x, x - la0), F.lit(2)) + F.pow(F.greatest(lo1 - y, y - lo0) * c1, F.lit(2)))
    return near * (DEG_LEN * _LESS), far * (DEG_LEN * _MORE)


def _measured(met: DataFrame) -> DataFrame:
    near, far = _bounds()
    return met.select("_call", "_lat", "_lon", "node", "leaf", near.alias("_near"), far.alias("_far"))


def _pruned(met: DataFrame) -> DataFrame:
    """What may hold the call's nearest taxi."""
    best = F.min("_far").over(Window.partitionBy("_call"))
    return met.withColumn("_best", best).where(F.col("_near") <= F.col("_best")).drop("_best")


def candidates(calls: DataFrame, places: DataFrame) -> DataFrame | None:
    """(call, position) pairs that are left to compare: ``calls(_call, _lon, _lat)``, ``places(lon, lat, z, ...)``.
    None without positions."""
    tree = _nodes(places)
    counts = {r["step"]: (r["n"], r["leaves"]) for r in tree.groupBy("step").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("leaf").alias("leaves")).collect()}
    if not counts:
        return None
    # the deepest step that has, with the leaves above it, few enough nodes
    top, above = 0, 0
    for step in sorted(counts):
        if above + counts[step][0] <= TOP_NODES:
            top = step
        above += counts[step][1]
    start = tree.where((F.col("step") == top) | (F.col("leaf") & (F.col("step") < top))).select("node", "leaf", *_BOX).collect()
    first = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in r.asDict().items()]) for r in start])
    open_ = _pruned(_measured(calls.select("*", F.inline(first))))
    for step in range(top + 1, max(counts) + 1):
        children = tree.where(F.col("step") == step).select(F.col("parent").alias("_parent"), "node", "leaf", *_BOX)
        down = open_.where(~F.col("leaf")).select("_call", "_lat", "_lon", F.col("node").alias("_parent")).join(children, "_parent")
        # leaves met before count for the bound, and go when it falls below them
        open_ = _pruned(open_.where("leaf").unionByName(_measured(down)))
    # a position lies in one leaf: of the names of its cells at all steps, one is in the tree as a leaf
    held = places.select("*", F.explode(F.array(*[_node(F.col("z"), s) for s in range(STEPS + 1)])).alias("node")).join(
        tree.where("leaf").select("node"), "node")
    return open_.select("_call", "_lat", "_lon", "node").join(held, "node").drop("node")


def nearest_taxi(calls: DataFrame, taxis: DataFrame) -> DataFrame:
    """``calls(call_id, longitude, latitude, ...)`` x ``taxis(taxi_id, longitude,
    latitude, ...)`` -> one row per call that has a nearest taxi: the call's
    columns, ``distance``, ``taxi_id`` and ``taxi_*`` columns.  Ties go to the lowest
    taxi id.  Calls and taxis whose coordinates are null or not finite have no
    position.
    """
    t = taxis.select("taxi_id", *[F.col(c).alias("taxi_" + c) for c in taxis.columns if c != "taxi_id"])
    t = t.where(_finite("taxi_longitude", "taxi_latitude"))
    places = (t.groupBy(_single("taxi_longitude").alias("lon"), _single("taxi_latitude").alias("lat"))
              .agg(F.min_by(F.struct(*t.columns), "taxi_id").alias("_taxi")))
    places = stored(places.withColumn("z", z_order(F.col("lon"), F.col("lat"))), "positions")
    rows = stored(calls.withColumn("_call", F.monotonically_increasing_id()), "calls")
    asked = rows.where(_finite("longitude", "latitude")).select("_call", _single("longitude").alias("_lon"), _single("latitude").alias("_lat"))
    pairs = candidates(asked, places)
    if pairs is None:
        none = [F.lit(None).cast("double").alias("distance"), *[F.lit(None).cast(t.schema[c].dataType).alias(c) for c in t.columns]]
        return calls.select("*", *none).where(F.lit(False))
    pairs = pairs.select("_call", euclidean_distance(F.col("_lon"), F.col("_lat"), F.col("lon"), F.col("lat")).alias("distance"), "_taxi")
    best = pairs.groupBy("_call").agg(F.min_by(F.struct("distance", "_taxi"), F.struct("distance", "_taxi.taxi_id")).alias("_b"))
    return rows.join(best, "_call").select(*[rows[c] for c in calls.columns], "_b.distance", "_b._taxi.*")
