"""Route traffic: the grid cells a straight path crosses, counted per cell.

The cell walk is a small data-dependent loop per row.  It runs on Arrow
batches in which numpy advances *all* live rows of a batch one step at a time
(finished rows leave the working set), so the Python cost is per step of the
longest path in the batch, not per row.  ``route_traffic`` reduces each batch
to (cell, count) pairs inside the task and Spark sums them per cell;
``route_cells`` is the per-row Column form (an array of cell ids).

Walk rule (``strict=False`` keeps the domain's behaviour): endpoints are
ordered by x, slope = dy / (dx + 1e-8); from the start cell step while
``x < end x or y != end y``:

* slope > 0: y* = (x - x0 + 0.5) * slope + y0 - 0.5; |y* - y| < 0.05 -> step
  x+1, y+1; else y* < y -> x+1; else y+1.
* slope <= 0: y* = (x - x0 + 0.5) * slope + y0 + 0.5; |y* - y| < 0.05 -> step
  x+1, y-1, and then (not "else") y* > y -> x+1 else y-1, a double step that
  can skip the end cell.  ``strict=True`` makes the second test an "else".
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from fleetwise.functions import geo
from fleetwise.session import spread_if_narrow


def _grid(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lon32 = lon.astype(np.float32)
    lat32 = lat.astype(np.float32)
    x = np.floor((abs(geo.LON_WEST) - np.abs(lon32).astype(np.float64)) / geo.DELTA_LON)
    y = np.floor((geo.LAT_NORTH - lat32.astype(np.float64)) / geo.DELTA_LAT)
    # a cast to an integer takes NaN to 0 and stops at the 32-bit limits
    x, y = (np.clip(np.nan_to_num(v, nan=0.0), -2.0 ** 31, 2.0 ** 31 - 1) for v in (x, y))
    return x.astype(np.int64), y.astype(np.int64)


def _walk(sx, sy, ex, ey, strict: bool):
    """Yield (row index array, cell id array) per step; rows leave the working
    set as soon as they reach their end cell."""
    slope = (ey - sy) / ((ex - sx) + 0.00000001)
    pos = slope > 0
    cx, cy = sx.copy(), sy.copy()
    idx = np.arange(len(sx))
    yield idx, cx + cy * geo.GRID_X
    limit = 4 * int(np.max(np.abs(ex - sx) + np.abs(ey - sy), initial=0)) + 16
    live = (cx < ex) | (cy != ey)
    it = 0
    while True:
        if not live.all():
            idx, sx, sy, ex, ey, slope, pos, cx, cy = (a[live] for a in (idx, sx, sy, ex, ey, slope, pos, cx, cy))
        if len(idx) == 0:
            return
        it += 1
        if it > limit:
            raise RuntimeError("route walk did not reach its end cell")
        base = (cx - sx + 0.5) * slope + sy
        yp = np.where(pos, base - 0.5, base + 0.5)
        diag = (yp > cy - 0.05) & (yp < cy + 0.05)
        # slope > 0
        px = np.where(diag | (yp < cy), cx + 1, cx)
        py = np.where(diag, cy + 1, np.where(yp < cy, cy, cy + 1))
        # slope <= 0
        dx, dy = cx + diag, cy - diag
        if strict:
            nx = np.where(diag, dx, np.where(yp > cy, cx + 1, cx))
            ny = np.where(diag, dy, np.where(yp > cy, cy, cy - 1))
        else:
            nx = np.where(yp > dy, dx + 1, dx)
            ny = np.where(yp > dy, dy, dy - 1)
        cx = np.where(pos, px, nx)
        cy = np.where(pos, py, ny)
        yield idx, cx + cy * geo.GRID_X
        live = (cx < ex) | (cy != ey)


def _endpoints(lon1, lat1, lon2, lat2):
    lon1, lat1, lon2, lat2 = (np.asarray(a, dtype=np.float64) for a in (lon1, lat1, lon2, lat2))
    x1, y1 = _grid(lon1, lat1)
    x2, y2 = _grid(lon2, lat2)
    swap = x1 > x2
    return (np.where(swap, x2, x1), np.where(swap, y2, y1), np.where(swap, x1, x2), np.where(swap, y1, y2))


def walk_cells(lon1, lat1, lon2, lat2, strict: bool = False) -> list[np.ndarray]:
    """Cell ids along each path (vectorised over rows)."""
    n = len(lon1)
    idx_parts, cell_parts = [], []
    for idx, cells in _walk(*_endpoints(lon1, lat1, lon2, lat2), strict):
        idx_parts.append(idx)
        cell_parts.append(cells)
    if n == 0:
        return []
    idx = np.concatenate(idx_parts)
    cells = np.concatenate(cell_parts).astype(np.int32)
    order = np.argsort(idx, kind="stable")  # steps were appended in walk order
    counts = np.bincount(idx, minlength=n)
    return np.split(cells[order], np.cumsum(counts)[:-1])


def cell_counts(lon1, lat1, lon2, lat2, strict: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(distinct cell ids, number of paths crossing each) for a batch of paths."""
    if len(lon1) == 0:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    cells = np.concatenate([c for _, c in _walk(*_endpoints(lon1, lat1, lon2, lat2), strict)])
    u, c = np.unique(cells, return_counts=True)
    return u.astype(np.int32), c.astype(np.int64)


def _cells_udf(strict: bool):
    @F.pandas_udf(ArrayType(IntegerType()))
    def cells(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
        return pd.Series(walk_cells(lon1.to_numpy(), lat1.to_numpy(), lon2.to_numpy(), lat2.to_numpy(), strict))
    return cells


def route_cells(lon1, lat1, lon2, lat2, strict: bool = False) -> Column:
    """Column: array of cell ids on the straight path between two points."""
    c = lambda v: F.col(v) if isinstance(v, str) else v
    return _cells_udf(strict)(c(lon1).cast("float"), c(lat1).cast("float"), c(lon2).cast("float"),
                              c(lat2).cast("float"))


def route_traffic(rides: DataFrame, strict: bool = False) -> DataFrame:
    """START rides inside NYC: number of ride paths crossing each cell.

    Each Arrow batch is walked in numpy and reduced to (cell, count) pairs in
    the task (map-side combine), so only distinct cells per batch reach the
    shuffle; Spark sums them per cell.  The walk is CPU-bound, so a scan with
    fewer partitions than cores is spread round-robin first.
    """
    s = rides.where(F.col("is_start") & geo.in_nyc("start_lon", "start_lat") & geo.in_nyc("end_lon", "end_lat"))
    s = s.select(*[F.col(c).cast("float").alias(c) for c in ("start_lon", "start_lat", "end_lon", "end_lat")])
    s = spread_if_narrow(s)

    def per_batch(batches):
        for pdf in batches:
            u, c = cell_counts(pdf["start_lon"].to_numpy(), pdf["start_lat"].to_numpy(),
                               pdf["end_lon"].to_numpy(), pdf["end_lat"].to_numpy(), strict)
            yield pd.DataFrame({"cell_id": u, "n": c})

    partial = s.mapInPandas(per_batch, "cell_id int, n long")
    return partial.groupBy("cell_id").agg(F.sum("n").alias("n_passes"))
