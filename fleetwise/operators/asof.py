"""As-of (point-in-time) left join: each left row gets the latest right row
of the same key whose time is at or before the left row's time.

Both sides are stacked into one frame, ordered by (time, side) with right rows
first on equal times, and the last right row is carried forward with the
skew-safe two-level scan of :mod:`fleetwise.operators.scan`.  No pairs are
formed, so the cost is linear in the input and a hot key is spread over its
time buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.operators.scan import carry_last



def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
              right_cols: list[str], bucket_ms: int | None = None, right_order: list[str] | None = None) -> DataFrame:
    """Left rows with ``right_cols`` of the matching right row (null when none).

    Times are timestamps.  ``right_order`` breaks ties between right rows with
    equal time (default: the right columns themselves, so results are
    deterministic).
    """
    right_order = right_order or right_cols
    lcols = [c for c in left.columns]
    r_struct = F.struct(*[F.col(c) for c in right_cols])
    l = left.select(F.col(key).alias("_k"), F.unix_micros(F.col(left_time)).alias("_t"), F.lit(1).alias("_side"),
                    F.struct(*[F.col(c) for c in lcols]).alias("_l"), F.lit(None).cast(
                        right.select(r_struct.alias("s")).schema["s"].dataType).alias("_r"),
                    *[F.lit(None).cast(right.schema[c].dataType).alias("_o_" + c) for c in right_order])
    r = right.select(F.col(key).alias("_k"), F.unix_micros(F.col(right_time)).alias("_t"), F.lit(0).alias("_side"),
                     F.lit(None).cast(left.select(F.struct(*lcols).alias("s")).schema["s"].dataType).alias("_l"),
                     r_struct.alias("_r"), *[F.col(c).alias("_o_" + c) for c in right_order])
    u = l.unionByName(r)
    order = [F.col("_t"), F.col("_side")] + [F.col("_o_" + c) for c in right_order]
    bucket = F.floor(F.col("_t") / F.lit(bucket_ms * 1000)) if bucket_ms else None
    s = carry_last(u, ["_k"], order, F.col("_r"), "_match", bucket)
    out = s.where(F.col("_side") == 1).select("_l.*", *[F.col("_match." + c).alias(c) for c in right_cols])
    return out


def asof_numeric(left: DataFrame, right: DataFrame, keys: list[str], left_t: str, right_t: str,
                 payload: list[str], bucket_width: float | None = None, strict: bool = False,
                 forward: bool = False, out_prefix: str = "") -> DataFrame:
    """Numeric as-of lookup: every left row gets ``payload`` columns of the right
    row with the largest ``right_t <= left_t`` (``<`` when ``strict``) in the same
    ``keys``; with ``forward`` the smallest ``right_t >= left_t`` (``>``) instead.
    Ties between right rows on the order value go to the larger payload.
    """
    sign = -1 if forward else 1
    lcols = left.columns
    pl = F.struct(*[F.col(c) for c in payload])
    ptype = right.select(pl.alias("p")).schema["p"].dataType
    ltype = left.select(F.struct(*lcols).alias("s")).schema["s"].dataType
    # right rows sort before left rows on equal values unless the match is strict
    r_side, l_side = (1, 0) if strict else (0, 1)
    l = left.select(*[F.col(k).alias("_k_" + k) for k in keys], (F.col(left_t) * sign).alias("_t"),
                    F.lit(l_side).alias("_side"), F.struct(*lcols).alias("_l"), F.lit(None).cast(ptype).alias("_p"))
    r = right.select(*[F.col(k).alias("_k_" + k) for k in keys], (F.col(right_t) * sign).alias("_t"),
                     F.lit(r_side).alias("_side"), F.lit(None).cast(ltype).alias("_l"), pl.alias("_p"))
    u = l.unionByName(r)
    ks = ["_k_" + k for k in keys]
    bucket = F.floor(F.col("_t") / F.lit(bucket_width)) if bucket_width else None
    s = carry_last(u, ks, [F.col("_t"), F.col("_side"), F.col("_p")], F.col("_p"), "_m", bucket)
    return s.where(F.col("_side") == l_side).select(
        "_l.*", *[F.col("_m." + c).alias(out_prefix + c) for c in payload])
