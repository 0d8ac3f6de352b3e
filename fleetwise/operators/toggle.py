"""Control elements applied to all keyed toggle state.

Keyed elements toggle a per-key flag (the first sets it, the second clears
it, ...).  Every control element is emitted once for each key whose flag is
set at the control's event time, i.e. keys with an odd number of elements at
or before that time.

Control elements may be any number.  ``apply_controls`` needs no range
join: see its docstring.  ``toggle_intervals`` gives the
"flag on" intervals per key for other uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.operators.asof import asof_numeric
from fleetwise.operators.scan import carry_last, running_agg


def toggle_intervals(keyed: DataFrame, key: str = "key", time: str = "time", bucket_us: int | None = None) -> DataFrame:
    """(key, on_from, on_until) in epoch micros; ``on_until`` null = open end."""
    per_t = keyed.groupBy(F.col(key).alias("key"), F.unix_micros(F.col(time)).alias("t")).agg(
        F.count(F.lit(1)).alias("n"))
    run = running_agg(per_t, ["key"], [F.col("t")], F.col("n"), "cnt",
                      F.floor(F.col("t") / F.lit(bucket_us)) if bucket_us else None)
    # next element time of the key: the last time seen scanning backwards, exclusive
    run = carry_last(run, ["key"], [-F.col("t")], F.col("t"), "on_until",
                     F.floor(-F.col("t") / F.lit(bucket_us)) if bucket_us else None, inclusive=False)
    return run.where(F.col("cnt") % 2 == 1).select("key", F.col("t").alias("on_from"), "on_until")


def apply_controls(keyed: DataFrame, controls: DataFrame, key: str = "key", time: str = "time",
                   control_time: str = "time", control_value: str = "value") -> DataFrame:
    """(control_time, control_value, key) for each control and each key whose
    flag is set at the control's time.

    Output-sensitive and join-free apart from equi-joins: controls are
    numbered in time order; every element gets the number of the first
    control at or after it (a global as-of scan); counts per (key, control
    epoch) and their running sum give each key's flag per epoch; every
    stretch of epochs with the flag set is exploded into exactly the output
    rows, which are equi-joined to the control values.
    """
    n = controls.count()
    if n == 0:
        return keyed.sparkSession.createDataFrame([], "control_time timestamp, control_value bigint, key bigint")
    ctl = controls.select(F.unix_micros(F.col(control_time)).alias("_ct"), F.col(control_time).alias("control_time"),
                          F.col(control_value).alias("control_value"))
    # number controls 0..n-1 in time order, with the scan that spreads a long list
    ctl = running_agg(ctl, [], [F.col("_ct"), F.col("control_value")], F.lit(1), "_i", fn="count").withColumn("_i", F.col("_i") - 1)
    el = keyed.select(F.col(key).alias("key"), F.unix_micros(F.col(time)).alias("_t"))
    # an element counts for the first control at or after it (n: after the last control)
    ep = asof_numeric(el, ctl.select("_ct", "_i"), [], "_t", "_ct", ["_i"], forward=True)
    ep = ep.select("key", F.coalesce(F.col("_i"), F.lit(n)).alias("_i"))
    per = ep.groupBy("key", "_i").agg(F.count(F.lit(1)).alias("_n"))
    per = running_agg(per, ["key"], [F.col("_i")], F.col("_n"), "_cnt")
    per = carry_last(per, ["key"], [-F.col("_i")], F.col("_i"), "_next", inclusive=False)
    on = per.where(F.col("_cnt") % 2 == 1)
    first = F.col("_i")
    last = F.coalesce(F.col("_next"), F.lit(n)) - 1
    rows = on.select("key", F.explode(F.when(last >= first, F.sequence(first, last))).alias("_i"))
    return rows.join(ctl.select("_i", "control_time", "control_value"), "_i").select(
        "control_time", "control_value", "key")
