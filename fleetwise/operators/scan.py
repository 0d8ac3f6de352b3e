"""Skew-safe ordered scans (running "last value" and running aggregates).

A window ``partitionBy(key).orderBy(t)`` sends every row of a key to one task;
a key holding a third of the data then runs on one core.  These helpers split
each key's timeline into buckets of the ordering column and scan in two
levels:

1. inside each (key, bucket) a normal running window - many small tasks;
2. a per-(key, bucket) summary (one row per bucket, partial aggregation before
   the shuffle) is scanned over buckets to get the value carried into each
   bucket from all earlier ones; it is joined back on (key, bucket), which is
   already the partitioning of step 1, so only the small summary moves.

With no key the same code gives a global scan that is still spread over
buckets instead of a single partition.

Buckets are chosen from the number of rows of each key: a key with more than
``TARGET_ROWS`` rows is cut at quantiles of its ordering values, so that a
burst is spread too; a smaller key stays in one bucket.  When no key exceeds
the target, the scan is a plain window and steps 2-3 are skipped; rows are the
same either way, null keys and null ordering values included.  An explicit
``bucket`` column overrides the adaptive choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


TARGET_ROWS = 1 << 20


CUTS = 64  # quantile ranges per large key, each cut evenly where it holds more than a bucket


def _same_keys(a: DataFrame, b: DataFrame, names: dict[str, str]) -> Column:
    """Null-safe equality of columns of ``a`` and ``b``: a null key is a key."""
    cond = F.lit(True)
    for x, y in names.items():
        cond = cond & a[x].eqNullSafe(b[y])
    return cond


_STEP = 8  # every so many-th quantile is looked at first


def _at_or_below(v: Column, cuts: Column, first: Column | int, step: int) -> Column:
    """How many of up to ``_STEP`` quantiles, from ``first`` on every ``step``-th, are at or below ``v``."""
    return sum((F.when(F.get(cuts, first + F.lit(i * step)) <= v, 1).otherwise(0) for i in range(_STEP)), F.lit(0))


def _with_range(df: DataFrame, o: Column) -> DataFrame:
    """Add ``_q``: how many of the ascending quantiles ``_cuts`` (null: none known) are at or below ``o``.  Compiled
    comparisons in two steps; a higher-order function over the array is interpreted and costs several times the scan."""
    v, cuts = o.cast("double"), F.col("_cuts")
    df = df.withColumn("_q", _at_or_below(v, cuts, F.lit(_STEP - 1), _STEP))
    return df.withColumn("_q", F.col("_q") * _STEP + _at_or_below(v, cuts, F.col("_q") * _STEP, 1))


def _bucket_of(o: Column, cuts: Column, q: Column, n: Column, target: int) -> Column:
    """Bucket number of ordering value ``o`` from the quantiles ``cuts`` of a
    key with ``n`` rows: the quantile range ``q``, then equal parts of it, so that
    bursts and far outliers share no bucket.  Nulls come first, as in a sort."""
    parts = F.ceil(n / F.lit(float(target * CUTS)))
    v = o.cast("double")
    low, high = F.get(cuts, q - 1), F.get(cuts, q)
    part = F.when(high > low, F.floor((v - low) / (high - low) * parts)).otherwise(F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.coalesce(part, F.lit(0)), parts - 1))
    return F.when(o.isNull(), F.lit(-1)).otherwise(q * parts + part).cast("bigint")


def _bucketed(df: DataFrame, keys: list[str], order: list, bucket: Column | None,
              target: int | None) -> tuple[DataFrame, bool]:
    """(frame with ``_bkt``, whether a single bucket per key suffices)."""
    target = target or TARGET_ROWS  # read at call time
    if bucket is not None:
        return df.withColumn("_bkt", bucket), False
    o = order[0]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_on"))
    biggest = counts.agg(F.max("_on")).first()[0]
    if not biggest or biggest <= target:
        return df.withColumn("_bkt", F.lit(0)), True
    # large keys only: at most rows / target of them; the planner broadcasts them where their size allows it
    large = counts.where(F.col("_on") > target).select(*[F.col(k).alias("_s_" + k) for k in keys])
    some = df.join(large, _same_keys(df, large, {k: "_s_" + k for k in keys}), "left_semi") if keys else df
    shares = [i / CUTS for i in range(CUTS + 1)]
    st = some.groupBy(*keys).agg(F.percentile_approx(o.cast("double"), shares, 1000).alias("_cuts"),
                                 F.count(F.lit(1)).alias("_on"))
    st = st.select(*[F.col(k).alias("_s_" + k) for k in keys], "_cuts", "_on")
    if keys:
        j = df.join(st, _same_keys(df, st, {k: "_s_" + k for k in keys}), "left")
    else:
        cuts, n = st.first()
        j = df.withColumns({"_cuts": F.lit(cuts) if cuts else F.lit(None).cast("array<double>"), "_on": F.lit(n)})
    j = _with_range(j, o)
    bkt = F.when(F.col("_on").isNull(), F.lit(0)).otherwise(_bucket_of(o, F.col("_cuts"), F.col("_q"), F.col("_on"), target))
    return j.withColumn("_bkt", bkt).drop("_cuts", "_q", "_on", *["_s_" + k for k in keys]), False


def _with_carry(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``carry`` for their (key, bucket)."""
    names = {k: f"_c_{k}" for k in [*keys, "_bkt"]}
    c = carry.withColumnsRenamed(names)
    return rows.join(c, _same_keys(rows, c, names), "left").drop(*names.values())


def carry_last(df: DataFrame, keys: list[str], order: list, value: Column, out: str, bucket: Column | None = None,
               inclusive: bool = True, target: int | None = None) -> DataFrame:
    """Add ``out`` = last non-null ``value`` at or before each row (``inclusive``)
    or strictly before it, in ``order`` within ``keys``.

    The first ordering column must be numeric (buckets are ranges of it); an
    explicit ``bucket`` must be non-decreasing in ``order``.
    """
    b, single = _bucketed(df, keys, order, bucket, target)
    b = b.withColumn("_val", value)
    end = 0 if inclusive else -1
    if single:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        return b.withColumn(out, F.last("_val", ignorenulls=True).over(w)).drop("_bkt", "_val")
    w_in = Window.partitionBy(*keys, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    b = b.withColumn("_loc", F.last("_val", ignorenulls=True).over(w_in))
    ordkey = F.struct(*order)
    summary = (b.groupBy(*keys, "_bkt")
               .agg(F.max_by(F.col("_val"), F.when(F.col("_val").isNotNull(), ordkey)).alias("_blast")))
    w_b = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, "_bkt", F.last("_blast", ignorenulls=True).over(w_b).alias("_carry"))
    j = _with_carry(b, carry, keys)
    return j.withColumn(out, F.coalesce("_loc", "_carry")).drop("_bkt", "_val", "_loc", "_carry")


_AGG = {"sum": (F.sum, F.sum), "max": (F.max, F.max), "min": (F.min, F.min), "count": (F.count, F.sum)}


def running_aggs(df: DataFrame, keys: list[str], order: list, specs: list[tuple[Column, str, str]],
                 bucket: Column | None = None, inclusive: bool = True, target: int | None = None) -> DataFrame:
    """Several running aggregates over the same keys and order in one pass:
    ``specs`` is a list of (value, output column, fn) with fn one of sum, max,
    min, count.  Each output covers rows at or before the row (strictly
    before when not ``inclusive``)."""
    b, single = _bucketed(df, keys, order, bucket, target)
    for i, (value, _, _) in enumerate(specs):
        b = b.withColumn(f"_val{i}", value)
    end = 0 if inclusive else -1
    if single:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        for i, (_, out, fn) in enumerate(specs):
            res = _AGG[fn][0](f"_val{i}").over(w)
            if fn == "sum":
                res = F.coalesce(res, F.lit(0))
            b = b.withColumn(out, res)
        return b.drop("_bkt", *[f"_val{i}" for i in range(len(specs))])
    w_in = Window.partitionBy(*keys, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    for i, (_, _, fn) in enumerate(specs):
        b = b.withColumn(f"_loc{i}", _AGG[fn][0](f"_val{i}").over(w_in))
    summary = b.groupBy(*keys, "_bkt").agg(*[_AGG[fn][0](f"_val{i}").alias(f"_btot{i}")
                                              for i, (_, _, fn) in enumerate(specs)])
    w_b = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, "_bkt", *[_AGG[fn][1](f"_btot{i}").over(w_b).alias(f"_carry{i}")
                                            for i, (_, _, fn) in enumerate(specs)])
    j = _with_carry(b, carry, keys)
    drops = ["_bkt"]
    for i, (_, out, fn) in enumerate(specs):
        loc, car = F.col(f"_loc{i}"), F.col(f"_carry{i}")
        if fn in ("sum", "count"):
            res = F.coalesce(loc, F.lit(0)) + F.coalesce(car, F.lit(0))
            if fn == "count":
                res = res.cast("bigint")
        else:
            res = (F.greatest if fn == "max" else F.least)(loc, car)  # greatest/least skip nulls
        j = j.withColumn(out, res)
        drops += [f"_val{i}", f"_loc{i}", f"_carry{i}"]
    return j.drop(*drops)


def running_agg(df: DataFrame, keys: list[str], order: list, value: Column, out: str, bucket: Column | None = None,
                fn: str = "sum", inclusive: bool = True, target: int | None = None) -> DataFrame:
    """Add ``out`` = running ``fn`` (sum, max, min, count) of ``value`` over rows
    at or before each row (strictly before when not ``inclusive``)."""
    return running_aggs(df, keys, order, [(value, out, fn)], bucket, inclusive, target)


def sessionize(df: DataFrame, keys: list[str], time: Column, tiebreak: list, gap, out: str = "sid") -> DataFrame:
    """Add ``out`` = start of each row's session per key: a session ends when
    more than ``gap`` (in the units of ``time``, numeric) passes without a row;
    a pause of exactly ``gap`` stays in the session.  Two carry scans (the
    previous time, then the latest session start), so a key with a third of
    the rows is split over buckets instead of being merged in one task."""
    order = [F.col("_st"), *tiebreak]
    e = df.withColumn("_st", time)
    e = carry_last(e, keys, order, F.col("_st"), "_prev", inclusive=False)
    new = F.when(F.col("_prev").isNull() | (F.col("_st") - F.col("_prev") > F.lit(gap)), F.col("_st"))
    e = carry_last(e, keys, order, new, out)
    return e.drop("_prev", "_st")
