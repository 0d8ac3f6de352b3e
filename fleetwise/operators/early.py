"""Windows with early results, in batch form over an event timeline.

Input is a *timeline*: rows ``seq, kind, time, key, value`` in arrival order
``seq``; ``kind`` is ``'E'`` for an element and ``'W'`` for a watermark whose
``time`` is the watermark value.  The watermark in force at a row is the
maximum of all earlier ``W`` times (event-time progress never goes back).
All ordered steps use the skew-safe scans of :mod:`fleetwise.operators.scan`
and :func:`fleetwise.operators.asof.asof_numeric`; nothing is gathered per
key or globally.

Early tumbling window (per key, size ``size_ms``):
  an element whose window end - 1 is at or below the watermark is late and
  dropped.  Every element whose time in whole seconds is even fires the
  window at once: (watermark, running sum up to that element).  Every window
  fires once more when the watermark first reaches its end - 1 (or at the
  end of input, watermark MAX): (that watermark, full sum).

Early session window (per key, gap ``gap_ms``, finish value ``finish``):
  a finish element schedules a firing for the first watermark at or past its
  time; the session's end schedules one at its end - 1.  A firing covers the
  session's elements that arrived before it and is emitted only if more
  elements arrived than at the session's previous firing.  The payload is the
  finish-ordered list: all non-finish values in arrival order, then the
  finish values.

A firing is *final* when the window end is at or below the watermark that
fired it, else *early*.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.operators.asof import asof_numeric
from fleetwise.operators.scan import carry_last, running_agg, running_aggs, sessionize
from fleetwise.session import stored

LONG_MIN = -9223372036854775808
LONG_MAX = 9223372036854775807


def with_watermark(timeline: DataFrame) -> DataFrame:
    """Add ``wm``: the watermark in force at each row (inclusive of a W row's own
    value; for an element it is the max over the earlier W rows).  A global
    running max, bucketed by arrival order when the timeline is large."""
    wv = F.when(F.col("kind") == "W", F.col("time"))
    return running_agg(timeline, [], [F.col("seq")], wv, "wm", fn="max")


def watermark_levels(tl: DataFrame) -> DataFrame:
    """Distinct watermark values with the arrival index that first reached each."""
    return tl.where(F.col("kind") == "W").groupBy(F.col("wm").alias("lvl")).agg(F.min("seq").alias("gseq"))


def _fire_lookup(df: DataFrame, thr: str, levels: DataFrame) -> DataFrame:
    """Add ``fired_at`` (first watermark >= thr, MAX at end of input) and ``g``
    (arrival index of that watermark, null = end of input)."""
    j = asof_numeric(df, levels, [], thr, "lvl", ["lvl", "gseq"], forward=True)
    return (j.withColumn("fired_at", F.coalesce(F.col("lvl"), F.lit(LONG_MAX)))
            .withColumnRenamed("gseq", "g").drop("lvl"))


def early_tumbling(timeline: DataFrame, size_ms: int) -> DataFrame:
    """Rows ``key, window_end, fired_at, total, is_final``.

    The watermarked timeline, its levels and the windows each feed several
    passes of the scans; each is written once to the shared checkpoint folder."""
    tl = stored(with_watermark(timeline), "timeline")
    levels = stored(watermark_levels(tl), "levels")
    e = tl.where(F.col("kind") == "E")
    e = e.withColumn("ws", F.floor(F.col("time") / F.lit(size_ms)).cast("bigint") * F.lit(size_ms)) \
         .withColumn("window_end", F.col("ws") + F.lit(size_ms))
    e = e.where(F.col("wm").isNull() | (F.col("window_end") - 1 > F.col("wm")))
    run = running_agg(e, ["key", "ws"], [F.col("seq")], F.col("value"), "total")
    even = F.floor(F.col("time") / F.lit(1000)) % 2 == 0
    early = run.where(even).select("key", "window_end", F.coalesce("wm", F.lit(LONG_MIN)).alias("fired_at"),
                                   "total", F.lit(False).alias("is_final"))
    fin = e.groupBy("key", "window_end").agg(F.sum("value").alias("total")) \
           .withColumn("thr", F.col("window_end") - 1)
    fin = _fire_lookup(stored(fin, "windows"), "thr", levels)
    fin = fin.select("key", "window_end", "fired_at", "total",
                     (F.col("window_end") <= F.col("fired_at")).alias("is_final"))
    return early.unionByName(fin)


def finish_ordered(values_by_seq, finish: int = 5):
    """Column: the finish-ordered list of an array of (seq, value) structs."""
    s = F.array_sort(values_by_seq)
    vals = F.transform(s, lambda x: x["value"])
    return F.concat(F.filter(vals, lambda v: v != F.lit(finish)), F.filter(vals, lambda v: v == F.lit(finish)))


def finish_ordered_rows(elements: DataFrame, gap_ms: int, finish: int = 5) -> DataFrame:
    """The finish-ordered list of every session in row form: ``key,
    session_start, session_end, position, value`` (position 1-based).

    Regular values take positions 1.. in arrival order, finish values follow.
    Positions come from running counts (skew-safe scans) and one per-session
    total; no session is gathered into a single row or task.
    """
    e = sessions(elements, gap_ms)
    fin = F.col("value") == F.lit(finish)
    e = running_aggs(e, ["key", "sid"], [F.col("seq")],
                     [(F.when(~fin, F.lit(1)), "_r", "count"), (F.when(fin, F.lit(1)), "_f", "count")])
    tot = e.groupBy("key", "sid").agg(F.sum(F.when(~fin, 1).otherwise(0)).alias("_nreg"),
                                      F.max("time").alias("_tmax"))
    e = e.join(tot, ["key", "sid"])
    pos = F.when(fin, F.col("_nreg") + F.col("_f")).otherwise(F.col("_r"))
    return e.select("key", F.col("sid").alias("session_start"), (F.col("_tmax") + F.lit(gap_ms)).alias("session_end"),
                    pos.alias("position"), "value")


def sessions(elements: DataFrame, gap_ms: int) -> DataFrame:
    """Add ``sid`` (session start time) per key: a new session starts when the
    time since the key's previous element is more than ``gap_ms``."""
    return sessionize(elements, ["key"], F.col("time"), [F.col("seq")], gap_ms)


FIRING = ["key", "sid", "g", "window_end", "fired_at", "n", "is_final"]


def session_firings(timeline: DataFrame, gap_ms: int, finish: int = 5) -> tuple[DataFrame, DataFrame]:
    """(firings, elements) of early-result session windows: a firing says when it came (``g``, ``fired_at``) and how
    many elements it covers (``n``, of them ``_nr`` regular and ``_nf`` finish), an element its running counts.

    The watermarked timeline and the ranked session elements feed several
    branches; each is written once to the shared checkpoint folder instead of
    being recomputed per branch (this also cuts the lineage for recovery).
    """
    tl = stored(with_watermark(timeline), "timeline")
    levels = watermark_levels(tl)
    e = tl.where((F.col("kind") == "E")
                 & (F.col("wm").isNull() | (F.col("time") + F.lit(gap_ms) - 1 > F.col("wm"))))
    # every scan reads its input twice, for the sizes of its keys and for its rows: what several steps made is stored
    e = stored(sessions(e, gap_ms), "session-elements")
    fin = F.col("value") == F.lit(finish)
    # running counts of regular and finish elements and latest time, by arrival within the session
    e = running_aggs(e, ["key", "sid"], [F.col("seq")],
                     [(F.when(~fin, F.lit(1)), "_r", "count"), (F.when(fin, F.lit(1)), "_f", "count"),
                      (F.col("time"), "_tmax", "max")])
    e = stored(e, "session-counts")
    # firing checks: finish elements and session ends
    fin_checks = e.where(fin).select(
        "key", "sid", F.greatest(F.col("time"), F.coalesce(F.col("wm") + 1, F.col("time"))).alias("thr"))
    end_checks = e.groupBy("key", "sid").agg((F.max("time") + F.lit(gap_ms) - 1).alias("thr"))
    checks = _fire_lookup(fin_checks.unionByName(end_checks), "thr", levels)
    # fired by the end of input: one position after the last
    after = (tl.agg(F.max("seq")).first()[0] or 0) + 1
    checks = checks.withColumn("g", F.coalesce(F.col("g"), F.lit(after).cast("bigint")))
    checks = stored(checks.groupBy("key", "sid", "g").agg(F.min("fired_at").alias("fired_at")), "checks")
    # what had arrived before each check (seq < g): counts as of the last earlier element
    c = asof_numeric(checks, e, ["key", "sid"], "g", "seq", ["_r", "_f", "_tmax"], strict=True)
    c = stored(c.where(F.col("_r").isNotNull()).withColumn("n", F.col("_r") + F.col("_f")), "counted")
    # emit only when the count grew since the session's previous check
    c = carry_last(c, ["key", "sid"], [F.col("g")], F.col("n"), "_prev_n", inclusive=False)
    fired = c.where(F.col("_prev_n").isNull() | (F.col("n") > F.col("_prev_n"))).select(
        "key", "sid", "g", (F.col("_tmax") + F.lit(gap_ms)).alias("window_end"), "fired_at", "n",
        F.col("_r").alias("_nr"), F.col("_f").alias("_nf"))
    fired = stored(fired.withColumn("is_final", F.col("window_end") <= F.col("fired_at")), "firings")
    return fired, e


def early_session_elements(timeline: DataFrame, gap_ms: int, finish: int = 5) -> DataFrame:
    """The firings in a form linear in the input: every element of every session once, with the first firing that
    covers it: ``key, session_start, arrival, value, rank, fired_at, window_end, n, is_final``.

    A firing's list is all elements of its session whose first firing is that one or an earlier one: the regular ones
    by arrival, then the finish ones (``rank`` counts either kind within the session).  Firings follow one another by ``n``."""
    fired, e = session_firings(timeline, gap_ms, finish)
    first = asof_numeric(e, fired, ["key", "sid"], "seq", "g", ["window_end", "fired_at", "n", "is_final"], forward=True, strict=True)
    rank = F.when(F.col("value") == F.lit(finish), F.col("_f")).otherwise(F.col("_r"))
    return first.select("key", F.col("sid").alias("session_start"), F.col("seq").alias("arrival"), "value", rank.alias("rank"),
                        "fired_at", "window_end", "n", "is_final")


def early_session(timeline: DataFrame, gap_ms: int, finish: int = 5, lists: bool = True) -> DataFrame:
    """Firings of early-result session windows.

    ``lists=True``: rows ``key, window_end, fired_at, n, values (list), is_final``.
    ``lists=False``: the same firings in row form, one row per list position
    (``... , position, value``), built without gathering any session: a
    firing's list is a prefix of its session's order, so each firing explodes
    ``1..n_regular`` and ``1..n_finish`` and equi-joins the elements on
    (key, session, rank).  Output rows equal the list lengths exactly, which
    may grow with the square of a session; ``early_session_elements`` says the
    same in one row per element.
    """
    fired, e = session_firings(timeline, gap_ms, finish)
    fin = F.col("value") == F.lit(finish)
    firing = FIRING

    # one entry per list position: regular ranks 1..nr at positions 1..nr, finish
    # ranks 1..nf at positions nr+1..nr+nf; one equi-join fetches the values
    def entries(count_col, kind, offset):
        return F.when(F.col(count_col) > 0, F.transform(
            F.sequence(F.lit(1), F.col(count_col)),
            lambda r: F.struct(F.lit(kind).alias("k"), r.alias("rank"), (r + offset).alias("pos"))))
    pos = F.explode(F.concat(F.coalesce(entries("_nr", "R", F.lit(0)), F.array()),
                             F.coalesce(entries("_nf", "F", F.col("_nr")), F.array())))
    ranks = fired.select(*firing, pos.alias("_p")).select(
        *firing, F.col("_p.k").alias("_k"), F.col("_p.rank").alias("_rank"), F.col("_p.pos").alias("position"))
    els = e.select("key", "sid", F.when(fin, F.lit("F")).otherwise(F.lit("R")).alias("_k"),
                   F.when(fin, F.col("_f")).otherwise(F.col("_r")).alias("_rank"), "value")
    rows = ranks.join(els, ["key", "sid", "_k", "_rank"]).select(*firing, "position", "value")
    if not lists:
        return rows.drop("sid", "g")
    out = rows.groupBy(*firing).agg(F.sort_array(F.collect_list(F.struct("position", "value"))).alias("_v"))
    return out.select("key", "window_end", "fired_at", "n", F.transform("_v", lambda x: x["value"]).alias("values"),
                      "is_final")
