"""Stateful streaming operators on ``transformWithState`` (event-time timers).

Each processor keeps per-key state in the state store (RocksDB provider) and
uses event-time timers; Spark shuffles the input by key, checkpoints the
state with the query and restores it after a failure.

Callback argument names are part of the API (passed by keyword): keep
``key, rows, timerValues`` and ``key, timerValues, expiredTimerInfo``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)
from pyspark.sql.types import LongType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Slack:
    """Event-time bookkeeping for window processors.

    Spark drops input rows whose event time is behind the operator watermark;
    a window processor must still see an element whose *window* is open.  The
    query therefore runs Spark's watermark ``slack`` behind (slack = the
    window span) and the processor adds it back: ``wm`` is the domain
    watermark, timers are set ``slack`` earlier and read back shifted.  The
    processor applies the exact lateness rule itself.
    """

    slack = 0

    def wm(self, timerValues: TimerValues) -> int:
        w = timerValues.getCurrentWatermarkInMs()
        return w + self.slack if w > 0 else w  # 0 / -1: no watermark yet

    def set_timer(self, t: int) -> None:
        self.handle.registerTimer(t - self.slack)

    def drop_timer(self, t: int) -> None:
        self.handle.deleteTimer(t - self.slack)

    def fired(self, info: ExpiredTimerInfo) -> int:
        return info.getExpiryTimeInMs() + self.slack


def _delay_ms(delay: str) -> int:
    n, unit = delay.split()
    scale = {"millisecond": 1, "milliseconds": 1, "second": 1000, "seconds": 1000, "minute": 60000,
             "minutes": 60000, "hour": 3600000, "hours": 3600000}[unit]
    return int(float(n) * scale)

PAIR_OUT = "ride_id bigint, kind string, ride_ms bigint, fare_ms bigint, driver_id bigint, tip float"
_RIDE_STATE = StructType([StructField("ms", LongType()), StructField("driver_id", LongType())])
_FARE_STATE = "ms bigint, driver_id bigint, tip float"


class PairingProcessor(_Slack, StatefulProcessor):
    """Ride/fare pairing with expiry, keyed by ride id.

    A row waits in its side's slot (a newer row of the same side overwrites
    it) until the other side arrives - then a pair is emitted - or until the
    watermark passes the row's own event time - then it is emitted as a solo
    ride or solo fare.  Input rows: ``ride_id, side ('ride'|'fare'), ms,
    driver_id, tip``.

    ``late_ms`` keeps rows that arrive up to that much behind the watermark
    (Spark would drop them): such a row still pairs with a waiting partner or
    expires as solo at the next watermark step.
    """

    def __init__(self, late_ms: int = 0):
        self.slack = late_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ride = handle.getValueState("ride", _RIDE_STATE)
        self.fare = handle.getValueState("fare", _FARE_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rid = key[0]
        for r in rows:
            if r.side == "ride":
                if self.fare.exists():
                    f = self.fare.get()
                    self.fare.clear()
                    yield Row(ride_id=rid, kind="pair", ride_ms=r.ms, fare_ms=f[0], driver_id=r.driver_id, tip=f[2])
                else:
                    self.ride.update((r.ms, r.driver_id))
                    self.set_timer(r.ms)
            else:
                if self.ride.exists():
                    rd = self.ride.get()
                    self.ride.clear()
                    yield Row(ride_id=rid, kind="pair", ride_ms=rd[0], fare_ms=r.ms, driver_id=rd[1], tip=r.tip)
                else:
                    self.fare.update((r.ms, r.driver_id, r.tip))
                    self.set_timer(r.ms)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        rid = key[0]
        has_r, has_f = self.ride.exists(), self.fare.exists()
        if has_r and not has_f:
            rd = self.ride.get()
            self.ride.clear()
            yield Row(ride_id=rid, kind="solo_ride", ride_ms=rd[0], fare_ms=None, driver_id=rd[1], tip=None)
        elif has_f and not has_r:
            f = self.fare.get()
            self.fare.clear()
            yield Row(ride_id=rid, kind="solo_fare", ride_ms=None, fare_ms=f[0], driver_id=f[1], tip=f[2])

    def close(self) -> None:
        pass


class PairByIdProcessor(PairingProcessor):
    """Ride/fare pairing on the ride id alone, however far apart in time: a
    row waits in its slot until the other side comes (no timers, no solos)."""

    def set_timer(self, t: int) -> None:
        pass


def pair_rides_fares(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """Streaming J1: one pair per ride id, whatever the order and delay."""
    u = pairing_input(rides, fares, driver_modulus=None)
    return u.groupBy("ride_id").transformWithState(PairByIdProcessor(), PAIR_OUT, "Append", "None")


def pairing_input(rides: DataFrame, fares: DataFrame, driver_modulus: int | None = 1000) -> DataFrame:
    """Tagged union of START rides (driver filter applied, if any) and fares."""
    kept = F.lit(True) if driver_modulus is None else F.col("driver_id") % driver_modulus != 0
    r = rides.where(F.col("is_start") & kept).select(
        "ride_id", F.lit("ride").alias("side"), F.unix_millis("event_time").alias("ms"), "driver_id",
        F.lit(None).cast("float").alias("tip"), "event_time")
    f = fares.select("ride_id", F.lit("fare").alias("side"), F.unix_millis("event_time").alias("ms"), "driver_id",
                     F.col("tip").cast("float").alias("tip"), "event_time")
    return r.unionByName(f)


def pair_with_expiry(rides: DataFrame, fares: DataFrame, delay: str = "0 seconds", late_ms: int = 0) -> DataFrame:
    """Streaming J2: pairs, solo rides and solo fares in one output (``kind``)."""
    u = pairing_input(rides, fares).withWatermark("event_time", f"{_delay_ms(delay) + late_ms} milliseconds")
    return u.groupBy("ride_id").transformWithState(PairingProcessor(late_ms), PAIR_OUT, "Append", "EventTime")


EARLY_OUT = "key bigint, window_end bigint, fired_at bigint, total bigint, is_final boolean"


class EarlyTumblingProcessor(_Slack, StatefulProcessor):
    """Tumbling windows with early firing on elements whose second is even.

    State: map window start -> running sum.  A late element (window end - 1 at
    or below the watermark) is dropped; an element with an even second emits
    (watermark, running sum); a timer at window end - 1 emits the final sum.
    """

    def __init__(self, size_ms: int):
        self.size = size_ms
        self.slack = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", "ws bigint", "total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = self.wm(timerValues)
        for r in sorted(rows, key=lambda x: x.seq):
            ws = (r.time // self.size) * self.size
            end = ws + self.size
            if end - 1 <= wm:
                continue
            cur = self.sums.getValue((ws,))
            total = (cur[0] if cur else 0) + r.value
            self.sums.updateValue((ws,), (total,))
            self.set_timer(end - 1)
            if (r.time // 1000) % 2 == 0:
                yield Row(key=key[0], window_end=end, fired_at=wm, total=total, is_final=False)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        end = self.fired(expiredTimerInfo) + 1
        ws = end - self.size
        wm = self.wm(timerValues)
        cur = self.sums.getValue((ws,))
        if cur is not None:
            self.sums.removeKey((ws,))
            yield Row(key=key[0], window_end=end, fired_at=wm, total=cur[0], is_final=end <= wm)

    def close(self) -> None:
        pass


def early_tumbling_stream(elements: DataFrame, size_ms: int, delay: str = "0 seconds") -> DataFrame:
    """``elements(seq, time (ms), key, value, event_time)`` -> early/final rows."""
    e = elements.withWatermark("event_time", f"{_delay_ms(delay) + size_ms} milliseconds")
    return e.groupBy("key").transformWithState(EarlyTumblingProcessor(size_ms), EARLY_OUT, "Append", "EventTime")


ENRICH_OUT = "trade_ms bigint, customer_id bigint, trade_info string, customer_ms bigint, customer_info string"


class AsOfEnrichProcessor(StatefulProcessor):
    """Trade enriched with the customer record valid at the trade's time.

    Keyed by customer id.  Trades wait in list state until the watermark (the
    minimum over the trade and customer inputs) passes their time; then every
    customer record at or before the trade time has arrived and the latest of
    them is attached (null when there is none).  Customer records older than
    the latest one at or before the watermark are dropped from state.
    Input rows: ``customer_id, side ('trade'|'customer'), ms, info``.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.trades = handle.getListState("trades", "ms bigint, info string")
        self.customers = handle.getListState("customers", "ms bigint, info string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            if r.side == "trade":
                self.trades.appendValue((r.ms, r.info))
                self.handle.registerTimer(r.ms)
            else:
                self.customers.appendValue((r.ms, r.info))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        t = expiredTimerInfo.getExpiryTimeInMs()
        cust = sorted(self.customers.get()) if self.customers.exists() else []
        waiting = list(self.trades.get()) if self.trades.exists() else []
        due = [x for x in waiting if x[0] <= t]
        rest = [x for x in waiting if x[0] > t]
        for ms, info in sorted(due):
            best = None
            for c in cust:
                if c[0] <= ms:
                    best = c
            yield Row(trade_ms=ms, customer_id=key[0], trade_info=info,
                      customer_ms=best[0] if best else None, customer_info=best[1] if best else None)
        self.trades.clear()
        if rest:
            self.trades.put(rest)
        keep_from = max([i for i, c in enumerate(cust) if c[0] <= t], default=0)
        self.customers.clear()
        if cust[keep_from:]:
            self.customers.put(cust[keep_from:])

    def close(self) -> None:
        pass


def enrich_trades_stream(trades: DataFrame, customers: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """``trades(trade_time, customer_id, trade_info)`` and ``customers(customer_time,
    customer_id, customer_info)`` streams -> enriched trades.  Each input has
    its own watermark; the operator uses their minimum."""
    t = trades.withWatermark("trade_time", delay).select(
        "customer_id", F.lit("trade").alias("side"), F.unix_millis("trade_time").alias("ms"),
        F.col("trade_info").alias("info"), F.col("trade_time").alias("event_time"))
    c = customers.withWatermark("customer_time", delay).select(
        "customer_id", F.lit("customer").alias("side"), F.unix_millis("customer_time").alias("ms"),
        F.col("customer_info").alias("info"), F.col("customer_time").alias("event_time"))
    return t.unionByName(c).groupBy("customer_id").transformWithState(
        AsOfEnrichProcessor(), ENRICH_OUT, "Append", "EventTime")


SESSION_OUT = "key bigint, window_end bigint, fired_at bigint, n bigint, values array<bigint>, is_final boolean"


class EarlySessionProcessor(_Slack, StatefulProcessor):
    """Session windows (gap ``gap_ms``) with early results on finish elements.

    State per key: the open sessions (start -> end, element count, count at
    the last firing check) and their elements.  An element opens a window
    [t, t + gap) that absorbs every open session it touches; a finish element
    sets a timer at its own time, every session end sets one at end - 1.  A
    timer checks the session containing it and fires (emits the session's
    finish-ordered list) only if elements arrived since the last check; the
    end timer also closes the session.  Elements whose own window is already
    behind the watermark are dropped.  Input rows: ``seq, time, key, value``.
    """

    def __init__(self, gap_ms: int, finish: int = 5):
        self.gap, self.finish = gap_ms, finish
        self.slack = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getMapState("sessions", "start bigint", "end bigint, n bigint, last bigint")
        self.elems = handle.getListState("elems", "seq bigint, time bigint, value bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = self.wm(timerValues)
        sess = {k[0]: list(v) for k, v in self.sessions.iterator()} if self.sessions.exists() else {}
        added = []
        for r in sorted(rows, key=lambda x: x.seq):
            if r.time + self.gap - 1 <= wm:
                continue
            start, end, n, last = r.time, r.time + self.gap, 1, 0
            old_ends = []
            for s0 in [s for s, v in sess.items() if s <= end and v[0] >= start]:
                e0, n0, l0 = sess.pop(s0)
                old_ends.append(e0)
                start, end, n, last = min(start, s0), max(end, e0), n + n0, last + l0
            # end timers of absorbed sessions go, unless one is the merged session's end
            for e0 in old_ends:
                if e0 != end:
                    self.drop_timer(e0 - 1)
            sess[start] = [end, n, last]
            if end not in old_ends:
                self.set_timer(end - 1)
            if r.value == self.finish:
                self.set_timer(r.time)
            added.append((r.seq, r.time, r.value))
        if added:
            self.sessions.clear()
            for s, v in sess.items():
                self.sessions.updateValue((s,), tuple(v))
            self.elems.appendList(added)
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        t = self.fired(expiredTimerInfo)
        wm = self.wm(timerValues)
        if not self.sessions.exists():
            return
        sess = {k[0]: list(v) for k, v in self.sessions.iterator()}
        hit = [s for s, v in sess.items() if s <= t <= v[0] - 1]
        if not hit:
            return
        start = hit[0]
        end, n, last = sess[start]
        elems = list(self.elems.get()) if self.elems.exists() else []
        mine = sorted(e for e in elems if start <= e[1] < end)
        if n > last:
            vals = [e[2] for e in mine]
            ordered = [v for v in vals if v != self.finish] + [v for v in vals if v == self.finish]
            yield Row(key=key[0], window_end=end, fired_at=wm, n=n, values=ordered, is_final=end <= wm)
        if t == end - 1:
            del sess[start]
            self.elems.clear()
            rest = [e for e in elems if not (start <= e[1] < end)]
            if rest:
                self.elems.put(rest)
        else:
            sess[start] = [end, n, n]
        self.sessions.clear()
        for s, v in sess.items():
            self.sessions.updateValue((s,), tuple(v))

    def close(self) -> None:
        pass


def early_session_stream(elements: DataFrame, gap_ms: int, finish: int = 5, delay: str = "0 seconds") -> DataFrame:
    """``elements(seq, time (ms), key, value, event_time)`` -> early/final session firings."""
    e = elements.withWatermark("event_time", f"{_delay_ms(delay) + gap_ms} milliseconds")
    return e.groupBy("key").transformWithState(EarlySessionProcessor(gap_ms, finish), SESSION_OUT, "Append",
                                               "EventTime")


SESSION_ELEMENTS_OUT = ("key bigint, session_start bigint, arrival bigint, value bigint, fired_at bigint, window_end bigint, "
                        "n bigint, is_final boolean")


class EarlySessionElementsProcessor(_Slack, StatefulProcessor):
    """Session windows with early results, every element once.

    The same firings as :class:`EarlySessionProcessor`, told by the elements
    that are new in them: a firing emits each element that came since the
    session's previous one, with the firing's number of elements ``n``; its
    whole list is the elements of this and the earlier firings.  So output and
    state are linear in the input: an element waits in an append-only chunk
    (one per batch and session, never rewritten) until it is emitted, and a
    session keeps its end, its counts and the names of its waiting chunks.
    """

    def __init__(self, gap_ms: int, finish: int = 5):
        self.gap, self.finish = gap_ms, finish
        self.slack = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getMapState("sessions", "start bigint", "end bigint, n bigint, last bigint, chunks array<bigint>")
        self.chunks = handle.getMapState("chunks", "chunk bigint", "elements array<struct<seq bigint, time bigint, value bigint>>")
        self.next_chunk = handle.getValueState("next_chunk", "chunk bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = self.wm(timerValues)
        before = {k[0]: (v[0], v[1], v[2], list(v[3])) for k, v in self.sessions.iterator()}
        sess = dict(before)
        fresh: dict[int, list] = {}
        for r in sorted(rows, key=lambda x: x.seq):
            if r.time + self.gap - 1 <= wm:
                continue
            start, end, n, last, chunks, waiting, ends = r.time, r.time + self.gap, 1, 0, [], [(r.seq, r.time, r.value)], []
            for s0 in [s for s, v in sess.items() if s <= end and v[0] >= start]:
                e0, n0, l0, c0 = sess.pop(s0)
                ends.append(e0)
                start, end, n, last, chunks = min(start, s0), max(end, e0), n + n0, last + l0, chunks + c0
                waiting = fresh.pop(s0, []) + waiting
            for e0 in ends:
                if e0 != end:
                    self.drop_timer(e0 - 1)
            sess[start], fresh[start] = (end, n, last, chunks), waiting
            if end not in ends:
                self.set_timer(end - 1)
            if r.value == self.finish:
                self.set_timer(r.time)
        if fresh:
            chunk = self.next_chunk.get()[0] if self.next_chunk.exists() else 0
            for start, waiting in fresh.items():
                self.chunks.updateValue((chunk,), (waiting,))
                sess[start][3].append(chunk)
                chunk += 1
            self.next_chunk.update((chunk,))
        for s in before.keys() - sess.keys():
            self.sessions.removeKey((s,))
        for s in fresh:
            self.sessions.updateValue((s,), sess[s])
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        t, wm = self.fired(expiredTimerInfo), self.wm(timerValues)
        hit = [(k[0], v) for k, v in self.sessions.iterator() if k[0] <= t <= v[0] - 1]
        if not hit:
            return
        start, (end, n, last, chunks) = hit[0]
        if n > last:
            for chunk in chunks:
                for seq, _, value in self.chunks.getValue((chunk,))[0]:
                    yield Row(key=key[0], session_start=start, arrival=seq, value=value, fired_at=wm, window_end=end, n=n, is_final=end <= wm)
                self.chunks.removeKey((chunk,))
        if t == end - 1:
            self.sessions.removeKey((start,))
        else:
            self.sessions.updateValue((start,), (end, n, n, []))

    def close(self) -> None:
        pass


def early_session_elements_stream(elements: DataFrame, gap_ms: int, finish: int = 5, delay: str = "0 seconds") -> DataFrame:
    """``elements(seq, time (ms), key, value, event_time)`` -> every element with the first firing of its session that covers it."""
    e = elements.withWatermark("event_time", f"{_delay_ms(delay) + gap_ms} milliseconds")
    return e.groupBy("key").transformWithState(EarlySessionElementsProcessor(gap_ms, finish), SESSION_ELEMENTS_OUT, "Append", "EventTime")
