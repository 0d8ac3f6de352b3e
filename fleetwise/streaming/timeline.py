"""Stateful streams that answer in event-time order.

Rows wait in a log of time buckets (map state, one array a bucket) until the
watermark has passed their bucket; an event-time timer at its end then hands
them out in time order, once, and the bucket is gone.  What a key keeps beyond
that is only what its job needs to know of the past: the open rides, the set
flags, the last customer record, the running segment, the regression sums.  So
the results do not depend on how rows are dealt to micro-batches or in which
order they arrive within the watermark delay, a row is written and read once
per batch that touches its bucket, and the cost of a timer does not depend on
the key's history.  State and timers live in Spark's state store and are
restored with the query; rows behind the watermark are late and dropped by
Spark.

Control rows that concern all keys (requests, toggles' controls) are dealt to
``groups`` key groups as rows: the keys are hashed to the groups, and a group
keeps its keys in map state.

Callback argument names are part of the API: keep ``key, rows, timerValues``
and ``key, timerValues, expiredTimerInfo``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fleetwise.functions import geo
from fleetwise.operators.segments import LABEL_STEP, LABELS
from fleetwise.operators.travel_time import MIN_POINTS, MIN_SXX, ride_features

GROUPS = 64


class Timeline(StatefulProcessor):
    """Base: ``FIELDS`` (DDL; the first is the time in ms) of a waiting row,
    ``entry(row)`` makes one, ``order(entry)`` sorts them, and ``settle(key,
    entries)`` gets each bucket's, in time order, yielding output rows."""

    FIELDS = "ms bigint"

    def __init__(self, bucket_ms: int):
        self.bucket_ms = bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.log = handle.getMapState("log", "bucket bigint", f"entries array<struct<{self.FIELDS}>>")

    def entry(self, row) -> tuple:
        raise NotImplementedError

    def settle(self, key, entries: list) -> Iterator[Row]:
        raise NotImplementedError

    def order(self, entry):
        return entry

    def wait(self, rows) -> None:
        new = defaultdict(list)
        for r in rows:
            e = self.entry(r)
            new[e[0] // self.bucket_ms].append(e)
        for bucket, entries in new.items():
            held = self.log.getValue((bucket,))
            self.log.updateValue((bucket,), ([*(map(tuple, held[0]) if held else ()), *entries],))
            self.handle.registerTimer((bucket + 1) * self.bucket_ms - 1)

    def due(self, upto: int) -> list:
        """The entries up to a time of the bucket that holds it, taken out, in order."""
        bucket = upto // self.bucket_ms
        held = self.log.getValue((bucket,))
        if held is None:
            return []
        entries = [tuple(e) for e in held[0]]
        rest = [e for e in entries if e[0] > upto]
        if rest:
            self.log.updateValue((bucket,), (rest,))
        else:
            self.log.removeKey((bucket,))
        return sorted((e for e in entries if e[0] <= upto), key=self.order)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.wait(rows)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # timers fire in the order of their times, so earlier buckets are settled
        yield from self.settle(key, self.due(expiredTimerInfo.getExpiryTimeInMs()))

    def close(self) -> None:
        pass


# ---------------------------------------------------------------- ongoing rides

ONGOING_OUT = ("at_ms bigint, during_ms bigint, ride_id bigint, taxi_id bigint, driver_id bigint, start_ms bigint, "
               "start_lon float, start_lat float, passenger_cnt int")


class OngoingRides(Timeline):
    """Open rides of a key group, and requests for those open for long.

    A START opens a ride and its END closes it; START goes before END at one
    time.  An END that is *timed* before its START leaves a tombstone for
    ``hold_ms`` of event time (a timer ends it), so that the START does not
    open.  A request that arrives is answered at the watermark: what is settled
    by then is all that can have happened by then.
    """

    FIELDS = ("ms bigint, is_end int, ride_id bigint, taxi_id bigint, driver_id bigint, start_ms bigint, "
              "start_lon float, start_lat float, passenger_cnt int")

    def __init__(self, bucket_ms: int, hold_ms: int):
        super().__init__(bucket_ms)
        self.hold_ms = hold_ms

    def init(self, handle):
        super().init(handle)
        self.open = handle.getMapState("open", "ride_id bigint", "ride struct<taxi_id bigint, driver_id bigint, start_ms bigint, "
                                       "start_lon float, start_lat float, passenger_cnt int>")
        self.ended = handle.getMapState("ended", "ride_id bigint", "ms bigint")
        self.graves = handle.getMapState("graves", "ms bigint", "rides array<bigint>")
        self.requests = handle.getListState("requests", "at bigint, during_ms bigint")

    def entry(self, r):
        return (r.ms, int(not r.is_start), r.ride_id, r.taxi_id, r.driver_id, r.start_ms, r.start_lon, r.start_lat, r.passenger_cnt)

    def order(self, e):
        return e[:3]

    def handleInputRows(self, key, rows, timerValues):
        wm, rides = timerValues.getCurrentWatermarkInMs(), []
        for r in rows:
            if r.during_ms is None:
                rides.append(r)
            elif wm > 0:  # before the first watermark nothing is known to have happened
                self.requests.appendValue((wm, r.during_ms))
                self.handle.registerTimer(wm - 1)  # fires after this batch's rows are in
        self.wait(rides)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        t = expiredTimerInfo.getExpiryTimeInMs()
        if (t + 1) % self.bucket_ms == 0:
            self._apply(self.due(t))
        dead = self.graves.getValue((t,))
        if dead is not None:
            for ride_id in dead[0]:
                self.ended.removeKey((ride_id,))
            self.graves.removeKey((t,))
        waiting = [tuple(q) for q in self.requests.get()] if self.requests.exists() else []
        ready = [q for q in waiting if q[0] - 1 <= t]
        if not ready:
            return
        at = max(q[0] for q in ready)
        self._apply(self.due(at))
        for (ride_id,), (ride,) in self.open.iterator():
            taxi, driver, start, lon, lat, n = tuple(ride)
            for _, during in ready:
                if start <= at - during:
                    yield Row(at_ms=at, during_ms=during, ride_id=ride_id, taxi_id=taxi, driver_id=driver, start_ms=start,
                              start_lon=lon, start_lat=lat, passenger_cnt=n)
        rest = [q for q in waiting if q[0] - 1 > t]
        self.requests.clear()
        if rest:
            self.requests.put(rest)

    def _apply(self, entries: list) -> None:
        for ms, is_end, ride_id, *ride in entries:
            if not is_end:
                if not self.ended.containsKey((ride_id,)):
                    self.open.updateValue((ride_id,), (tuple(ride),))
            elif self.open.containsKey((ride_id,)):
                self.open.removeKey((ride_id,))
            else:
                self.ended.updateValue((ride_id,), (ms,))
                until = ((ms + self.hold_ms) // self.bucket_ms + 1) * self.bucket_ms - 1
                held = self.graves.getValue((until,))
                self.graves.updateValue((until,), ([*(held[0] if held else ()), ride_id],))
                self.handle.registerTimer(until)


def _every_group(controls: DataFrame, groups: int) -> DataFrame:
    return controls.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))


def _group_of(key: str, groups: int):
    return F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")


def ongoing_rides(rides: DataFrame, requests: DataFrame, delay: str = "0 seconds", groups: int = GROUPS,
                  bucket_ms: int = 60_000, hold_ms: int = 24 * 3_600_000) -> DataFrame:
    """Streams of ride events and of requests (``during``, minutes) -> for every request the rides that are open for
    at least that long at the watermark in force (``at_ms``).  Requests have no event time and hold nothing back."""
    r = rides.select(_group_of("ride_id", groups).alias("group"), "event_time", F.unix_millis("event_time").alias("ms"), "is_start",
                     "ride_id", "taxi_id", "driver_id", F.unix_millis("start_time").alias("start_ms"), "start_lon", "start_lat",
                     F.col("passenger_cnt").cast("int").alias("passenger_cnt"), F.lit(None).cast("bigint").alias("during_ms"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in r.schema.fields if f.name not in ("group", "during_ms")]
    q = _every_group(requests.where("during is not null").select((F.col("during") * 60_000).cast("bigint").alias("during_ms"), *empty), groups)
    both = r.unionByName(q).withWatermark("event_time", delay)
    return both.groupBy("group").transformWithState(OngoingRides(bucket_ms, hold_ms), ONGOING_OUT, "Append", "EventTime")


# ---------------------------------------------------------------- toggles

TOGGLE_OUT = "control_ms bigint, control_value bigint, key bigint"


class Toggles(Timeline):
    """Flags of a key group: an element flips its key's, a control is answered
    with every key whose flag is set by all elements at or before its time."""

    FIELDS = "ms bigint, is_control int, key bigint, value bigint"

    def init(self, handle):
        super().init(handle)
        self.set_keys = handle.getMapState("set", "key bigint", "flag int")

    def entry(self, r):
        return (r.ms, r.is_control, r.key, r.value)

    def order(self, e):
        return e[:2]

    def settle(self, key, entries):
        flips = defaultdict(int)

        def apply():
            for k, n in flips.items():
                if n % 2:
                    if self.set_keys.containsKey((k,)):
                        self.set_keys.removeKey((k,))
                    else:
                        self.set_keys.updateValue((k,), (1,))
            flips.clear()

        for ms, is_control, k, value in entries:
            if not is_control:
                flips[k] += 1
                continue
            apply()
            for (of,) in list(self.set_keys.keys()):
                yield Row(control_ms=ms, control_value=value, key=of)
        apply()


def toggles(elements: DataFrame, controls: DataFrame, delay: str = "0 seconds", groups: int = GROUPS, bucket_ms: int = 60_000) -> DataFrame:
    """Streams of elements (``key, event_time``) and controls (``value, event_time``) -> (control_ms, control_value, key)
    for every control and key whose flag is set at the control's time, however the rows are dealt to batches."""
    e = elements.where("key is not null").select(
        _group_of("key", groups).alias("group"), "event_time", F.unix_millis("event_time").alias("ms"), F.lit(0).alias("is_control"),
        F.col("key").cast("bigint").alias("key"), F.lit(None).cast("bigint").alias("value"))
    c = _every_group(controls.select("event_time", F.unix_millis("event_time").alias("ms"), F.lit(1).alias("is_control"),
                                     F.lit(None).cast("bigint").alias("key"), F.col("value").cast("bigint").alias("value")), groups)
    both = e.unionByName(c).withWatermark("event_time", delay)
    return both.groupBy("group").transformWithState(Toggles(bucket_ms), TOGGLE_OUT, "Append", "EventTime")


# ---------------------------------------------------------------- as-of enrichment

ASOF_OUT = "trade_ms bigint, customer_id bigint, trade_info string, customer_ms bigint, customer_info string"


class AsOf(Timeline):
    """Trades with the customer record in force; the past is one record."""

    FIELDS = "ms bigint, is_trade int, info string"

    def init(self, handle):
        super().init(handle)
        self.last = handle.getValueState("last", "ms bigint, info string")

    def entry(self, r):
        return (r.ms, int(r.side == "trade"), r.info)

    def order(self, e):
        return (e[0], e[1], e[2] is not None, e[2] or "")

    def settle(self, key, entries):
        last = tuple(self.last.get()) if self.last.exists() else (None, None)
        known = last
        for ms, is_trade, info in entries:
            if is_trade:
                yield Row(trade_ms=ms, customer_id=key[0], trade_info=info, customer_ms=last[0], customer_info=last[1])
            else:
                last = (ms, info)
        if last != known:
            self.last.update(last)


def enrich_trades(trades: DataFrame, customers: DataFrame, delay: str = "0 seconds", bucket_ms: int = 1_000) -> DataFrame:
    """``trades(trade_time, customer_id, trade_info)`` and ``customers(customer_time, customer_id, customer_info)``
    streams -> trades with the latest customer record at or before them.  Each input has its own watermark."""
    t = trades.withWatermark("trade_time", delay).select(
        "customer_id", F.lit("trade").alias("side"), F.unix_millis("trade_time").alias("ms"), F.col("trade_info").alias("info"),
        F.col("trade_time").alias("event_time"))
    c = customers.withWatermark("customer_time", delay).select(
        "customer_id", F.lit("customer").alias("side"), F.unix_millis("customer_time").alias("ms"), F.col("customer_info").alias("info"),
        F.col("customer_time").alias("event_time"))
    return t.unionByName(c).groupBy("customer_id").transformWithState(AsOf(bucket_ms), ASOF_OUT, "Append", "EventTime")


# ---------------------------------------------------------------- stopped segments

STOPPED_OUT = ("car_id string, start_ms bigint, length bigint, max_speed int, erraticness double, description string, stop_ms bigint")


class StoppedSegments(Timeline):
    """Drive segments closed by a stop (speed 0): the past is one running
    segment (Welford sums for the deviation) and the time of the last stop.
    A car silent for ``idle_ms`` after its last settled event is forgotten with
    its open segment, which no stop ever closed."""

    FIELDS = "ms bigint, us bigint, speed float, throttle float"

    def __init__(self, bucket_ms: int, idle_ms: int | None):
        super().__init__(bucket_ms)
        self.idle_ms = idle_ms

    def init(self, handle):
        super().init(handle)
        self.now = handle.getValueState("now", "last_stop bigint, start_us bigint, length bigint, max_speed float, n bigint, "
                                               "mean double, squares double, last_ms bigint")

    def entry(self, r):
        return (r.ms, r.us, r.speed, r.throttle)

    def order(self, e):
        return (e[1], e[2] != 0.0)

    def settle(self, key, entries):
        stop, start, length, top, n, mean, squares, last = tuple(self.now.get()) if self.now.exists() else (None, None, 0, None, 0, 0.0, 0.0, None)
        for ms, us, speed, throttle in entries:
            last = ms
            if speed == 0.0:
                if length:
                    yield self._closed(key, start, length, top, n, squares, ms)
                stop, start, length, top, n, mean, squares = us, None, 0, None, 0, 0.0, 0.0
            elif us != stop and speed is not None:
                start, length = (us if start is None else start), length + 1
                # a NaN counts as the greatest, as in the batch form
                top = speed if top is None or speed > top or speed != speed else top
                if throttle is not None:
                    n += 1
                    off = throttle - mean
                    mean += off / n
                    squares += off * (throttle - mean)
        if last is not None:
            self.now.update((stop, start, length, top, n, mean, squares, last))
            if self.idle_ms is not None:
                self.handle.registerTimer(last + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        t = expiredTimerInfo.getExpiryTimeInMs()
        if (t + 1) % self.bucket_ms == 0:
            yield from self.settle(key, self.due(t))
        if self.idle_ms is not None and self.now.exists() and self.now.get()[7] + self.idle_ms <= t:
            self.now.clear()

    @staticmethod
    def _closed(key, start, length, top, n, squares, stop_ms) -> Row:
        spread = (squares / n) ** 0.5 if n else None
        label = None if spread is None else LABELS[min(int(spread / LABEL_STEP), 2)] if spread == spread else LABELS[0]
        speed = 0 if top != top else int(max(min(top, geo.INT_MAX), geo.INT_MIN))
        return Row(car_id=key[0], start_ms=start // 1000, length=length, max_speed=speed, erraticness=spread,
                   description=label or LABELS[2], stop_ms=stop_ms)


def stopped_segments(cars: DataFrame, delay: str = "30 seconds", bucket_ms: int = 60_000, idle_ms: int | None = None) -> DataFrame:
    """A stream of car events -> the segments between stops, each once the watermark has passed its stop."""
    c = cars.select("car_id", "event_time", F.unix_millis("event_time").alias("ms"), F.unix_micros("event_time").alias("us"),
                    F.col("speed").cast("float").alias("speed"), F.col("throttle").cast("float").alias("throttle"))
    return c.withWatermark("event_time", delay).groupBy("car_id").transformWithState(
        StoppedSegments(bucket_ms, idle_ms), STOPPED_OUT, "Append", "EventTime")


# ---------------------------------------------------------------- travel times

TRAVEL_OUT = "ride_id bigint, bucket int, distance double, n bigint, predicted_min int"


class TravelTimes(Timeline):
    """Regression through the origin per direction bucket, refined by every
    finished ride and asked by every starting one, in event-time order."""

    FIELDS = "ms bigint, is_start int, ride_id bigint, distance double, travel_min double"

    def init(self, handle):
        super().init(handle)
        self.sums = handle.getValueState("sums", "n bigint, sxx double, sxy double")

    def entry(self, r):
        return (r.ms, int(r.is_start), r.ride_id, r.distance, r.travel_min)

    def order(self, e):
        return e[:3]

    def settle(self, key, entries):
        n, sxx, sxy = tuple(self.sums.get()) if self.sums.exists() else (0, 0.0, 0.0)
        for _, is_start, ride_id, x, y in entries:
            if not is_start:
                n, sxx, sxy = n + 1, sxx + x * x, sxy + x * y
                continue
            known = n >= MIN_POINTS and abs(sxx) >= MIN_SXX
            predicted = int(max(min(sxy / sxx * x, geo.INT_MAX), geo.INT_MIN)) if known else -1
            yield Row(ride_id=ride_id, bucket=key[0], distance=x, n=n, predicted_min=predicted)
        self.sums.update((n, sxx, sxy))


def travel_times(rides: DataFrame, delay: str = "0 seconds", bucket_ms: int = 60_000) -> DataFrame:
    """A stream of ride events -> a prediction for every START inside NYC from the ENDs inside NYC up to its time
    (an END at the same time counts)."""
    inside = geo.in_nyc("start_lon", "start_lat") & geo.in_nyc("end_lon", "end_lat")
    f = ride_features(rides.where(inside)).where(~F.isnan("distance")).select(
        "bucket", "event_time", F.unix_millis("event_time").alias("ms"), "is_start", "ride_id", "distance", "travel_min")
    return f.withWatermark("event_time", delay).groupBy("bucket").transformWithState(
        TravelTimes(bucket_ms), TRAVEL_OUT, "Append", "EventTime")
