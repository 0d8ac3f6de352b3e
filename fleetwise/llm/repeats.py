"""Removal of repeated byte strings by hash-compared suffix sorting.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else in the corpus (same document included) is removed.

Only suffixes that can matter are sorted.  Each window of ``LENGTH`` bytes has
an *anchor*, the ``GRAM`` bytes in it whose hash is least (rightmost among
equals).  Equal windows have equal anchors at equal offsets, so windows are
compared within groups of one anchor hash, and anchors that occur once are
done.  About one byte in 75 starts an anchor; the windows of one anchor are
neighbours, and the bytes they span are its *context*.

1. Anchors are counted (partial aggregation) and only repeated ones kept.
2. Contexts that are equal as a whole form a class: with two members or more
   all their windows repeat.  However many copies there are, one goes on.
3. Where an anchor has several classes, their contexts are compared window by
   window.  From the anchor, the suffixes to the right and the reversed
   prefixes to the left are mergesorted; a comparison takes the common
   extension by binary search over prefix polynomial hashes, so its cost is
   logarithmic in the length.  The common prefixes of neighbours in the two
   orders, checked byte by byte against hash collisions, say which contexts
   agree in o bytes to the left and LENGTH - o to the right.
4. An anchor with more than ``GROUP`` classes is not gathered: stripes of
   ``STRIPE`` neighbouring windows are spread over all tasks by the 128-bit
   hash of their bytes; equal ones repeat as a whole, and single windows are
   hashed only where different stripes share their middle.

Texts are named by two hashes, so equal documents share their answer, and only
texts with a repeated anchor are read again.

Defined cases: a null text counts as empty; texts below ``LENGTH`` bytes keep
all; repeated rows are copies of each other, so all lose what is long enough;
a null doc_id is carried along; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.llm.common import stored

LENGTH = 200
GRAM = 48
GROUP = 256
STRIPE = 8
CHUNK = 1 << 22  # starts worked on at a time in a very long text
BATCH = 1 << 11  # contexts sorted together; bounds the memory of a task
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POS = np.uint64((1 << 24) - 1)


# ---------------------------------------------------------------- anchors

def _powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0], have = 1, 1
    while have < n:
        k = min(have, n - have)
        out[have:have + k] = out[:k] * np.uint64(pow(base, have, 1 << 64))
        have += k
    return out[:n]


_TABLES: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) < n:
        size = max(n, 1 << 16)
        _TABLES["up"] = _powers(size, int(_BASE))
        _TABLES["down"] = _powers(size, pow(int(_BASE), -1, 1 << 64))
    return _TABLES["up"][:n], _TABLES["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes (0 to n bytes), modulo 2 ** 64."""
    up, _ = _power_tables(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first start, last start) of every anchor of a text."""
    got = [_anchors(data[at:at + CHUNK + LENGTH - 1], at) for at in range(0, max(1, len(data) - LENGTH + 1), CHUNK)]
    return tuple(np.concatenate(x) for x in zip(*got))


def _anchors(data: np.ndarray, base: int):
    n = len(data) - LENGTH + 1  # starts
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    h = prefix_hash(data)
    _, down = _power_tables(len(data))
    grams = (h[GRAM:] - h[:-GRAM]) * down[:len(h) - GRAM]
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(29)
    least = (grams & ~_POS) | (_POS - np.arange(len(grams), dtype=np.uint64))
    width, span = LENGTH - GRAM + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    place = (_POS - (least & _POS)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], n) - 1
    place = place[first]
    return grams[place], place + base, first + base, last + base


def _occurrences(with_context: bool):
    """Rows t, u, text -> one row per anchor."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                out: list[tuple] = []
                for t, u, text in zip(*(c.to_pylist() for c in some.columns)):
                    raw = text.encode()
                    a, place, first, last = anchors(np.frombuffer(raw, np.uint8))
                    if not len(a):
                        continue
                    cols = [a.view(np.int64)]
                    if with_context:
                        d = [xxhash.xxh3_64_intdigest(raw[f:e + LENGTH], p - f)
                             for f, e, p in zip(first.tolist(), last.tolist(), place.tolist())]
                        cols += [np.array(d, np.uint64).view(np.int64), np.full(len(a), t), np.full(len(a), u),
                                 place, first, last]
                    out.append(tuple(cols))
                if out:
                    names = ["a", "d", "t", "u", "place", "lo", "hi"][:len(out[0])]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names)
    return run


# ---------------------------------------------------------------- suffix sort

class Suffixes:
    """Suffixes of a byte buffer, compared by prefix polynomial hashes."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.data, self.begin, self.size = data, begin, end - begin
        self.h = prefix_hash(data)
        self.down = _power_tables(len(data) + 1)[1]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes x and y, by binary search."""
        bx, by = self.begin[x], self.begin[y]
        low, high = np.zeros(len(x), np.int64), np.minimum(self.size[x], self.size[y])
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) >> 1
            same = (self.h[bx + mid] - self.h[bx]) * self.down[bx] == (self.h[by + mid] - self.h[by]) * self.down[by]
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x comes before suffix y (a prefix comes first)."""
        n = self.common(x, y)
        ends_x, ends_y = n == self.size[x], n == self.size[y]
        last = len(self.data) - 1
        cx = self.data[np.minimum(self.begin[x] + n, last)]
        cy = self.data[np.minimum(self.begin[y] + n, last)]
        return np.where(ends_x, ~ends_y, ~ends_y & (cx < cy))

    def sort(self, group_begin: np.ndarray, group_size: np.ndarray) -> np.ndarray:
        """Mergesort within groups of consecutive suffixes, all groups and
        runs of a level at once: an element's place in the merged run is its
        place in its own run plus the number of smaller ones in the other,
        which a binary search finds."""
        m = len(self.begin)
        order = np.arange(m)
        start = np.repeat(group_begin, group_size)
        stop = start + np.repeat(group_size, group_size)
        run = 1
        while run < group_size.max(initial=1):
            at = np.arange(m) - start
            mine = start + at // run * run
            pair = start + at // (2 * run) * (2 * run)
            in_left = mine == pair
            other = np.where(in_left, np.minimum(pair + run, stop), pair)
            other_end = np.where(in_left, np.minimum(pair + 2 * run, stop), np.minimum(pair + run, stop))
            low, high = other.copy(), other_end.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                x, y = order[open_], order[mid]
                # equal suffixes keep their order: those of the left run come first
                left = in_left[open_]
                before = np.where(left, self.less(y, x), ~self.less(x, y))
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
            place = pair + (np.arange(m) - mine) + (low - other)
            merged = np.empty(m, np.int64)
            merged[place] = order
            order = merged
            run *= 2
        return order

    def neighbours(self, order: np.ndarray) -> np.ndarray:
        """Common prefix of each suffix with the one before it in ``order``,
        verified byte by byte; ValueError if a hash collision misled."""
        x, y = order[:-1], order[1:]
        n = self.common(x, y)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if (self.data[np.repeat(self.begin[x], n) + step] != self.data[np.repeat(self.begin[y], n) + step]).any():
            raise ValueError("hash collision")
        return np.append(0, n)


def _plain_order(data: np.ndarray, begin, end, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes without hashes, for a batch with a collision."""
    parts = [data[b:e].tobytes() for b, e in zip(begin, end)]
    order = np.array(sorted(range(len(parts)), key=lambda i: (group[i], parts[i])), np.int64)
    common = [0]
    for x, y in zip(order[:-1], order[1:]):
        p, q = parts[x], parts[y]
        k = min(len(p), len(q))
        differ = np.flatnonzero(np.frombuffer(p[:k], np.uint8) != np.frombuffer(q[:k], np.uint8))
        common.append(int(differ[0]) if len(differ) else k)
    return order, np.array(common, np.int64)


def repeated_windows(contexts: list[bytes], offset: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which windows of each context are in another context of its group, as
    a matrix contexts x left bytes.  ``offset`` is the anchor's place in the
    context; equal ``group`` numbers stand together."""
    size = np.array([len(c) for c in contexts])
    ends = np.cumsum(size)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    total = len(data)
    group_begin = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
    group_size = np.diff(np.append(group_begin, len(group)))
    anchor = ends - size + offset
    # to the right: from the anchor to the context's end; to the left: the bytes before it, reversed
    sides = []
    for bytes_, begin, end in ((data, anchor, ends), (data[::-1].copy(), total - anchor, total - (ends - size))):
        s = Suffixes(bytes_, begin, end)
        order = s.sort(group_begin, group_size)
        try:
            common = s.neighbours(order)
        except ValueError:
            order, common = _plain_order(bytes_, begin, end, group)
        common[group_begin] = -1  # never joined over groups
        sides.append((order, common))
    m = len(contexts)
    width = LENGTH - GRAM + 1
    out = np.zeros((m, width), bool)
    left_most, right = offset, size - offset
    for o in range(min(width, int(left_most.max()) + 1)):
        active = np.flatnonzero((o <= left_most) & (LENGTH - o <= right))
        if len(active) < 2:
            continue
        both = np.zeros(m, np.int64)
        for (order, common), need in zip(sides, (LENGTH - o, o)):
            number = np.empty(m, np.int64)
            number[order] = np.cumsum(common < need)
            both = both * (m + 1) + number
        _, at, n = np.unique(both[active], return_inverse=True, return_counts=True)
        out[active, o] = n[at] > 1
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows a, t, u, place, lo, context in the order of a -> rows t, u, lo, hi."""
    held: list[tuple] = []

    def settle(rows):
        a = np.array([r[0] for r in rows])
        place, lo = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
        hit = repeated_windows([r[5] for r in rows], place - lo, np.cumsum(np.diff(a, prepend=a[0]) != 0))
        edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, first = np.nonzero(edge == 1)
        after = np.nonzero(edge == -1)[1]
        return pa.RecordBatch.from_pydict({
            "t": pa.array([rows[i][1] for i in row], pa.int64()), "u": pa.array([rows[i][2] for i in row], pa.int64()),
            "lo": pa.array(place[row] - after + 1, pa.int64()), "hi": pa.array(place[row] - first, pa.int64())})

    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            held.extend(zip(*(c.to_pylist() for c in batch.slice(at, BATCH).columns)))
            while len(held) > BATCH:
                cut = BATCH  # at the end of a group, which has at most GROUP rows
                while cut > 0 and held[cut - 1][0] == held[cut][0]:
                    cut -= 1
                yield settle(held[:cut])
                held = held[cut:]
    if held:
        yield settle(held)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows text, t, u, [(a, place, lo, hi)] -> a row for each with its bytes."""
    for batch in batches:
        for i in range(batch.num_rows):
            text, t, u, asked = (c[i].as_py() for c in batch.columns)
            raw = text.encode()
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([x["a"] for x in asked], pa.int64()), "t": pa.array([t] * len(asked), pa.int64()),
                "u": pa.array([u] * len(asked), pa.int64()), "place": pa.array([x["place"] for x in asked], pa.int64()),
                "lo": pa.array([x["lo"] for x in asked], pa.int64()), "hi": pa.array([x["hi"] for x in asked], pa.int64()),
                "context": pa.array([raw[x["lo"]:x["hi"] + LENGTH] for x in asked], pa.binary())})


def _stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts -> a row for every ``STRIPE`` neighbouring windows: the hash
    of the bytes they span (f1, f2), the hash of the bytes that all windows of
    the stripe's place have in common (c1, c2), their starts and their bytes."""
    import xxhash
    for batch in batches:
        for i in range(batch.num_rows):
            _, t, u, place, lo, hi, context = (c[i].as_py() for c in batch.columns)
            rows = []
            for k in range((place - hi) // STRIPE, (place - lo) // STRIPE + 1):
                first = place - min(place - lo, k * STRIPE + STRIPE - 1) - lo
                last = place - max(place - hi, k * STRIPE) - lo
                span = context[first:last + LENGTH]
                core = context[place - lo - k * STRIPE:place - lo - k * STRIPE - STRIPE + 1 + LENGTH]
                rows.append((xxhash.xxh3_128_digest(span, place - lo - first), xxhash.xxh3_128_digest(core, k), first + lo, last + lo, span))
            f, c = (np.frombuffer(b"".join(r[j] for r in rows), "<i8").reshape(-1, 2) for j in (0, 1))
            n = len(rows)
            yield pa.RecordBatch.from_pydict({
                "f1": f[:, 0], "f2": f[:, 1], "c1": c[:, 0], "c2": c[:, 1], "t": np.full(n, t), "u": np.full(n, u),
                "lo": np.array([r[2] for r in rows]), "hi": np.array([r[3] for r in rows]),
                "span": pa.array([r[4] for r in rows], pa.binary())})


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows t, u, lo, hi, span -> a row w1, w2, t, u, s for each window."""
    import xxhash
    for batch in batches:
        for i in range(batch.num_rows):
            t, u, lo, hi, span = (c[i].as_py() for c in batch.columns)
            n = hi - lo + 1
            h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(span[k:k + LENGTH]) for k in range(n)), "<i8").reshape(n, 2)
            yield pa.RecordBatch.from_pydict({"w1": h[:, 0], "w2": h[:, 1], "t": np.full(n, t), "u": np.full(n, u),
                                              "s": np.arange(lo, hi + 1)})


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows text, t, u, [(lo, hi)] of repeated starts -> what remains."""
    for batch in batches:
        for i in range(batch.num_rows):
            text, t, u, runs = (c[i].as_py() for c in batch.columns)
            raw = text.encode()
            spans: list[list[int]] = []
            for r in sorted(runs, key=lambda r: r["lo"]):
                if spans and r["lo"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], r["hi"] + LENGTH)
                else:
                    spans.append([r["lo"], r["hi"] + LENGTH])
            kept, at = [], 0
            for b, e in spans:
                kept.append(raw[at:b])
                at = e
            kept.append(raw[at:])
            rest = b"".join(kept)
            yield pa.RecordBatch.from_pydict({
                "t": pa.array([t], pa.int64()), "u": pa.array([u], pa.int64()), "kept": pa.array([rest], pa.binary()),
                "n_removed": pa.array([len(raw) - len(rest)], pa.int64()), "n_spans": pa.array([len(spans)], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(rest).hexdigest()], pa.string())})


# ---------------------------------------------------------------- jobs

def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    raw = text.cast("binary")
    return docs.select(docs["doc_id"].alias("doc_id"), text.alias("text"), F.xxhash64(raw).alias("t"), F.crc32(raw).alias("u"))


def repeated_starts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts that hold a repeated anchor, once each: t, u, text;
    runs lo..hi of starts whose LENGTH bytes start elsewhere too: t, u, lo, hi)."""
    long_ = _named(docs).where(F.octet_length("text") >= LENGTH).select("t", "u", "text")
    counted = (long_.mapInArrow(_occurrences(False), "a long").groupBy("a").agg(F.count(F.lit(1)).alias("n"))
               .where("n > 1").select("a"))
    seen = stored(long_.mapInArrow(_occurrences(True), "a long, d long, t long, u long, place long, lo long, hi long")
                  .join(counted, "a", "left_semi"), "anchors")
    classes = stored(seen.groupBy("a", "d").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "u", "place", "lo", "hi")).alias("first"))
                     .select("a", "d", "n", "first.*"), "classes")
    whole = seen.join(classes.where("n > 1").select("a", "d"), ["a", "d"]).select("t", "u", "lo", "hi").distinct()
    several = classes.groupBy("a").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    asked = classes.join(several, "a").select("a", "n", "t", "u", "place", "lo", "hi", (F.col("classes") > GROUP).alias("hot"))
    # one copy of every text with a repeated anchor
    needed = seen.select("t", "u").distinct()
    copies = long_.join(needed, ["t", "u"], "left_semi")
    texts = stored(copies.groupBy("t", "u").agg(F.first("text").alias("text")), "texts")
    by_text = asked.groupBy("t", "u").agg(F.collect_list(F.struct("a", "place", "lo", "hi", "hot")).alias("asked"))
    contexts = texts.join(by_text, ["t", "u"]).select("text", "t", "u", "asked")

    def of(hot: bool) -> DataFrame:
        some = contexts.withColumn("asked", F.filter("asked", lambda x: x["hot"] == F.lit(hot))).where(F.size("asked") > 0)
        return some.mapInArrow(_contexts, "a long, t long, u long, place long, lo long, hi long, context binary")

    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = of(False).select("a", "t", "u", "place", "lo", "context").repartition(n, "a").sortWithinPartitions("a")
    compared = sorted_.mapInArrow(_compare, "t long, u long, lo long, hi long")
    return texts, whole.union(compared).union(_spread(of(True)))


def _spread(contexts: DataFrame) -> DataFrame:
    """Repeated starts (t, u, lo, hi) of contexts whose anchor has too many
    classes to be gathered.  Equal stripes are classes again; windows are
    taken one by one only where unequal stripes have their middle in common."""
    stripes = stored(contexts.mapInArrow(
        _stripes, "f1 long, f2 long, c1 long, c2 long, t long, u long, lo long, hi long, span binary"), "stripes")
    classes = stored(stripes.groupBy("f1", "f2").agg(
        F.count(F.lit(1)).alias("n"), F.min("c1").alias("c1"), F.min("c2").alias("c2"),
        F.min(F.struct("t", "u", "lo", "hi", "span")).alias("first")), "stripe-classes")
    whole = stripes.join(classes.where("n > 1").select("f1", "f2"), ["f1", "f2"], "left_semi").select("t", "u", "lo", "hi")
    several = classes.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1").select("c1", "c2")
    windows = stored(classes.join(several, ["c1", "c2"], "left_semi").select("first.*").mapInArrow(
        _windows, "w1 long, w2 long, t long, u long, s long"), "windows")
    more = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    single = windows.join(more, ["w1", "w2"], "left_semi").select("t", "u", F.col("s").alias("lo"), F.col("s").alias("hi"))
    return whole.union(single)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) and
    kept_sha256 of every document."""
    texts, runs = repeated_starts(docs)
    by_text = runs.groupBy("t", "u").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    changed = texts.join(by_text, ["t", "u"]).select("text", "t", "u", "runs").mapInArrow(
        _removed, "t long, u long, kept binary, n_removed long, n_spans long, kept_sha256 string")
    raw = F.col("text").cast("binary")
    rows = _named(docs).select("doc_id", "t", "u", F.octet_length("text").cast("long").alias("n_bytes"),
                               raw.alias("whole"), F.sha2(raw, 256).alias("whole_sha256"))
    return rows.join(changed, ["t", "u"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept", "whole").alias("kept"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))
