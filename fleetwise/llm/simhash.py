"""SimHash near-duplicates by pigeonring filtering.

``fingerprints`` gives each text a 64-bit SimHash of its word shingles.
``linked`` finds the fingerprints that differ in at most ``distance`` bits and
``near_duplicates`` joins documents over such links into components.

The 64 bits are a ring of ``SEGMENTS`` segments.  If two fingerprints differ
in at most ``d`` bits, some segment starts a chain such that, for every length
l, the first l segments together differ in at most ``l * d / SEGMENTS`` bits
(pigeonring principle).  With d = 3 and 4 segments of 16 bits the budgets are
0, 1, 2, 3: so the first segment is equal and the second differs in at most
one bit.  Those two budgets are the join key: one side gives its segment pair,
the other its pair and the 16 pairs with one bit of the second segment turned.
The key has 32 bits, so candidates stay in proportion to the input; the third
budget prunes them before the full Hamming check.

Skew: equal fingerprints are one class (however many copies), joined back at
the end.  A key shared by more than ``HOT`` classes is not paired: its classes
are linked through the points around them.  If x and y differ in at most 3
bits, some point z differs from x in at most 1 bit and from y in at most 2;
grouped by z, all classes within 2 bits are linked to the smallest class
within 1 bit.  Each such link is a true one, every linked pair shares a z,
and the work is in proportion to the hot classes, not to their pairs.

Defined cases: a null, empty or blank text has no shingle and fingerprint
zero, which links like any other; a text shorter than a shingle is hashed as
one; a null doc_id is carried along but is never a component's id; rows that
repeat an id are separate documents of one id; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwise.llm.common import components, free_name, stored

SEGMENTS, BITS = 4, 16
HOT = 64


def simhash(texts: list[str | None], words_in_shingle: int) -> np.ndarray:
    """Fingerprints (unsigned 64 bits): a bit is set if over half of the
    shingles' XXH64 (seed 42) have it."""
    import xxhash
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for i, t in enumerate(texts):
        words = t.encode().lower().split() if t else []
        if not words:
            continue
        if len(words) <= words_in_shingle:
            out[i] = digest(b" ".join(words), seed=42)
            continue
        whole = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        stop = ends[words_in_shingle - 1:].tolist()
        start = [0, *(ends[:len(stop) - 1] + 1).tolist()]
        ones, n = np.zeros(64, np.int64), len(stop)
        for at in range(0, n, 1 << 15):
            h = np.array([digest(whole[a:b], seed=42) for a, b in zip(start[at:at + (1 << 15)], stop[at:at + (1 << 15)])], "<u8")
            ones += _bit_counts(h)
        out[i] = int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")
    return out


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the values have each of the 64 bits."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255):
        out += bits[at:at + 255].sum(axis=0, dtype=np.uint8)
    return out


def _fingerprint_batches(words_in_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = simhash(b.column(1).to_pylist(), words_in_shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64()), b.column(2)], ["doc_id", "fp", "text_hash"])
    return run


def _with_hash(docs: DataFrame, words_in_shingle: int) -> DataFrame:
    """doc_id, fp and a hash of the text."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), F.xxhash64(docs["text"])).mapInArrow(
        _fingerprint_batches(words_in_shingle), "doc_id long, fp long, text_hash long")


def fingerprints(docs: DataFrame, words_in_shingle: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number."""
    return _with_hash(docs, words_in_shingle).drop("text_hash")


def _segment(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, BITS * (k % SEGMENTS)).bitwiseAND(0xFFFF)


def linked(classes: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` of ``classes``: all
    pairs that differ in at most ``distance`` (0 to 3) bits, but around keys
    of more than ``HOT`` classes only enough of them to connect the same."""
    if not 0 <= distance < SEGMENTS:
        raise ValueError("distance must be 0 to 3")
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.shiftleft(_segment(F.col("fp"), k), BITS).bitwiseOR(
        _segment(F.col("fp"), k + 1)).alias("key")) for k in range(SEGMENTS)])
    index = stored(classes.select("fp", F.explode(pairs).alias("p")).select("fp", "p.k", "p.key"), "segments")
    hot = stored(index.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).drop("n"), "hot-keys")
    # second budget: two segments may differ in 2 * distance / SEGMENTS bits, which is at most 1
    turns = F.lit([0, *([1 << j for j in range(BITS)] if 2 * distance >= SEGMENTS else [])])
    probe = index.withColumn("turn", F.explode(turns)).select(
        F.col("fp").alias("q"), "k", F.col("key").bitwiseXOR(F.col("turn").cast("long")).alias("key"))
    cool = index.join(hot, ["k", "key"], "left_anti")
    x, y, k = F.col("q"), F.col("fp"), F.col("k")
    third = F.bit_count(_turned(x.bitwiseXOR(y), k).bitwiseAND((1 << 3 * BITS) - 1))
    # merged, never broadcast: Spark sizes the probe by the keys before the explode, 17 times too low, and takes it for the smaller side
    found = (probe.join(cool.hint("merge"), ["k", "key"]).where(x != y).where(third * SEGMENTS <= 3 * distance)
             .where(F.bit_count(x.bitwiseXOR(y)) <= distance)
             .select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")))
    near = probe.join(hot, ["k", "key"], "left_semi").select(F.col("q").alias("fp")).distinct()
    return found.union(_through_points(near, distance)).distinct()


def _turned(v: Column, k: Column) -> Column:
    """``v`` with segment k turned to the low end of the ring."""
    by = (k * BITS).cast("int")
    return F.when(k == 0, v).otherwise(F.call_function("shiftrightunsigned", v, by).bitwiseOR(
        F.call_function("shiftleft", v, F.lit(64) - by)))


def _through_points(near: DataFrame, distance: int) -> DataFrame:
    """Links that connect all of ``near`` within ``distance`` through the
    points between them."""
    inner, outer = distance // 2, distance - distance // 2
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    ball = [0] + ([1 << i for i in range(64)] if outer >= 1 else []) + (
        [1 << i | 1 << j for i in range(64) for j in range(i)] if outer >= 2 else [])
    # Spark sizes rows as if they were not exploded: left alone it would put all of ``near`` into one task and broadcast the
    # points of one side of a join.  So the partitions are stated and a window stands for the join; a point has at most as
    # many fingerprints as the ball has points.
    near = near.repartition(int(near.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    around = near.select("fp", F.explode(F.lit([signed(v) for v in ball])).alias("z")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("z").cast("long")).alias("point"), (F.bit_count("z") <= inner).alias("close"))
    led = around.withColumn("a", F.min(F.when(F.col("close"), F.col("fp"))).over(W.partitionBy("point")))
    return led.where("a is not null and fp <> a").select(F.least("a", "fp").alias("a"), F.greatest("a", "fp").alias("b"))


def _rooted(fps: DataFrame, distance: int) -> DataFrame:
    """fp, least (smallest doc_id with it) and root (what all fingerprints of a component share)."""
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(linked(classes.select("fp"), distance)).toDF("fp", "root")
    return classes.join(found, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words_in_shingle: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links)."""
    fps = stored(fingerprints(docs, words_in_shingle), "fingerprints")
    rooted = _rooted(fps, distance)
    label = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stored(rooted.join(label, "root").select("fp", "component_id"), "labels")
    return fps.join(of, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, words_in_shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one document of each component: of its smallest id, and of
    several texts under that id the one with the least hash.  An id that has
    texts in several components keeps one in each.  Rows with a null doc_id stay."""
    fps = stored(_with_hash(docs, words_in_shingle).where("doc_id is not null"), "fingerprints")
    rooted = stored(_rooted(fps, distance).select("fp", "root"), "roots")
    # min() before the shuffle: a component of any size is one row from each task
    stay = (fps.join(rooted, "fp").groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
            .select(F.col("k.doc_id").alias("_stay"), F.col("k.text_hash").alias("_hash")).distinct())
    text_hash, nth = free_name(docs.columns, "_text_hash"), free_name(docs.columns, "_nth")
    known = docs.where(docs["doc_id"].isNotNull()).withColumn(text_hash, F.xxhash64(docs["text"]))
    rows = known.join(stay, (known["doc_id"].cast("long") == stay["_stay"]) & (known[text_hash] == stay["_hash"]), "left_semi")
    one = rows.withColumn(nth, F.row_number().over(W.partitionBy("doc_id", text_hash).orderBy("text"))).where(
        F.col(nth) == 1).drop(nth, text_hash)
    return one.unionByName(docs.where(docs["doc_id"].isNull()))


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
