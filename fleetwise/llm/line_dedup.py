"""Line dedup by an exact set-similarity join.

A line's tokens (lower-case runs of letters and digits) form a set; two lines
match if the Jaccard similarity of their sets is ``SIMILARITY`` or more, and a
line that matches an earlier one (by doc_id, then line number) is removed.

1. A line becomes the set of its tokens' 64-bit hashes, in one pass over the
   texts; no other step carries the sets of all lines.  Lines with equal sets
   are one class, summed with partial aggregation, so a line that fills a
   third of the corpus is one row from each task.
2. The hashes of a line are put in order of rarity: by the level (a quarter of
   a power of two) of their bucket in a table of ``1 << RARITY_BITS`` counts
   over all lines (a fixed size), then by the rest of the hash.  Any fixed
   order gives right results; rare tokens first make few candidates.
3. Classes of sizes m <= n that match share at least
   ``o = ceil(s / (1 + s) * (m + n))`` tokens, so they share one among the
   first m - o + 1 codes of the one and n - o + 1 of the other (prefix
   filter).  Only a class's first n - ceil(s * n) + 1 codes are ever such, and
   classes are joined on these; 32 bits of each will do, since two tokens
   taken for one only make a candidate more.  Sets that match are of like
   sizes, so a token is joined within a band of sizes and with the next band
   only: lines of all lengths that share a token are not compared with each
   other.  In the join, the length filter
   (m >= s * n), the positional filter (the codes after the shared one must
   suffice) and a sketch prune candidates: 128 bits, each the parity of the
   tokens that fall on it.  Every bit in which two sketches differ stands for a
   token that only one set has, of which m + n - 2 * o are allowed, so no match
   is lost; unlike bits that are merely set, parities tell long lines apart too.
4. Those left are verified on the whole sets of the classes in them.  These
   are read from the lines again: a broadcast bitmap of the wanted classes, of
   ``1 << MARK_BITS`` words at most, leaves out most other lines before the
   join that leaves out the rest.

Everything is DataFrame functions.  Adaptive execution splits a token that
many classes share; no pairs arise within a class.

Defined cases: null and empty texts have no line; lines without a token match
nothing and stay; two lines at the same place (rows that repeat an id) are
neither the earlier one; a null doc_id comes first; an empty table gives no
row; other columns stay as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwise.llm.common import free_name, stored

SIMILARITY = 0.8
RARITY_BITS = 18
MARK_BITS = 20
#: Width of a band of sizes, in steps of 1 / similarity.
BAND = 4
TOKEN = r"[\p{L}\p{N}]+"
#: With these, what a written DataFrame has shuffled is freed when it is written, and files are smaller.
_WHILE_WRITTEN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


def _kept(df: DataFrame, what: str) -> DataFrame:
    """``stored``, without the shuffles that led to it."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in _WHILE_WRITTEN}
    try:
        for k, v in _WHILE_WRITTEN.items():
            conf.set(k, v)
        return stored(df, what)
    finally:
        for k, v in before.items():
            conf.set(k, v)


def rarity(held: DataFrame) -> Column:
    """The levels (0 to 127) of the token buckets, rarest first, as a constant array."""
    n = 1 << RARITY_BITS
    tokens = held.select(F.explode("codes").alias("t"))
    # one row per bucket: 262,144 at most
    counts = tokens.groupBy(F.col("t").bitwiseAND(n - 1).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    level = [0] * n
    for b, v in counts.select("b", F.least(F.lit(127), F.floor(4 * F.log2("n"))).cast("int")).collect():
        level[b] = v
    return F.split(F.lit(",".join(map(str, level))), ",").cast("array<int>")


def _codes(text: Column) -> Column:
    """Sorted, distinct hashes of the tokens."""
    words = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return F.sort_array(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def _by_rarity(codes: Column, levels: Column) -> Column:
    """The hashes with their bucket's level in front, rarest first; they lose their last 8 bits.  None can be null, and
    the type says so: Spark then sorts bare longs."""
    def ranked(h):
        level = F.get(levels, h.bitwiseAND((1 << RARITY_BITS) - 1).cast("int")).cast("long")
        return F.coalesce(F.shiftleft(level, 56).bitwiseOR(F.shiftrightunsigned(h, 8)), F.lit(0).cast("long"))
    return F.sort_array(F.transform(codes, ranked))


def _bit(h: Column, at: int) -> Column:
    """One of 64 bits, by the six bits of a hash from ``at`` on."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, at).bitwiseAND(63).cast("int"))


def _sketch(codes: Column, low: bool) -> Column:
    """A half of the 128 parities; the sign of a hash says to which half it belongs."""
    none = F.lit(0).cast("long")
    return F.aggregate(codes, none, lambda x, c: x.bitwiseXOR(F.when((c < 0) == F.lit(low), _bit(c, 57)).otherwise(none)))


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0) and line of every line."""
    return docs.where(docs["text"] != "").select(docs["doc_id"].alias("doc_id"), F.posexplode_outer(
        F.split(docs["text"], "\n", -1)).alias("line_no", "line"))


def _overlap(m: Column, n: Column, s: float) -> Column:
    """Tokens that sets of m and n must share."""
    return F.ceil(F.lit(s / (1 + s)) * (m + n) - 1e-9)


def _band(n: Column, s: float) -> Column:
    """Band of a size; sizes that can match are in the same band or in neighbouring ones."""
    return F.floor(F.log(n) / (BAND * math.log(1 / s) + 1e-6))


def _prefix_rows(classes: DataFrame, s: float) -> DataFrame:
    """A row for each prefix token of a class: token and band of sizes in one number, class number, size and the token's
    position in one number, and the sketch."""
    rows = classes.select("k", "n", "low", "high", _band(F.col("n"), s).alias("band"), F.posexplode("few").alias("at", "token"))
    key = F.shiftleft(F.col("token").cast("long"), 32).bitwiseOR(F.col("band"))
    return rows.select(key.alias("key"), "k", F.shiftleft("n", 32).bitwiseOR(F.col("at").cast("long")).alias("n_at"), "low", "high")


def _size_at(side: str = "") -> tuple[Column, Column]:
    return F.shiftright(f"{side}n_at", 32), F.col(f"{side}n_at").bitwiseAND((1 << 32) - 1)


def _joined(smaller: DataFrame, larger: DataFrame, s: float, within: bool) -> DataFrame:
    """Pairs (a, b) of class numbers that pass all filters."""
    x, y = (rows.select([F.col(c).alias(f"{side}_{c}") for c in rows.columns]) for side, rows in (("x", smaller), ("y", larger)))
    (x_n, x_at), (y_n, y_at) = _size_at("x_"), _size_at("y_")
    need = _overlap(x_n, y_n, s)
    on = F.col("x_key") == F.col("y_key")
    if within:
        on &= (x_n < y_n) | ((x_n == y_n) & (F.col("x_k") < F.col("y_k")))
    suffices = F.least(x_n - x_at, y_n - y_at) >= need
    differ = sum(F.bit_count(F.col(f"x_{half}").bitwiseXOR(F.col(f"y_{half}"))) for half in ("low", "high"))
    pairs = x.join(y, on & (x_n >= y_n * s - 1e-9) & suffices & (differ <= x_n + y_n - 2 * need))
    return pairs.select(F.col("x_k").alias("a"), F.col("y_k").alias("b")).distinct()


def _candidates(classes: DataFrame, s: float) -> DataFrame:
    """Pairs within a band of sizes, and pairs of one band and the next: of the smaller sizes those that reach the next
    band, with the tokens that a pair with a set no smaller can share first, and of the larger those that are reached."""
    rows = _prefix_rows(classes, s)
    n, at = _size_at()
    band = _band(n, s)
    up = rows.where((_band(n / s * (1 + 1e-6), s) > band) & (n - at >= _overlap(n, n, s))).withColumn("key", F.col("key") + 1)
    down = rows.where(_band(n * s * (1 - 1e-6), s) < band)
    across = _kept(_joined(up, down, s, False), "line-pairs-across")
    return _joined(rows, rows, s, True).union(across)


def _sets(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The codes of the wanted classes, from the lines."""
    word = F.shiftrightunsigned("c1", 64 - MARK_BITS)
    marks = wanted.groupBy(word.alias("word")).agg(F.bit_or(_bit(F.col("c1"), 58 - MARK_BITS)).alias("marks"))
    some = keyed.join(F.broadcast(marks), word == F.col("word")).where(F.col("marks").bitwiseAND(_bit(F.col("c1"), 58 - MARK_BITS)) != 0)
    return some.groupBy("c1", "c2").agg(F.first("codes").alias("codes")).join(wanted, ["c1", "c2"])


def matched_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, line_no, class_id (hex; equal for lines with equal sets), n_links
    (other classes it matches) and removed, of every line with a token."""
    s = similarity
    codes, n = F.col("codes"), F.size("codes")
    held = _kept(lines(docs).select("doc_id", "line_no", _codes(F.col("line")).alias("codes")), "lines").where(n > 0)
    keyed = held.select("doc_id", "line_no", F.xxhash64(codes).alias("c1"), F.xxhash64(F.reverse(codes), F.lit(1)).alias("c2"), "codes")
    at = F.struct("doc_id", "line_no")
    # the arguments of a function with a lambda are interpreted: the sort is a step of its own, to be compiled
    ordered = keyed.select("c1", "c2", at.alias("at"), "codes", _by_rarity(codes, rarity(held)).alias("ranked"))
    n = F.size("ranked")
    few = F.slice("ranked", 1, (n - F.ceil(n * s - 1e-9) + 1).cast("int"))
    brief = {"n": n.cast("long"), "low": _sketch(codes, True), "high": _sketch(codes, False), "few": F.transform(few, lambda c: F.hash(c))}
    of_class = ordered.select("c1", "c2", "at", *[v.alias(k) for k, v in brief.items()]).groupBy("c1", "c2").agg(
        F.min("at").alias("first"), *[F.first(k).alias(k) for k in brief])
    classes = _kept(of_class.withColumn("k", F.monotonically_increasing_id()), "line-classes")
    # a set of n tokens matches another one only if one token more or less is similar enough
    open_ = classes.where(F.col("n") >= s * (F.col("n") + 1) - 1e-9)
    found = _kept(_candidates(open_, s), "line-pairs")
    named = found.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    wanted = _kept(classes.select("k", "c1", "c2", "first").join(named, "k", "left_semi"), "line-wanted")
    sets = _kept(_sets(keyed, wanted), "line-sets")
    x, y = (sets.select(F.col("k").alias(k), F.col("codes").alias(f"{k}_codes"), F.col("first").alias(f"{k}_first")) for k in "ab")
    both = found.join(x, "a").join(y, "b").withColumn("shared", F.size(F.array_intersect("a_codes", "b_codes")))
    links = both.where(F.col("shared") >= F.lit(s) * (F.size("a_codes") + F.size("b_codes") - F.col("shared")) - 1e-9)
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("k"), F.col("b_first").alias("other")),
                                          F.struct(F.col("b").alias("k"), F.col("a_first").alias("other")))).alias("e")).select("e.*")
    near = ends.groupBy("k").agg(F.count(F.lit(1)).alias("n_links"), F.min("other").alias("other"))
    of = _kept(classes.select("k", "c1", "c2", "first").join(near, "k", "left").select(
        "c1", "c2", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.least("first", "other").alias("earliest")), "line-links")
    rows = keyed.select("doc_id", "line_no", "c1", "c2").join(of, ["c1", "c2"])
    hexed = F.concat(*[F.lower(F.lpad(F.hex(k), 16, "0")) for k in ("c1", "c2")])
    return rows.select("doc_id", F.col("line_no").cast("long").alias("line_no"), hexed.alias("class_id"), "n_links",
                       (F.col("earliest") < at).alias("removed"))


def without_matched_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the removed lines taken out of the text."""
    gone = matched_lines(docs, similarity).where("removed").groupBy("doc_id").agg(F.collect_set("line_no").alias("_gone"))
    name = free_name(docs.columns, "_gone")
    gone = gone.select(F.col("doc_id").alias(f"{name}_id"), F.col("_gone").alias(name))
    kept = F.filter(F.split(docs["text"], "\n", -1), lambda x, i: ~F.coalesce(F.array_contains(name, i.cast("long")), F.lit(False)))
    out = docs.join(gone, docs["doc_id"].eqNullSafe(F.col(f"{name}_id")), "left")
    return out.select(*[F.when(F.col(name).isNull(), docs[c]).otherwise(F.concat_ws("\n", kept)).alias(c)
                        if c.lower() == "text" else docs[c] for c in docs.columns])
