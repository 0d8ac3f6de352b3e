"""Benchmark decontamination by spaced-seed hashing.

Texts and benchmark items become lower-case tokens (runs of letters and
digits).  A *spaced seed* hashes the tokens at the places a fixed mask selects
and ignores those between, so a substituted token spoils few seeds: with a
span of 8 and 5 selected places, either mask of ``MASKS`` hits every window of
13 tokens that has up to two substitutions, and 12 tokens alike.  A shorter
item is the window itself: its places are dealt into groups, and for every
choice of as many groups as it may have substitutions there is a mask that
leaves them out (up to 4 tokens, which must all agree, one mask takes all).
The documents get the seeds of those lengths only that some item has.

Seeds of all documents are joined to the seeds of the items.  A hit names a
document, an item and a diagonal (difference of places); around it the tokens
are compared one to one.  A document is contaminated by an item if some
``WINDOW`` consecutive tokens of the item (all of them, if it has fewer) agree
with the document's in at least ``SIMILARITY`` of the places.

Everything is DataFrame functions.  Seeds leave the scan as bare numbers with
the text's two hashes; the join is a broadcast only while the items have at
most ``BROADCAST_SEEDS`` different seeds (counted), else by shuffle.  A seed
that many documents share costs a row for each, and only those that some item
has go on; the texts with hits are then read again.

Defined cases: null or empty texts and items have no token; items of any
length from 1 token take part; documents with
equal texts share their answer, also under a null doc_id; items with equal
tokens are reported under each of their ids; repeated rows are reported once
for an id; empty tables give no row.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwise.llm.common import stored

MASKS = ((0, 1, 3, 6, 7), (0, 1, 4, 6, 7))
SPAN = 8
WINDOW = 13
SIMILARITY = 0.8
BROADCAST_SEEDS = 2_000_000  # 8 bytes each
BETWEEN = r"[^\p{L}\p{N}]+"


def token_hashes(text: Column) -> Column:
    """One number per token."""
    words = F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Places of an item of ``n`` tokens, so that some mask is free of any substitutions the rule accepts."""
    spoilt = next(k for k in range(n, -1, -1) if n - k >= SIMILARITY * n)
    least = min(len(MASKS[0]), n - spoilt)
    for groups in range(spoilt + 1, n + 1):
        masks = [tuple(i for i in range(n) if i * groups // n not in out) for out in combinations(range(groups), spoilt)]
        if min(map(len, masks)) >= least:
            return masks
    raise AssertionError("one place in each group always does")


def _from_first(mask: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(i - mask[0] for i in mask)


SHORT = {n: short_masks(n) for n in range(1, WINDOW - 1)}
NUMBERS = {m: k for k, m in enumerate(dict.fromkeys([*MASKS, *(_from_first(m) for of in SHORT.values() for m in of)]))}


def _seed(tokens: Column, mask: tuple[int, ...], at: Column) -> Column:
    return F.xxhash64(F.lit(NUMBERS[mask]), *[tokens[at + o] for o in mask])


def _seeds(tokens: Column, size: Column, masks: list[tuple[int, ...]], span: int) -> Column:
    """The seeds of all places, mask after mask; fewer tokens than a span give none."""
    places = F.when(size >= span, F.sequence(F.lit(0), size - span)).otherwise(F.array().cast("array<int>"))

    def under(mask: tuple[int, ...]):
        return lambda i: _seed(tokens, mask, i)

    return F.concat(*[F.transform(places, under(m)) for m in masks])


def _seed_rows(rows: DataFrame, *keep: str, masks: list[tuple[int, ...]] = MASKS) -> DataFrame:
    """``rows`` (keep.., tokens) -> keep.., seed, place; the masks have one span."""
    span = masks[0][-1] + 1
    # the outer form keeps the optimizer from working out the arrays a second time in an inferred filter
    sized = rows.withColumn("size", F.size("tokens"))
    found = sized.select(*keep, F.greatest(F.col("size") - span + 1, F.lit(1)).alias("places"),
                         _seeds(F.col("tokens"), F.col("size"), masks, span).alias("seeds"))
    return found.select(*keep, "places", F.posexplode_outer("seeds").alias("at", "seed")).select(
        *keep, "seed", (F.col("at") % F.col("places")).alias("place"))


def _short_seed_rows(items: DataFrame, n: int) -> DataFrame:
    """The seeds of the items of ``n`` tokens: item, seed, place."""
    seeds = F.array(*[F.struct(_seed(F.col("tokens"), _from_first(m), F.lit(m[0])).alias("seed"), F.lit(m[0]).alias("place"))
                      for m in SHORT[n]])
    return items.where(F.size("tokens") == n).select("item", F.explode(seeds).alias("s")).select("item", "s.seed", "s.place")


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, text and the two hashes that name the text."""
    raw = docs["text"].cast("binary")
    return docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), F.xxhash64(raw).alias("t"),
                       F.coalesce(F.crc32(raw), F.lit(0)).alias("u"))


def _verified(docs: DataFrame, items: DataFrame) -> DataFrame:
    """t, u, item, matched, window: the best window of each item in each text."""
    lengths = sorted(r["n"] for r in items.select(F.size("tokens").alias("n")).where(F.col("n").isin(*SHORT)).distinct().collect())
    found = _seed_rows(items.where(~F.size("tokens").isin(*SHORT)), "item").where("seed is not null")
    for n in lengths:
        found = found.union(_short_seed_rows(items, n))
    seeds = stored(found, "item-seeds")
    distinct = seeds.select("seed").distinct()
    few = distinct.count() <= BROADCAST_SEEDS
    texts = docs.select("t", "u", token_hashes(F.col("text")).alias("tokens"))
    rows = _seed_rows(texts, "t", "u")
    short: dict[int, dict] = {}
    for mask in dict.fromkeys(_from_first(m) for n in lengths for m in SHORT[n]):
        short.setdefault(mask[-1], {})[mask] = None
    for masks in short.values():
        rows = rows.union(_seed_rows(texts, "t", "u", masks=list(masks)))
    hits = rows.join(F.broadcast(distinct) if few else distinct, "seed", "left_semi")
    diagonals = stored(hits.join(seeds.withColumnRenamed("place", "item_place"), "seed")
                       .select("t", "u", "item", (F.col("place") - F.col("item_place")).alias("shift")).distinct(), "hits")
    again = (docs.join(diagonals.select("t", "u").distinct(), ["t", "u"], "left_semi")
             .groupBy("t", "u").agg(F.first("text").alias("text"))
             .select("t", "u", token_hashes(F.col("text")).alias("tokens")))
    pairs = (diagonals.join(items.select("item", F.col("tokens").alias("of_item")), "item").join(again, ["t", "u"])
             .select("t", "u", "item", F.size("of_item").alias("n"), "shift", "of_item",
                     F.slice("tokens", F.greatest(F.col("shift") + 1, F.lit(1)), F.size("of_item")).alias("part")))
    # place j of the item lies at j + shift; the cut-out part begins at max(shift, 0)
    lead = F.least(F.col("shift"), F.lit(0))
    same = F.transform(F.col("of_item"), lambda w, j: F.coalesce(
        (F.get(F.col("part"), j + lead) == w).cast("int"), F.lit(0)))
    pairs = pairs.withColumn("same", same).withColumn("window", F.least(F.col("n"), F.lit(WINDOW)))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.col("n") - F.col("window") + 1), lambda j: F.aggregate(
        F.slice(F.col("same"), j, F.col("window")), F.lit(0), lambda x, y: x + y)))
    return (pairs.select("t", "u", "item", "window", best.alias("matched"))
            .where(F.col("matched") >= F.lit(SIMILARITY) * F.col("window"))
            .groupBy("t", "u", "item").agg(F.max("matched").alias("matched"), F.max("window").alias("window")))


def _items(benchmark: DataFrame) -> DataFrame:
    tokens = benchmark.select(benchmark["item_id"].alias("item_id"), token_hashes(benchmark["text"]).alias("tokens"))
    return tokens.where(F.size("tokens") >= 1).withColumn("item", F.xxhash64("tokens"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched and window (tokens that agree in the best
    window, and its length) of every overlap; ``docs`` needs doc_id and text,
    ``benchmark`` item_id and text."""
    items = stored(_items(benchmark), "items")
    named = _named(docs)
    found = _verified(named, items.groupBy("item").agg(F.first("tokens").alias("tokens")))
    of_item = items.select("item", "item_id").distinct()
    ids = named.select("doc_id", "t", "u").distinct()
    return ids.join(found.join(of_item, "item"), ["t", "u"]).groupBy("doc_id", "item_id").agg(
        F.max("matched").cast("long").alias("matched"), F.max("window").cast("long").alias("window"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap an item."""
    items = stored(_items(benchmark), "items")
    found = stored(_verified(_named(docs), items.groupBy("item").agg(F.first("tokens").alias("tokens")))
                   .select(F.col("t").alias("_leak_t"), F.col("u").alias("_leak_u")).distinct(), "leaks")
    raw = docs["text"].cast("binary")
    return docs.join(found, (F.xxhash64(raw) == found["_leak_t"]) & (F.coalesce(F.crc32(raw), F.lit(0)) == found["_leak_u"]),
                     "left_anti")
