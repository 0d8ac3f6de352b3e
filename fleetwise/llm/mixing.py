"""Mixing sources to target weights.

Every document gets a hash-random key (md5 of seed, id and text).  Within a
source, the mix runs through the documents in key order, epoch after epoch,
until the source's budget of words is used up, and cuts there to the word.

Where the cut falls is found without sorting a source in one task: the key's
leading hex digits range-partition each source into ``16 ** DIGITS`` buckets
whose word counts are summed with partial aggregation; prefix sums over the
buckets (at most 4096 rows a source) name the bucket in which the budget
ends, and only that bucket's rows are prefix-summed by key.  What remains is
one row per source (its epochs and its cut key), joined to the documents.

Targets: the sources in code-point order, null last, have the ``weights`` in
turn, and share ``share`` times all words; a target stops at ``cap`` times its
source's words and the excess is shared anew by weight.  In ascending order
of cap / weight the capped sources come first, so prefix sums settle the
level in one pass.

Defined cases: a null text has no words; documents without words are kept
with nothing taken; a null source is a source of its own; identical rows
(same id and text) at the cut share what is left evenly, rounded down; an
empty table gives no row; columns of other names are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwise.llm.common import free_name, n_words, stored

DIGITS = 3
WEIGHTS = (5, 2, 1)


def running(df: DataFrame, order: Sequence, sums: dict) -> DataFrame:
    """``df`` with inclusive running sums in ``order`` over all rows: range
    partitions, a running sum in each, and the totals of those before it (one
    row per partition)."""
    ranged = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_part", F.spark_partition_id()), "ranged")
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    base = totals.select("_part", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    return (ranged.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()}).join(base, "_part")
            .withColumns({n: F.col(n) + F.col(f"_b_{n}") for n in sums})
            .drop("_part", *[f"_b_{n}" for n in sums]))


def _keyed(docs: DataFrame, seed: str) -> dict:
    """Expressions of the four columns the mix works on."""
    return {"no_source": docs["source"].isNull(), "source_name": F.coalesce(docs["source"].cast("string"), F.lit("")),
            "size": n_words(docs["text"]),
            "key": F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(docs["doc_id"].cast("string"), F.lit("")),
                                     F.coalesce(F.md5(docs["text"].cast("binary")), F.lit(""))).cast("binary"))}


SOURCE = ["no_source", "source_name"]


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """One row per source of ``sizes`` (no_source, source_name, source_size): its weight and target."""
    ranked = running(sizes, SOURCE, {"rank": F.lit(1)})
    turn = F.array(*[F.lit(float(w)) for w in weights])
    level = ranked.select(*SOURCE, "source_size",
                          F.element_at(turn, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight"))
    level = level.withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
    summed = stored(running(level, [F.col("limit") / F.col("weight"), *SOURCE], {"limits": F.col("limit"), "weights": F.col("weight")}),
                    "levels")
    total = summed.agg((F.lit(float(share)) * F.coalesce(F.sum("source_size"), F.lit(0))).alias("total"),
                       F.coalesce(F.sum("weight"), F.lit(0.0)).alias("all_weights")).first()
    # capped: at the level reached when all before it are capped, it would get its limit or more
    capped = (F.col("limit") * (F.lit(total["all_weights"]) - F.col("weights") + F.col("weight"))
              <= (F.lit(total["total"]) - F.col("limits") + F.col("limit")) * F.col("weight"))
    summed = summed.withColumn("capped", capped)
    rest = summed.agg(F.coalesce(F.sum(F.when(F.col("capped"), F.col("limit"))), F.lit(0.0)).alias("limits"),
                      F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))), F.lit(0.0)).alias("weights")).first()
    open_weights = total["all_weights"] - rest["weights"]
    each = (total["total"] - rest["limits"]) / open_weights if open_weights > 0 else 0.0
    return summed.select(*SOURCE, "source_size",
                         F.when(F.col("capped"), F.col("limit")).otherwise(F.col("weight") * F.lit(each)).alias("target"))


def cuts(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
         seed: str = "mix") -> DataFrame:
    """One row per source: source_size, target, whole epochs, the key at which
    the last epoch ends, and what each row of that key still gives."""
    rows = stored(docs.select(*[c.alias(n) for n, c in _keyed(docs, seed).items()]), "mix")
    bucket = F.substring("key", 1, DIGITS)
    sums = stored(rows.groupBy(*SOURCE, bucket.alias("bucket")).agg(F.sum("size").alias("words")), "buckets")
    sizes = sums.groupBy(*SOURCE).agg(F.sum("words").alias("source_size"))
    of = source_targets(sizes, weights, share, cap)
    budget = F.floor("target").cast("long")
    of = stored(of.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size"))
                              .otherwise(F.lit(0)))
                .withColumn("rest", budget - F.col("epochs") * F.col("source_size")), "targets")
    upto = W.partitionBy(*SOURCE).orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    at = (sums.withColumn("upto", F.sum("words").over(upto)).join(of.where("rest > 0").select(*SOURCE, "rest"), SOURCE)
          .where("upto > rest and upto - words <= rest").select(*SOURCE, "bucket", (F.col("rest") - F.col("upto") + F.col("words")).alias("left_over")))
    near = (rows.withColumn("bucket", bucket).join(stored(at, "cut-buckets"), [*SOURCE, "bucket"])
            .groupBy(*SOURCE, "key", "left_over").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")))
    upto = W.partitionBy(*SOURCE).orderBy("key").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = (near.withColumn("upto", F.sum("words").over(upto)).where("upto > left_over and upto - words <= left_over")
           .select(*SOURCE, F.col("key").alias("cut_key"),
                   F.expr("cast((left_over - upto + words) div n as bigint)").alias("cut_words")))
    return stored(of.drop("rest").join(cut, SOURCE, "left"), "cuts")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
        seed: str = "mix") -> DataFrame:
    """``docs`` with size, source_size, target, epochs (whole copies in the
    mix), tail (words of one more, cut copy) and taken (words in all).  Needs
    doc_id, text and source; an existing column of such a name is replaced.

    The table of cuts has one row per source and is joined by its measured
    size: broadcast below the session's threshold, else by shuffle, where
    adaptive execution splits a hot source.
    """
    work = {free_name(docs.columns, f"_mix_{n}"): c for n, c in _keyed(docs, seed).items()}
    no_source, source_name, size, key = work
    rows = docs.withColumns(work)
    cut = cuts(docs, weights, share, cap, seed).toDF(no_source, source_name, *[f"_cut_{c}" for c in (
        "source_size", "target", "epochs", "key", "words")])
    rows = rows.join(cut, [no_source, source_name])
    in_tail = F.coalesce(F.col(key) < F.col("_cut_key"), F.lit(False))
    epochs = F.col("_cut_epochs") + in_tail.cast("long")
    tail = F.when(F.col(key) == F.col("_cut_key"), F.col("_cut_words")).otherwise(F.lit(0))
    new = {"size": F.col(size), "source_size": F.col("_cut_source_size"), "target": F.col("_cut_target"),
           "epochs": epochs, "tail": tail, "taken": epochs * F.col(size) + tail}
    kept = [c for c in docs.columns if c.lower() not in new]
    return rows.select(*[F.col(f"`{c}`") for c in kept], *[c.cast("double" if n == "target" else "long").alias(n) for n, c in new.items()])


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
          seed: str = "mix") -> DataFrame:
    """The mix itself, in the columns of ``docs``: each document as often as
    its epochs say; the document at its source's cut once more with its first
    ``tail`` words, joined by single blanks (and n_chars to match)."""
    plan = mix(docs.select(*[F.col(f"`{c}`").alias(f"_in_{c}") for c in docs.columns], "doc_id", "text", "source"),
               weights, share, cap, seed)
    copies = F.when(F.col("epochs") > 0, F.array_repeat(F.lit(0).cast("long"), F.col("epochs").cast("int"))).otherwise(
        F.array().cast("array<bigint>"))
    copies = F.concat(copies, F.when(F.col("tail") > 0, F.array("tail")).otherwise(F.array().cast("array<bigint>")))
    rows = plan.withColumn("_words", F.explode(copies))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    head = F.concat_ws(" ", F.slice(words, 1, F.col("_words").cast("int")))
    text = F.when(F.col("_words") > 0, head).otherwise(F.col("text"))
    out = []
    for c in docs.columns:
        at = F.col(f"`_in_{c}`")
        kind = docs.schema[c].dataType
        if c.lower() == "text":
            at = text
        elif c.lower() == "n_chars":
            at = F.when(F.col("_words") > 0, F.char_length(head).cast(kind)).otherwise(at)
        out.append(at.alias(c))
    return rows.select(*out)
