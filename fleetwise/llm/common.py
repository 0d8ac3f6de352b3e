"""Helpers the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwise.session import checkpoint_dir

#: A word is a run of anything but space and the ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, k: int) -> Column:
    """crc32 of the id's decimal text, modulo k (a null id counts as 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % k, F.lit(0)).cast("int")


def free_name(columns: Iterable[str], wish: str) -> str:
    """``wish``, with underscores put in front until no column has that name."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (two long columns) as rows
    (node, component) with the smallest node of each component.

    Alternating large-star and small-star rounds: both only regroup the edge
    list, every hot node is reduced to star edges, and the number of rounds is
    logarithmic in the longest path.  Each round is written to the shared
    folder, so no lineage grows and nothing is collected but two sums.
    Grouping uses min() with partial aggregation and a join on the node, so a
    hub is never gathered in one row.
    """
    cur = stored(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
                 .where("u < v").distinct(), "edges")
    last = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of n is linked to the smallest of n's neighbourhood
        both = cur.select(F.col("u").alias("n"), F.col("v").alias("x")).union(cur.select(F.col("v"), F.col("u")))
        low = both.groupBy("n").agg(F.min("x").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = (both.where("x > n").join(low, "n").select(F.col("m").alias("u"), F.col("x").alias("v"))
                 .where("u < v").distinct())
        # small star: every smaller neighbour of n, and n, is linked to the smallest of them
        down = large.select(F.col("v").alias("n"), F.col("u").alias("x"))
        low = down.groupBy("n").agg(F.min("x").alias("m"))
        small = (down.join(low, "n")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("u"), F.col("x").alias("v")),
                                           F.struct(F.col("m").alias("u"), F.col("n").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u < v").distinct())
        cur = stored(small, "edges")
        # settled when the edge list no longer changes: count and an order-free digest
        now = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = cur.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component"))
    return stars.union(cur.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
