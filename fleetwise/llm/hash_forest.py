"""Approximate nearest neighbours by a forest of hash prefixes.

Every vector gets one long hash string per tree: ``BITS`` signs of products
with random directions (fixed by ``seed``; centred on the mean of at most
``SAMPLE`` vectors chosen by hash).  A tree is the sorted array of its
strings; the vectors that share a prefix lie side by side in it.  A query
descends in all trees to its longest matches and then ascends in all of them
at the same time, one prefix length after the other, until the ranges passed
hold ``share`` times the block's vectors (repeats over trees counted), and
so many that k + 1 of them differ.  Those
candidates are compared by their exact cosine.

The index is cut into blocks of about ``BLOCK`` different vectors by a hash,
each with sorted arrays of its own, and the stated queries into blocks of as
many: a (query block, index block) pair is one group that fits one task,
whatever the input's size.  Each group yields the k + 1 best ids of a query
(an id scores what the best of its vectors does), and a window over the query
joins the blocks' answers.

The ascent stops at a share of the rows, not at a number of them, because
recall must hold at every size.  On vectors without structure (isotropic
noise, as in the tables at hand) no hash narrows the search much: 0.9 recall
takes about half of all vectors, and the cost is that of a search in blocks.
On clustered vectors a far smaller ``share`` does.

Equal vectors are one class, named by its 64-bit hash: the k + 1 smallest ids
of a class stand for all of it, and the queries of a class are answered once.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do null ids; a vector of another length than
the query's is no candidate; repeated rows (same id and vector) count once; an
id with several vectors is searched with each of them, and ranks of its
answers run over all; vectors are scaled by their largest component, so that
none is too long or short for double precision; ties go to the smaller id; fewer candidates than k give them all; an empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwise.llm.common import stored

TREES, BITS = 16, 24
BLOCK, QUERIES = 8192, 2048
SHARE = 0.9
SAMPLE = 4096


class Forest:
    """Sorted arrays of one block's hash strings."""

    def __init__(self, vectors: np.ndarray, center: np.ndarray, seed: int = 11):
        dim = vectors.shape[1]
        self.center = center if len(center) == dim else np.zeros(dim)
        self.planes = np.random.default_rng([seed, dim]).standard_normal((TREES, dim, BITS))
        strings = self.strings(vectors)
        self.order = [np.argsort(s, kind="stable") for s in strings]
        self.sorted = [s[o] for s, o in zip(strings, self.order)]
        self.n = len(vectors)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """The hash strings as numbers, first sign in the highest bit: trees x vectors."""
        x, norms = scaled(vectors)
        unit = x / norms[:, None] - self.center
        place = np.int64(1) << np.arange(BITS - 1, -1, -1)
        return np.stack([(unit @ p > 0) @ place for p in self.planes])

    def candidates(self, queries: np.ndarray, share: float, least: int) -> Iterator[np.ndarray]:
        """For each query the rows passed when all trees have ascended far
        enough; ``least`` different ones, if the block has them."""
        strings = self.strings(queries)
        need = min(max(share * self.n, TREES * least), TREES * self.n)
        low = np.zeros((TREES, len(queries)), np.int64)
        high = np.full((TREES, len(queries)), self.n)
        open_ = np.arange(len(queries))
        for length in range(BITS, -1, -1):  # ascend one sign in every tree
            if not len(open_):
                break
            cut = BITS - length
            for t in range(TREES):
                first = strings[t, open_] >> cut << cut
                low[t, open_] = np.searchsorted(self.sorted[t], first)
                high[t, open_] = np.searchsorted(self.sorted[t], first + (1 << cut))
            open_ = open_[(high[:, open_] - low[:, open_]).sum(axis=0) < need]
        for q in range(len(queries)):
            passed = np.zeros(self.n, bool)
            for t in range(TREES):
                passed[self.order[t][low[t, q]:high[t, q]]] = True
            yield np.flatnonzero(passed)


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by their largest component, so that no square over- or underflows, and their norms then."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x, np.sqrt((x * x).sum(axis=1))


def _best_ids(score: np.ndarray, ids: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k + 1 best different ids, an id scoring what the best of its vectors does; ties to the smaller id."""
    order, found = np.argsort(-score, kind="stable"), {}
    worst = -np.inf
    for i in order:
        if score[i] < worst:  # k + 1 ids have more, and vectors of equal score are all in
            break
        for v in ids[i]:
            found.setdefault(int(v), score[i])
        if len(found) > k and worst == -np.inf:
            worst = score[i]
    best = sorted(found, key=lambda v: (-found[v], v))[:k + 1]
    return np.array(best, np.int64), np.array([found[v] for v in best])


def _search(k: int, share: float, center: np.ndarray):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        is_query = group["is_query"].to_numpy()
        vectors = group["vector"].map(lambda v: np.asarray(v, np.float64))
        size = vectors.map(len).to_numpy()
        classes, ids = group["class"].to_numpy(), group["ids"].to_numpy()
        out = []
        for dim in np.unique(size[is_query]):
            qs, rows = np.flatnonzero(is_query & (size == dim)), np.flatnonzero(~is_query & (size == dim))
            if not len(rows):
                continue
            x, norms = scaled(np.stack(vectors.iloc[rows].to_list()))
            q, q_norms = scaled(np.stack(vectors.iloc[qs].to_list()))
            for i, at in enumerate(Forest(x, center).candidates(q, share, k + 1)):
                rough = (x[at] @ q[i]) / (norms[at] * q_norms[i])
                # ids may share a class and a class may have several ids: cut a little below what k + 1 classes reach, as long
                # as that leaves k + 1 ids, and take those scores again, summed in one order wherever a row stands
                least, wide = len(at) - 1, 4 * (k + 1)
                while True:
                    some = at if wide > least else at[rough >= np.partition(rough, -wide)[-wide] - 1e-9]
                    if len(some) == len(at) or len({v for c in some for v in ids[rows[c]]}) > k:
                        break
                    wide *= 4
                exact = (x[some] * q[i]).sum(axis=1) / (norms[some] * q_norms[i])
                best, score = _best_ids(exact, [ids[rows[c]] for c in some], k)
                out.append((np.full(len(best), classes[qs[i]]), best, score))
        if not out:
            out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        return pd.DataFrame(dict(zip(["qclass", "vec_id", "score"], map(np.concatenate, zip(*out)))))
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, share: float = SHARE,
            vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score (cosine) of the ``k`` nearest
    vectors found for every row that ``is_query`` picks, its own id left out."""
    v = F.col("vector")
    fit = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query")).where("id is not null and vector is not null").where(fit)
    rows = rows.withColumn("hash", F.xxhash64("vector"))
    # the k + 1 smallest ids of each different vector; the row_number limit is applied before the shuffle too
    of = W.partitionBy("hash", "vector").orderBy("id")
    named = stored(rows.select("id", "hash", "vector").withColumn("nth", F.dense_rank().over(of)).where(F.col("nth") <= k + 1)
                   .groupBy("hash", "vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
                   .withColumnRenamed("hash", "class"), "vectors")
    asked = stored(rows.where("is_query").select("id", F.col("hash").alias("class")).distinct(), "queries")
    wanted = asked.select("class").distinct().join(named, "class").select("class", "ids", "vector")

    n, m = named.count(), wanted.count()
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-m // QUERIES))
    sample = named.orderBy("class").limit(SAMPLE).select("vector").toPandas()["vector"].map(lambda x: np.asarray(x, np.float64))
    center = np.zeros(0)
    if len(sample):
        dim = sample.map(len).mode().iloc[0]
        units = [(y / n_) for y, n_ in (scaled(x[None]) for x in sample if len(x) == dim)]
        center = np.mean(units, axis=0)[0]

    hashed = F.xxhash64(F.col("class"), F.lit(1))
    index = named.select(F.pmod(hashed, F.lit(blocks)).alias("block"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "class", "ids", "vector",
                         F.lit(False).alias("is_query"))
    ask = wanted.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
                        F.pmod(hashed, F.lit(parts)).alias("part"), "class", "ids", "vector", F.lit(True).alias("is_query"))
    found = index.unionByName(ask).groupBy("block", "part").applyInPandas(
        _search(k, share, center), "qclass long, vec_id long, score double")
    # per query class the k + 1 best ids over all blocks, an id once, with its best score
    each = found.groupBy("qclass", "vec_id").agg(F.max("score").alias("score"))
    best = (each.withColumn("nth", F.row_number().over(W.partitionBy("qclass").orderBy(F.col("score").desc(), "vec_id")))
            .where(F.col("nth") <= k + 1).groupBy("qclass")
            .agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("best")))
    own = asked.join(best, asked["class"] == best["qclass"]).select(
        F.col("id").alias("query_id"), F.explode(F.filter("best", lambda b: b["vec_id"] != F.col("id"))).alias("b"))
    one = own.groupBy("query_id", "b.vec_id").agg(F.max("b.score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return one.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
