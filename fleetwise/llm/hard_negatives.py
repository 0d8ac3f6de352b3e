"""Hard negatives by exact integer scores from residue matrices.

Components are made integers (``floor(scale * x)``).  The inner products of
many rows with many anchors are matrix products, done in float32 although the
scores need not fit it: the components are reduced modulo several small
primes, each prime's matrix product is exact (its sums stay within 2^24), and
the signed scores are put together from the residues by Chinese remaindering
in mixed radix with balanced digits.  How many primes a product takes follows
from the lengths of its vectors (Cauchy-Schwarz), so ordinary vectors need two
or three and nothing is ever rounded.

Two passes over the rows, both "stated anchors against all rows, in blocks":
the first finds each anchor's ``positives`` best rows of its own label, the
second, for each anchor and positive, the ``negatives`` best rows of other
labels whose score lies between ``low`` and ``high`` percent of the
positive's.  Rows and anchors are dealt to cells, a cell being one chunk of
anchors (``CHUNK_BYTES``) and one share of the rows.  A cell's rows come in
Arrow batches after its anchors and are never held: what stays is the best few
of each question, so memory does not depend on the input, one label or one
vector may hold any part of the rows, and no candidate is dropped that could
still be an answer.  Windows join the cells' answers.

Cells grow with the rows, so that there are about as many as shuffle
partitions; each row is sent once per chunk of anchors, each anchor once per
share of the rows.

Defined cases: rows with a null label, vector or id, or with a null or
non-finite component take no part (a row without id could not be named in the
result); nor do rows whose scaled vector has a squared length of 2^61 or more,
as their scores could leave 64 bits; rows repeated as a whole count once; rows
that share an anchor's id are neither its positives nor its negatives; several
vectors under one id are anchors and candidates each for itself; vectors of
another length than the anchor's are not compared with it (those of length 0
score 0 with each other); ties go to the smaller id; an anchor without
positives, or a positive without negatives, gives no row; an empty table gives
none; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwise.llm.common import stored

CHUNK_BYTES = 16 << 20  # components of one chunk of anchors, as 32-bit numbers
CELL_PAIRS = 1 << 23  # scores a cell should have at least
TILE = 1 << 20  # scores held at a time
SLICE = 4096  # components multiplied at once, so that primes of at least 7 bits keep sums exact
LOWEST = np.iinfo(np.int64).min


# ---------------------------------------------------------------- residues


@lru_cache(maxsize=64)
def primes(dim: int) -> tuple[int, ...]:
    """The odd primes, largest first, whose balanced residues keep a sum of ``dim`` products within 2^24."""
    most = 2 * int(((1 << 24) / max(dim, 1)) ** 0.5) + 1
    sieve = np.ones(min(most, 4095) + 1, bool)
    for p in range(2, int(len(sieve) ** 0.5) + 1):
        sieve[p * p::p] = False
    return tuple(int(p) for p in np.flatnonzero(sieve)[::-1] if p > 2)


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p in -(p-1)/2 .. (p-1)/2; exact for float64 whole numbers, as x / p is never near a half for odd p."""
    return x - p * np.rint(x / p)


class Residues:
    """The rows of an integer matrix modulo as many primes as a product asks for."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows.astype(np.float64)
        self.squares = np.einsum("ij,ij->i", self.rows, self.rows)
        self.planes: dict[int, np.ndarray] = {}

    def plane(self, p: int) -> np.ndarray:
        if p not in self.planes:
            self.planes[p] = _balanced(self.rows, p).astype(np.float32)
        return self.planes[p]


def products(a: Residues, at: slice, b: Residues, rows: slice) -> np.ndarray:
    """Exact inner products of ``a.rows[at]`` and ``b.rows[rows]`` as 64-bit integers."""
    dim = a.rows.shape[1]
    squares = a.squares[at].max(initial=0.0) * b.squares[rows].max(initial=0.0)
    bound = int(squares ** 0.5 * (1 + 1e-9)) + 1
    chosen, reach = [], 1
    for p in primes(min(dim, SLICE)):
        if reach > 2 * bound:
            break
        chosen.append(p)
        reach *= p
    digits: list[np.ndarray] = []
    for i, p in enumerate(chosen):
        x, y = a.plane(p)[at], b.plane(p)[rows]
        r = np.zeros((len(x), len(y)))
        for k in range(0, dim, SLICE):
            r += x[:, k:k + SLICE] @ y[:, k:k + SLICE].T
        for q, d in zip(chosen[:i], digits):  # take off the earlier digits
            r = _balanced(r - d, p) * pow(q, -1, p)
        digits.append(_balanced(r, p))
    score = np.zeros((len(a.rows[at]), len(b.rows[rows])), np.int64)
    for p, d in zip(chosen[::-1], digits[::-1]):
        score *= p
        score += d.astype(np.int64)
    return score


# ---------------------------------------------------------------- search


class Questions:
    """Anchors of one length and, for each of their ``low``/``high`` bounds,
    the best rows so far: of the anchor's own label, or of the others."""

    def __init__(self, nr, ids, labels, rows, low, high, own: bool, k: int):
        self.nr, self.ids, self.labels, self.own, self.k = nr, ids, labels, own, k
        self.vectors = Residues(rows)
        self.low, self.high = low, high
        n, asked = low.shape
        self.asked = asked
        self.score = np.full((n * asked, k), LOWEST)
        self.found = np.zeros((n * asked, k), np.int64)
        self.count = np.zeros(n * asked, np.int64)

    def see(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """Take a batch of rows into account; few at first, as the bounds rise with what is found."""
        batch, begin, size = Residues(rows), 0, 64
        while begin < len(ids):
            part = slice(begin, min(begin + size, len(ids)))
            step = max(1, TILE // (part.stop - part.start))
            for at in range(0, len(self.nr), step):
                self._tile(slice(at, min(at + step, len(self.nr))), ids, labels, batch, part)
            begin, size = part.stop, size * 8

    def _tile(self, at: slice, ids, labels, batch: Residues, part: slice) -> None:
        score = products(self.vectors, at, batch, part)
        first, last = at.start * self.asked, at.stop * self.asked
        # what a row needs at least for each question: its low bound, and the k-th best
        least = np.maximum(self.low[at].reshape(-1), self.score[first:last, -1]).reshape(-1, self.asked)
        fits = score >= least.min(axis=1)[:, None]
        fits &= score <= self.high[at].max(axis=1)[:, None]
        fits &= (self.labels[at][:, None] == labels[part][None, :]) == self.own
        fits &= self.ids[at][:, None] != ids[part][None, :]
        a, r = np.nonzero(fits)
        s, i = score[a, r], ids[part][r]
        for j in range(self.asked):
            q = first + a * self.asked + j
            full = self.count[q] == self.k
            better = (s > self.score[q, -1]) | ~full | (s == self.score[q, -1]) & (i < self.found[q, -1])
            good = better & (s >= self.low[at][a, j]) & (s <= self.high[at][a, j])
            if good.any():
                self._take(q[good], s[good], i[good])

    def _take(self, q: np.ndarray, s: np.ndarray, i: np.ndarray) -> None:
        """Keep the k best of what each question had and gets; ``q`` is ascending."""
        touched = np.unique(q)
        had = np.arange(self.k)[None, :] < self.count[touched][:, None]
        q = np.concatenate([np.repeat(touched, self.count[touched]), q])
        s = np.concatenate([self.score[touched][had], s])
        i = np.concatenate([self.found[touched][had], i])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, touched)
        nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        keep = nth < self.k
        q, s, i, nth = q[keep], s[keep], i[keep], nth[keep]
        self.score[touched] = LOWEST
        self.score[q, nth], self.found[q, nth] = s, i
        self.count[touched] = np.bincount(np.searchsorted(touched, q), minlength=len(touched))

    def answers(self) -> pa.RecordBatch:
        q, nth = np.nonzero(np.arange(self.k)[None, :] < self.count[:, None])
        return pa.RecordBatch.from_pydict({
            "nr": pa.array(self.nr[q // self.asked], pa.int64()), "nth": pa.array((q % self.asked + 1).astype(np.int32), pa.int32()),
            "found": pa.array(self.found[q, nth], pa.int64()), "score": pa.array(self.score[q, nth], pa.int64())})


_ANSWERS = "nr long, nth int, found long, score long"


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _search(own: bool, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, open_ = None, {}, {}

        def opened(dim: int) -> Questions | None:
            """The questions of one vector length; all of a cell's anchors come before its rows."""
            if dim in waiting:
                nr, ids, labels, rows, low, high = map(np.concatenate, zip(*waiting.pop(dim)))
                open_[dim] = Questions(nr, ids, labels, rows, low, high, own, k)
            return open_.get(dim)

        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cell").to_numpy()
            kind = batch.column("is_row").to_numpy(zero_copy_only=False)
            size = pc.list_value_length(batch.column("parts")).to_numpy()
            begin = np.flatnonzero(np.diff(cells, prepend=cells[0] - 1))
            for first, last in zip(begin, [*begin[1:], len(cells)]):
                if cells[first] != cell:
                    yield from (q.answers() for q in open_.values())
                    cell, waiting, open_ = cells[first], {}, {}
                for is_row in (False, True):
                    for dim in np.unique(size[first:last][kind[first:last] == is_row]):
                        mine = first + np.flatnonzero((kind[first:last] == is_row) & (size[first:last] == dim))
                        some = batch.take(pa.array(mine))
                        ids, labels = (some.column(c).to_numpy() for c in ("id", "label"))
                        rows = _matrix(some.column("parts"), dim)
                        if not is_row:
                            asked = len(some.column("low")[0])
                            low, high = (_matrix(some.column(c), asked) for c in ("low", "high"))
                            waiting.setdefault(dim, []).append((some.column("nr").to_numpy(), ids, labels, rows, low, high))
                        elif opened(dim):
                            open_[dim].see(ids, labels, rows)
        yield from (q.answers() for q in open_.values())
    return run


def _best(anchors: DataFrame, rows: DataFrame, own: bool, k: int, chunks: int, shares: int) -> DataFrame:
    """nr, nth (question of the anchor), rank, found and score: the k best rows for each question."""
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cell = F.col("chunk") * shares + F.col("share")
    ask = anchors.withColumn("chunk", F.pmod(F.xxhash64("nr"), F.lit(chunks))).withColumn("share", every(shares))
    seen = (rows.withColumn("share", F.pmod(F.xxhash64("id", "parts"), F.lit(shares))).withColumn("chunk", every(chunks))
            .withColumn("nr", F.lit(None).cast("long")).withColumn("low", F.lit(None).cast("array<long>")).withColumn("high", F.col("low")))
    columns = ["nr", "id", "label", "parts", "low", "high"]
    both = (ask.select(cell.alias("cell"), F.lit(False).alias("is_row"), *columns)
            .unionByName(seen.select(cell.alias("cell"), F.lit(True).alias("is_row"), *columns)))
    dealt = both.repartition(chunks * shares, "cell").sortWithinPartitions("cell", "is_row")
    found = dealt.mapInArrow(_search(own, k), _ANSWERS)
    rank = F.row_number().over(W.partitionBy("nr", "nth").orderBy(F.col("score").desc(), "found"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _percent(score: Column, percent: int, rounded) -> Column:
    """score * percent / 100, rounded, without a product that leaves 64 bits."""
    rest = F.pmod(score, F.lit(100))
    return F.call_function("div", score - rest, F.lit(100)) * percent + rounded(rest * percent / 100)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every row that ``is_anchor``
    picks and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score."""
    v = F.col("vector")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                          F.transform(F.col(embedding), lambda x: x.cast("double") * scale).alias("vector"),
                          F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    fit = ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & (F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x) < 2.0 ** 61)
    rows = stored(rows.where("id is not null and label is not null and vector is not null").where(fit)
                  .select("id", "label", F.transform("vector", lambda x: F.floor(x).cast("int")).alias("parts"), "is_anchor")
                  .distinct(), "mined-rows")
    anchors = stored(rows.where("is_anchor").drop("is_anchor").withColumn("nr", F.monotonically_increasing_id()), "anchors")
    rows = rows.drop("is_anchor")

    n, size = rows.count(), anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("parts")).alias("dim")).first()
    chunks = max(1, -(-size["n"] * 4 * max(size["dim"] or 1, 1) // CHUNK_BYTES))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = max(1, min(-(-tasks // chunks), n * size["n"] // chunks // CELL_PAIRS))

    def bounds(columns: list[Column]) -> Column:
        return F.array(*[c.cast("long") for c in columns])

    open_low, open_high = F.lit(LOWEST), F.lit(-(LOWEST + 1))
    first = anchors.withColumn("low", bounds([open_low])).withColumn("high", bounds([open_high]))
    own = stored(_best(first, rows, True, positives, chunks, shares)
                 .select("nr", F.col("rank").alias("nth"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # a question for each positive; where an anchor has fewer, the others have bounds that nothing meets
    at = own.groupBy("nr").agg(F.map_from_entries(F.collect_list(F.struct("nth", "positive_score"))).alias("at"))
    scores = [F.col("at")[F.lit(j)] for j in range(1, positives + 1)]
    second = anchors.join(at, "nr").withColumns({
        "low": bounds([F.coalesce(_percent(s, low, F.ceil), open_high) for s in scores]),
        "high": bounds([F.coalesce(_percent(s, high, F.floor), open_low) for s in scores])}).drop("at")
    others = _best(second, rows, False, negatives, chunks, shares)
    return (others.join(own, ["nr", "nth"]).join(anchors.select("nr", F.col("id").alias("anchor_id")), "nr")
            .select("anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
