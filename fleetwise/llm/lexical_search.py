"""Ranked lexical search by a dual tree.

Scores are whole numbers: a document's score for an item sums, over the item's
terms with repeats, a term weight times a saturating share of the term's
occurrences (``gain``).  All gains and weights are at least 0, so a vector of
coordinate maxima bounds all the vectors below it.

* The documents become sparse vectors over the items' terms; counts of the
  corpus (documents, terms, documents of each term) come from all of them.
* Every task builds, block by block, a hierarchy over its documents: random
  projections split a block in halves down to leaves of ``LEAF`` documents, and
  each node holds the greatest gain of every term below it.  The items have
  such a hierarchy too, with the greatest weights.
* Both are descended together.  The product of an item node's and a document
  node's maxima bounds the score of every pair below; where it is less than
  the weakest k-th best score of the node's items, the whole batch of pairs is
  left out.  At a single item and leaf, documents are scored exactly, leaves of
  high bounds first.  The bounds carry a margin above float64's rounding and
  equal scores are never pruned, so the answer is exact.
* The k-th best scores start at those of a 64th of the documents (searched
  first, chosen by hash), a valid lower bound, and only rise.

A task returns at most k documents an item; a window over the item joins them.
Tasks hold one block of documents at a time.  Items are the stated side: they
are searched in chunks of about ``ITEM_BYTES`` of text (dealt by hash), one
pass over the documents each, so what a task receives is bounded however many
items there are.

Defined cases: a null text, or one without terms, is no document and, as an
item, has no answer; items repeated as a whole are answered once, different
items under one id each for itself (ranks are per item row); repeated document
rows are documents of their own; a null doc_id sorts behind all others on equal
scores; documents without a common term score 0 and are never returned; empty
tables give no row; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwise.llm.common import stored

ITEM_BYTES = 4 << 20
BLOCK = 8192  # documents in one hierarchy
LEAF = 16
ENCODE_BYTES = 1 << 22
FIRST = 64  # one document in so many is searched first
MARGIN = 1 + 1e-9

#: A-Z to lower case; digits, a-z and the bytes of signs beyond ASCII stay; all else separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gain(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 25 + (25 * length * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


# ---------------------------------------------------------------- documents as vectors


def _encode(vocabulary: dict[bytes, int]):
    size = max(len(vocabulary), 1)

    def vectors(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        length = np.zeros(len(texts), np.int64)
        keys = []
        for i, text in enumerate(texts):
            terms = terms_of(text)
            length[i] = len(terms)
            at = np.fromiter(map(vocabulary.get, terms, repeat(-1)), np.int64, len(terms))
            keys.append(at[at >= 0] + i * size)
        key, tf = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
        ends = np.searchsorted(key, np.arange(len(texts) + 1) * size).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (key % size, tf)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(length), *lists], ["doc_id", "length", "terms", "tf"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                texts.append(text.as_py() or b"")
                held += len(texts[-1])
                if held >= ENCODE_BYTES:
                    yield vectors(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield vectors(ids, texts)
    return run


# ---------------------------------------------------------------- hierarchies


def _ranges(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of ``rows`` in a table of ragged rows, and where each row begins among them."""
    size = ptr[rows + 1] - ptr[rows]
    begin = np.cumsum(size) - size
    return np.repeat(ptr[rows] - begin, size) + np.arange(size.sum()), begin


class Level:
    """Ragged rows of (term, value); every row has an entry."""

    def __init__(self, ptr: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.ptr, self.terms, self.values = ptr, terms, values

    def maxima(self, parent: np.ndarray, n_terms: int) -> Level:
        """The greatest value of every term over the rows of each parent (numbered from 0, ascending)."""
        key = np.repeat(parent, np.diff(self.ptr)) * n_terms + self.terms
        order = np.argsort(key, kind="stable")
        key, values = key[order], self.values[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key = key[first]
        ptr = np.searchsorted(key, np.arange(int(parent[-1]) + 2) * n_terms)
        return Level(ptr, key % n_terms, np.maximum.reduceat(values, first))

    def products(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Inner product of each of ``rows`` with a vector over all terms."""
        places, begin = _ranges(self.ptr, rows)
        return np.add.reduceat(dense[self.terms[places]] * self.values[places], begin)


class Tree:
    """A hierarchy over ragged rows: ``levels[0]`` has the rows themselves in
    the order of the leaves, ``levels[1]`` the leaves, and each further level
    nodes of four below; ``cuts[l]`` says where a node's children begin."""

    def __init__(self, rows: Level, n_terms: int, leaf: int, fan: int = 4, seed: int = 5):
        n = len(rows.ptr) - 1
        halvings = max(0, int(math.log2(max(n, 1) / leaf)))
        node = np.zeros(n, np.int64)
        rng = np.random.default_rng(seed)
        norm = np.sqrt(np.add.reduceat(rows.values.astype(np.float64) ** 2, rows.ptr[:-1])) + 1e-300
        for _ in range(halvings):
            direction = rng.standard_normal(n_terms)
            along = rows.products(np.arange(n), direction) / norm
            order = np.lexsort((along, node))
            size = np.bincount(node)
            nth = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
            node[order] = 2 * node[order] + (nth >= np.repeat((size + 1) // 2, size))
        self.order = np.argsort(node, kind="stable")
        places, begin = _ranges(rows.ptr, self.order)
        level = Level(np.append(begin, len(places)), rows.terms[places], rows.values[places])
        self.levels, self.cuts = [level], [None]
        parent = node[self.order]
        while True:
            count = int(parent[-1]) + 1
            self.cuts.append(np.searchsorted(parent, np.arange(count + 1)))
            level = level.maxima(parent, n_terms)
            self.levels.append(level)
            if count == 1:
                break
            parent = np.arange(count) // fan
        self.top = len(self.levels) - 1

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        cuts = self.cuts[level]
        size = cuts[nodes + 1] - cuts[nodes]
        return np.repeat(cuts[nodes] - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Search:
    """The k best documents of every item, over any number of blocks."""

    def __init__(self, items: Tree, n_terms: int, k: int, floor: np.ndarray):
        self.items, self.n_terms, self.k = items, n_terms, k
        n = len(items.order)
        self.floor = floor[items.order]  # no document with a lesser score is an answer
        self.score = np.zeros((n, k), np.int64)
        self.found = np.zeros((n, k), np.int64)
        self.none = np.ones((n, k), bool)
        self.pairs = 0  # scored exactly
        # rows of items below each node
        self.spans = [(np.arange(n), np.arange(1, n + 1))]
        for cuts in items.cuts[1:]:
            low, high = self.spans[-1]
            self.spans.append((low[cuts[:-1]], high[cuts[1:] - 1]))

    def block(self, ids: np.ndarray, none: np.ndarray, rows: Level) -> None:
        docs = Tree(rows, self.n_terms, LEAF)
        self.docs, self.ids, self.none_id = docs, ids[docs.order], none[docs.order]
        self._descend(self.items.top, 0, docs.top, np.zeros(1, np.int64))

    def _weakest(self, level: int, node: int) -> int:
        low, high = (x[node] for x in self.spans[level])
        return max(int(np.maximum(self.score[low:high, -1], self.floor[low:high]).min()), 1)

    def _descend(self, level: int, node: int, doc_level: int, doc_nodes: np.ndarray) -> None:
        items = self.items.levels[level]
        part = slice(items.ptr[node], items.ptr[node + 1])
        dense = np.zeros(self.n_terms, np.float64 if doc_level else np.int64)
        dense[items.terms[part]] = items.values[part]
        while True:
            bound = self.docs.levels[doc_level].products(doc_nodes, dense)
            keep = bound * MARGIN >= self._weakest(level, node)
            doc_nodes, bound = doc_nodes[keep], bound[keep]
            if not len(doc_nodes):
                return
            if level:  # both sides go one level down, the documents to their leaves at most
                if doc_level > 1:
                    doc_nodes, doc_level = self.docs.children(doc_level, doc_nodes), doc_level - 1
                for child in range(self.items.cuts[level][node], self.items.cuts[level][node + 1]):
                    self._descend(level - 1, child, doc_level, doc_nodes)
                return
            if doc_level == 1:
                break
            doc_nodes, doc_level = self.docs.children(doc_level, doc_nodes), doc_level - 1
        # one item and its leaves, best bounds first: a few, then four times as many, as the k-th score rises
        order = np.argsort(-bound, kind="stable")
        doc_nodes, bound, step = doc_nodes[order], bound[order], 4
        dense = dense.astype(np.int64)
        while len(doc_nodes):
            self._score(node, self.docs.children(1, doc_nodes[:step]), dense)
            doc_nodes, bound, step = doc_nodes[step:], bound[step:], 4 * step
            keep = bound * MARGIN >= self._weakest(0, node)
            doc_nodes, bound = doc_nodes[keep], bound[keep]

    def _score(self, item: int, docs: np.ndarray, dense: np.ndarray) -> None:
        self.pairs += len(docs)
        score = self.docs.levels[0].products(docs, dense)
        good = np.flatnonzero(score >= self._weakest(0, item))
        if not len(good):
            return
        docs = docs[good]
        score = np.concatenate([self.score[item], score[good]])
        found = np.concatenate([self.found[item], self.ids[docs]])
        none = np.concatenate([self.none[item], self.none_id[docs]])
        best = np.lexsort((found, none, -score))[:self.k]
        self.score[item], self.found[item], self.none[item] = score[best], found[best], none[best]

    def answers(self, names: np.ndarray) -> pa.RecordBatch:
        item, nth = np.nonzero(self.score > 0)
        return pa.RecordBatch.from_pydict({
            "nr": pa.array(names[self.items.order[item]], pa.int64()),
            "doc_id": pa.array(self.found[item, nth], pa.int64(), mask=self.none[item, nth]),
            "score": pa.array(self.score[item, nth], pa.int64())})


class Items:
    """One chunk of items: their names, terms and repeats."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        self.names, self.bags = [], []
        for nr, text in rows:
            bag = np.array([number(t, len(self.vocabulary)) for t in terms_of(text)], np.int64)
            if len(bag):
                self.names.append(nr)
                self.bags.append(np.unique(bag, return_counts=True))

    def tree(self, weights: np.ndarray) -> Tree | None:
        """The hierarchy over the items whose terms have a weight; ``kept`` says which they are."""
        parts = [(t[weights[t] > 0], (n * weights[t])[weights[t] > 0]) for t, n in self.bags]
        self.kept = [i for i, (t, _) in enumerate(parts) if len(t)]
        if not self.kept:
            return None
        terms, values = (np.concatenate([parts[i][j] for i in self.kept]) for j in (0, 1))
        ptr = np.cumsum([0] + [len(parts[i][0]) for i in self.kept])
        return Tree(Level(ptr, terms, values), len(weights), leaf=4)


def _search(tree: Tree, names: np.ndarray, n_terms: int, n_docs: int, total: int, k: int, floor: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(tree, n_terms, k, floor)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                terms, tf = (some.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "tf"))
                size = np.diff(some.column("terms").offsets.to_numpy())
                length = np.repeat(some.column("length").to_numpy(), size)
                ids = some.column("doc_id")
                search.block(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                             Level(np.append(0, np.cumsum(size)), terms, gain(tf, length, n_docs, total)))
        yield search.answers(names)
    return run


_VECTORS = "doc_id long, length long, terms array<int>, tf array<int>"
_FOUND = "nr long, doc_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("nr").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _chunk(docs: DataFrame, rows: list[tuple[int, bytes]], k: int) -> DataFrame | None:
    """nr, doc_id, score, rank for one chunk of items."""
    items = Items(rows)
    n_terms = len(items.vocabulary)
    vectors = stored(docs.mapInArrow(_encode(items.vocabulary), _VECTORS), "term-vectors")
    n_docs, total = vectors.where("length > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    weights = np.zeros(n_terms, np.int64)
    # at most one row for every term of the chunk's items
    for term, df in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        weights[term] = weight(n_docs, df)
    tree = items.tree(weights)
    if tree is None:
        return None
    names = np.array([items.names[i] for i in items.kept], np.int64)
    vectors = vectors.where(F.size("terms") > 0)

    def best(part: DataFrame, floor: np.ndarray) -> DataFrame:
        return _ranked(part.mapInArrow(_search(tree, names, n_terms, n_docs, total, k, floor), _FOUND), k)

    floor = np.zeros(len(names), np.int64)
    place = {nr: i for i, nr in enumerate(names.tolist())}
    first = vectors.where(F.pmod(F.xxhash64("doc_id", "length"), F.lit(FIRST)) == 0)
    for nr, score in best(first, floor).where(F.col("rank") == k).select("nr", "score").collect():  # one row an item of the chunk
        floor[place[nr]] = score
    return best(vectors, floor)


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("binary").alias("text"))
    asked = stored(items.select(items[item_id].alias("item_id"), items[item_text].cast("binary").alias("text"))
                   .where("text is not null").distinct(), "items")
    asked = stored(asked.withColumn("nr", F.monotonically_increasing_id()), "items")
    chunks = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BYTES))
    found = []
    for c in range(chunks):
        some = asked.where(F.pmod(F.xxhash64("nr"), F.lit(chunks)) == c).select("nr", "text")
        part = _chunk(rows, [(nr, bytes(t)) for nr, t in some.collect()], k)
        if part is not None:
            found.append(part)
    every = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _FOUND + ", rank int")
    return every.join(asked.select("nr", "item_id"), "nr").select("item_id", "rank", "doc_id", "score")
