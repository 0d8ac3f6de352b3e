import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwise.llm import lexical_search as L

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOW = str.maketrans(LETTERS, LETTERS.lower())


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def plain(docs, items, k):
    """Every document against every item."""
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in set(items):
        scores = []
        for i, b in bags:
            m = 100 - 25 + (25 * len(b) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b.count(t)) // (1000 * b.count(t) + 12 * m))
                    for t in terms(text) if t in b)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


EDGE_DOCS = [(None, "w1 w2 w3"), (None, "w1 w2 w3"), (7, "w1 w2 w3"), (7, "W1,w2;w3"), (900, None), (901, ""), (902, ".,-"), (903, "w1 " * 5000), (904, "É é"),
             (905, "\xa0w1\x85"), (906, "w1\tW2\x0cw3")]
EDGE_ITEMS = [(1, None), (2, ""), (3, "w1 w1 w1 w2"), (3, "w1 w1 w1 w2"), (3, "w5"), (None, "w7 w8 w9"), (4, "unseen"), (5, "É é W2"), (6, "w3 " * 300)]


@pytest.mark.parametrize("block,leaf,item_bytes", [(8192, 16, 4 << 20), (40, 2, 4 << 20), (40, 2, 400)])
def test_against_definition(spark, monkeypatch, block, leaf, item_bytes):
    for name, value in (("BLOCK", block), ("LEAF", leaf), ("ITEM_BYTES", item_bytes), ("FIRST", 4), ("ENCODE_BYTES", 500)):
        monkeypatch.setattr(L, name, value)
    rnd = random.Random(block + item_bytes)
    word = lambda: f"w{int(rnd.expovariate(0.08))}"
    docs = [(i, " ".join(word() for _ in range(rnd.randrange(1, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[5][1]) for i in range(150)]  # a group of copies
    items = [(10 + i, " ".join(word() for _ in range(rnd.randrange(1, 30)))) for i in range(30)] + [(99, docs[5][1])]
    docs, items = docs + EDGE_DOCS, items + EDGE_ITEMS
    rnd.shuffle(docs)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumn("item_id", F.lit(1)).withColumn("score", F.lit(2))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("nr", F.lit(1)).withColumn("doc_id", F.lit(2))
    got = L.search(d, i, k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items, 7)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a"), (2, None)], "item_id long, text string")
    assert L.search(d.limit(0), i).count() == 0 and L.search(d, i.limit(0)).count() == 0
    assert L.search(d.where("doc_id = 2"), i).count() == 0
    assert [tuple(r)[:3] for r in L.search(d, i).collect()] == [(1, 1, 1)]


def test_node_maxima_bound_and_prune():
    """Every node's maxima bound the scores below, and far fewer pairs are scored than there are."""
    rng = np.random.default_rng(2)
    n, n_terms = 2000, 300
    rows, values = [], []
    for d in range(n):
        topic = rng.integers(0, 20)
        t = np.unique(np.where(rng.random(30) < 0.8, topic * 15 + rng.integers(0, 15, 30), rng.integers(0, n_terms, 30)))
        rows.append(t)
        values.append(rng.integers(1, 1000, len(t)))
    level = L.Level(np.append(0, np.cumsum([len(r) for r in rows])), np.concatenate(rows), np.concatenate(values))
    tree = L.Tree(level, n_terms, L.LEAF)
    dense = rng.integers(0, 50, n_terms)
    below = tree.levels[0].products(np.arange(n), dense)
    for depth in range(1, tree.top + 1):
        count = len(tree.levels[depth].ptr) - 1
        bound = tree.levels[depth].products(np.arange(count), dense)
        child = np.repeat(np.arange(count), np.diff(tree.cuts[depth]))
        assert len(child) == len(below) and (below <= bound[child]).all()
        below = bound
    assert sorted(tree.order) == list(range(n))
    weights = [(rows[i], rng.integers(1, 30, len(rows[i]))) for i in range(0, 200, 5)]
    items = L.Tree(L.Level(np.append(0, np.cumsum([len(t) for t, _ in weights])), np.concatenate([t for t, _ in weights]),
                           np.concatenate([w for _, w in weights])), n_terms, leaf=4)
    search = L.Search(items, n_terms, 5, np.zeros(40, np.int64))
    search.block(np.arange(n), np.zeros(n, bool), level)
    assert search.pairs < 0.5 * 40 * n
    for place, item in enumerate(items.order):
        w = np.zeros(n_terms, np.int64)
        w[weights[item][0]] = weights[item][1]
        scores = level.products(np.arange(n), w)
        best = np.lexsort((np.arange(n), -scores))[:5]
        assert (search.found[place] == best).all() and (search.score[place] == scores[best]).all()
