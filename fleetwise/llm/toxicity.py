"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word's vector is the mean of the vectors of its character n-grams (hashed
into ``BUCKETS`` rows) and of the word itself; a text's vector is the mean
over its words; a linear softmax over two classes reads it.  Embeddings and
softmax are trained jointly in numpy (Adam on the cross entropy), so a
misspelling never seen in training still gets the vectors of the n-grams it
shares with seen words.

Training reads at most ``TRAIN_DOCS`` labelled documents per class (whole
texts), chosen by the hash of their id; that bound keeps the training set in
one task.  Scoring covers every document: the logit of a mean is the mean of
the words' logits, so each different word is looked up once per task.

Defined cases: a null or empty text, or one without words, has the score of
the bias alone; labels that are null take no part; without any label, or with
one class only, every score is 0, or 1 if that class is toxic;
repeated documents are scored alike; an empty table gives no row.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.llm.common import stored
from fleetwise.llm.subwords import BagScorer, Numbered, gram_rows, words

BITS, DIM = 17, 8
BUCKETS = 1 << BITS
GRAMS = (3, 4, 5)
TRAIN_DOCS = 4000
STEPS, BATCH, RATE = 400, 128, 0.1


class Model:
    """Rows of the embedding table times the softmax weights (class 1 against
    0): the softmax reads a mean, so it can be taken row by row.  And a bias."""

    def __init__(self, rows: np.ndarray, bias: float):
        self.rows, self.bias = rows.astype(np.float64), float(bias)
        self.bag = BagScorer(self.rows[:, None], GRAMS, BITS)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z = self.bag(texts)[0][:, 0] + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(texts: list[str | None], toxic: list[int], seed: int = 1, steps: int = STEPS) -> Model:
    """Joint training of embeddings and softmax."""
    y_all = np.asarray(toxic, np.float64)
    if len(y_all) == 0 or y_all.min() == y_all.max():
        return Model(np.zeros(BUCKETS), 40.0 if len(y_all) and y_all[0] else -40.0)
    rng = np.random.default_rng(seed)
    number = Numbered()
    docs = []
    for t in texts:
        bag = Counter(words(t))
        docs.append((np.fromiter(map(number.__getitem__, bag), np.int64, len(bag)),
                     np.fromiter(bag.values(), np.float64, len(bag)) / max(1, bag.total())))
    gram, word_of = gram_rows(number.new, GRAMS, BITS)
    order = np.argsort(word_of, kind="stable")
    gram, size = gram[order].astype(np.int32), np.bincount(word_of, minlength=len(number))
    begin = np.cumsum(size) - size
    table = rng.standard_normal((BUCKETS, DIM)) * 0.1
    weight, bias = rng.standard_normal(DIM) * 0.5, 0.0
    moments = [(np.zeros_like(table), np.zeros(1)), (np.zeros(DIM), np.zeros(1)), (np.zeros(1), np.zeros(1))]

    def adam(which: int, g: np.ndarray, rate: float) -> np.ndarray:
        m, v = moments[which]
        m += 0.1 * (g - m)
        v += 0.01 * ((g * g).mean() - v)
        return rate * m / (np.sqrt(v) + 1e-12)

    # the rarer class weighs more, half way to an even balance
    weigh = np.where(y_all > 0, (0.5 / y_all.mean()) ** 0.5, (0.5 / (1 - y_all.mean())) ** 0.5)
    done, epochs = 0, -(-steps * BATCH // len(docs))
    for _ in range(epochs):
        shuffled = rng.permutation(len(docs))
        for s in range(0, len(shuffled), BATCH):
            some = shuffled[s:s + BATCH]
            rate = RATE * max(0.02, 1 - done / steps)
            done += 1
            at = np.concatenate([docs[i][0] for i in some])
            if not len(at):
                continue
            share = np.concatenate([docs[i][1] for i in some])
            row = np.repeat(np.arange(len(some)), [len(docs[i][0]) for i in some])
            # the n-grams of every word of the batch; all sums below are over them, with the words' weights
            n = size[at]
            ends = np.cumsum(n)
            g_row = gram[np.repeat(begin[at] - ends + n, n) + np.arange(ends[-1])]
            g_share, g_doc = np.repeat(share / n, n), np.repeat(row, n)
            z = np.bincount(g_doc, (table @ weight)[g_row] * g_share, len(some)) + bias
            loss = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y_all[some]) * weigh[some] / len(some)
            per_row = np.bincount(g_row, g_share * loss[g_doc], BUCKETS)
            d_table, d_weight = per_row[:, None] * weight, table.T @ per_row
            table -= adam(0, d_table, rate)
            weight -= adam(1, d_weight, rate)
            bias -= adam(2, np.array([loss.sum()]), rate)[0]
    return Model(table @ weight, bias)


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, steps: int | None = None) -> Model:
    """Train on the texts of ``docs`` (doc_id, text) whose ids ``labels``
    (doc_id, toxic) has, at most ``train_docs`` of either class.

    The chosen ids are at most 2 * ``train_docs`` rows, which bounds both the
    broadcast of the join and the one task that trains."""
    steps = steps or STEPS
    known = (labels.where("toxic is not null and doc_id is not null")
             .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic")))
    chosen = None
    for toxic in (0, 1):
        some = known.where(F.col("_toxic") == toxic).orderBy(F.xxhash64("_id"), "_id").limit(train_docs)
        chosen = some if chosen is None else chosen.union(some)
    texts = docs.select(docs["doc_id"].cast("long").alias("_id"), docs["text"].alias("_text"))
    rows = texts.join(F.broadcast(stored(chosen, "toxic-sample")), "_id").select("_id", "_toxic", "_text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        if got:
            all_rows = pd.concat(got).fillna({"_text": ""}).sort_values(["_id", "_text"]).drop_duplicates("_id")
            model = train(all_rows["_text"].tolist(), all_rows["_toxic"].tolist(), steps=steps)
        else:
            model = train([], [])
        yield pd.DataFrame({"model": [pickle.dumps((model.rows, model.bias))]})

    trained = rows.repartition(1).mapInPandas(run, "model binary").collect()
    if not trained:  # nothing to learn from: the optimizer leaves the task out
        return train([], [])
    return Model(*pickle.loads(bytes(trained[0]["model"])))


def score_column(model: Model):
    """A function text column -> score column (0 to 1)."""
    rows, bias = model.rows, model.bias

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(rows, bias)
        for batch in texts:
            some = batch.tolist()
            yield pd.Series(np.concatenate([own.scores(some[i:i + 512]) for i in range(0, len(some), 512)])
                            if some else np.zeros(0))
    return score


def score(docs: DataFrame, model: Model, to: str = "score") -> DataFrame:
    """``docs`` with a column ``to``."""
    return docs.withColumn(to, score_column(model)(docs["text"]))
