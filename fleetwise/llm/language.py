"""Language identification in two steps: family, then language within it.

Features are hashed character n-grams (1 to 4) of the words, averaged per
word and per text.  A first set of linear support vector machines picks the
language family; within it, one machine for each pair of its languages votes
(one versus one), so closely related languages are told apart by a machine
that has seen nothing else.  All machines are trained in numpy on at most
``TRAIN_DOCS`` labelled documents (whole texts, evenly over the languages,
chosen by the hash of their id); scoring covers every document, and a word's
linear scores are worked out once per task.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
null languages teach nothing; without any language to learn, every text is
``und``; with one, that one; a language outside ``FAMILIES`` forms a family of
its own; ties go to the larger sum of margins, then to the smaller name;
repeated documents get the same answer; an empty table gives no row.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetwise.llm.common import stored
from fleetwise.llm.subwords import BagScorer, gram_rows, words

BITS = 13
GRAMS = (1, 2, 3, 4)
TRAIN_DOCS = 6000
ROUNDS, MARGIN_LOSS = 200, 1e-4
UNKNOWN = "und"

#: Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fy is lb nl nb nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "turkic": "az kk ky tr uz",
    "semitic": "am ar he mt",
    "austronesian": "id jv ms tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], f"({lang})")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(texts: list[str]) -> np.ndarray:
    """Mean n-gram shares of each text's words (texts x 2 ** BITS)."""
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    for i, t in enumerate(texts):
        bag = Counter(words(t))
        if bag:
            row, at = gram_rows(list(bag), GRAMS, BITS)
            share = np.array(list(bag.values())) / bag.total() / np.bincount(at, minlength=len(bag))
            out[i] = np.bincount(row, share[at], 1 << BITS)
    return out


def svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (y is 1 or -1),
    by averaged subgradient steps on the balanced, squared hinge loss."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    total, total_b = np.zeros_like(w), 0.0
    for step in range(1, ROUNDS + 1):
        short = np.maximum(0, 1 - y * (x @ w + b)) * y * weight
        g, gb = MARGIN_LOSS * w / len(w) - x.T @ short, -short.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w = w - 0.3 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        b -= 0.1 * (mb / (1 - 0.9 ** step)) / (np.sqrt(vb / (1 - 0.99 ** step)) + 1e-8)
        if step > ROUNDS // 2:
            total, total_b = total + w, total_b + b
    n = ROUNDS - ROUNDS // 2
    return total / n, float(total_b / n)


class Model:
    """One machine for each pair of families and each pair within a family."""

    def __init__(self, families: dict[str, list[str]], pairs: list[tuple[str, str, str]], table: np.ndarray, bias: np.ndarray):
        self.families, self.pairs, self.table, self.bias = families, pairs, table, bias
        self.bag = BagScorer(table, GRAMS, BITS)

    def _vote(self, level: str, names: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(winner's number, its share 0 to 1) over the pairs of ``level``."""
        votes, sums = np.zeros((len(margins), len(names))), np.zeros((len(margins), len(names)))
        chance = np.ones((len(margins), len(names)))
        for k, (of, a, b) in enumerate(self.pairs):
            if of == level:
                i, j = names.index(a), names.index(b)
                z = margins[:, k]
                votes[:, i] += z >= 0
                votes[:, j] += z < 0
                sums[:, i] += z
                sums[:, j] -= z
                p = 1 / (1 + np.exp(-np.clip(2 * z, -50, 50)))
                chance[:, i] = np.minimum(chance[:, i], p)
                chance[:, j] = np.minimum(chance[:, j], 1 - p)
        best = np.lexsort((np.broadcast_to(-np.arange(len(names)), votes.shape), sums, votes), axis=1)[:, -1]
        return best, chance[np.arange(len(best)), best]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = np.array([has_letter(t) for t in texts], bool)
        out, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if not self.families or not known.any():
            return out.tolist(), score
        margins = self.bag([t if k else None for t, k in zip(texts, known)])[0] + self.bias
        names = sorted(self.families)
        family, share = self._vote("", names, margins)
        for i, name in enumerate(names):
            at = np.flatnonzero(known & (family == i))
            langs = self.families[name]
            lang, within = self._vote(name, langs, margins[at])
            out[at] = [langs[k] for k in lang]
            score[at] = share[at] * within
        return out.tolist(), score


def train(texts: list[str], langs: list[str]) -> Model:
    families: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        families.setdefault(family_of(lang), []).append(lang)
    lang, x = np.array(langs, object), features(texts)
    scale = (float(np.sqrt((x ** 2).sum(axis=1).mean())) if len(x) else 0.0) or 1.0
    x /= scale
    kin = np.array([family_of(v) for v in langs], object)
    pairs, w, bias = [], [], []
    for level, of, names in [("", kin, sorted(families)), *((f, lang, v) for f, v in families.items())]:
        for a, b in combinations(names, 2):
            rows = np.flatnonzero((of == a) | (of == b))
            weights, b0 = svm(x[rows], np.where(of[rows] == a, 1.0, -1.0).astype(np.float32))
            pairs.append((level, a, b))
            w.append(weights / scale)
            bias.append(b0)
    table = np.stack(w, axis=1) if w else np.zeros((1 << BITS, 1))
    return Model(families, pairs, table, np.array(bias or [0.0]))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Train on ``docs`` (doc_id, text, lang), at most ``train_docs`` of them."""
    texts = docs.select(docs["doc_id"].cast("long").alias("_id"), docs["text"].alias("_text"), docs["lang"].alias("_lang")).where(
        "_id is not null and _lang is not null")
    known = texts.select("_id", "_lang")
    n = known.agg(F.countDistinct("_lang")).first()[0]
    first = F.row_number().over(W.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id"))
    chosen = known.withColumn("_nth", first).where(F.col("_nth") <= max(1, train_docs // max(1, n))).select("_id").distinct()
    # at most train_docs ids: small enough to broadcast, and their texts for one task
    rows = texts.join(F.broadcast(stored(chosen, "language-sample")), "_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b for b in batches if len(b)]
        rows = pd.concat(got) if got else pd.DataFrame({"_id": [], "_text": [], "_lang": []})
        rows = rows[[has_letter(t) for t in rows["_text"]]] if len(rows) else rows
        rows = rows.sort_values(["_id", "_lang", "_text"]).drop_duplicates("_id")
        model = train(rows["_text"].tolist(), rows["_lang"].tolist())
        yield pd.DataFrame({"model": [pickle.dumps((model.families, model.pairs, model.table, model.bias))]})

    trained = rows.repartition(1).mapInPandas(run, "model binary").collect()
    if not trained:  # nothing to learn from: the optimizer leaves the task out
        return train([], [])
    return Model(*pickle.loads(bytes(trained[0]["model"])))


def predict_column(model: Model):
    """A function text column -> struct(lang_pred, score)."""
    parts = model.families, model.pairs, model.table, model.bias

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(*parts)
        for batch in texts:
            some = batch.tolist()
            got = [own.predict(some[i:i + 512]) for i in range(0, len(some), 512)]
            yield pd.DataFrame({"lang_pred": [x for g in got for x in g[0]], "score": [float(x) for g in got for x in g[1]]},
                               columns=["lang_pred", "score"])
    return predict


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the columns lang_pred and score."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    found = predict_column(model)(docs["text"]).alias("_found")
    return docs.select(*kept, found).select(*kept, "_found.lang_pred", "_found.score")
