"""Learned operators: held-out accuracy, brute force, defined cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF_DIR
from fleetwise.llm import language, lm_scoring, toxicity
from fleetwise.llm import queries as Q


def test_toxicity_learns_and_shares_subwords():
    rng = np.random.default_rng(1)
    plain = [f"{a}{b}" for a in ("lo", "mi", "ra", "tu", "ne") for b in ("ban", "ster", "wick", "dal", "fu")]
    bad = ["grumblok", "snarvex", "vilething"]
    texts, toxic = [], []
    for i in range(600):
        words = rng.choice(plain, 40).tolist()
        if i % 4 == 0:
            words[5] = words[17] = str(rng.choice(bad))
        texts.append(" ".join(words))
        toxic.append(int(i % 4 == 0))
    model = toxicity.train(texts[:400], toxic[:400], steps=300)
    scores = model.scores(texts[400:])
    assert (np.round(scores) == toxic[400:]).mean() > 0.97
    spelt = " ".join(rng.choice(plain, 20).tolist())
    assert model.scores([spelt + " grumblock snarvexx"])[0] > model.scores([spelt + " loban miban"])[0] + 0.2
    assert (model.scores(["", None, "!!!"]) == model.scores([""])[0]).all()
    assert toxicity.train(["a"], [0]).scores(["a"])[0] < 1e-6 and toxicity.train([], []).scores(["a"])[0] < 1e-6


def test_toxicity_query(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 20)
    docs = spark.createDataFrame([(1, "a fine text", 1.0), (None, None, 1.0), (2, "", 1.0), (2, "", 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 0), (1, None), (2, 1), (9, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model, "toxicity").collect()
    assert len(got) == 4 and all(0 <= r.toxicity <= 1 for r in got)
    assert toxicity.fit(docs.limit(0), labels.limit(0)).scores(["x"])[0] < 1e-6
    rows = Q.QUERIES["op3_toxicity"](spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in rows)
    assert len(rows) == 200


def test_language_query(spark):
    rows = Q.QUERIES["op9_language_id"](spark, SF_DIR).collect()
    lang = {r.doc_id: r.lang for r in Q.table(spark, SF_DIR, "documents").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and len(rows) == 200
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.85


def test_language_cases(spark):
    texts = {"en": "the and of that this with was", "de": "der die das und nicht ist ein", "fr": "le la les des est une dans",
             "es": "el los las que una por con", "xx": "qoq zuz quq zoz quoz zuq qoz"}
    rows = [(i * 10 + j, " ".join(np.roll(t.split(), j)), k) for i, (k, t) in enumerate(texts.items()) for j in range(6)]
    docs = spark.createDataFrame([*rows, (None, "the", "en"), (999, "the", None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"], "(xx)": ["xx"]}
    assert model.predict([t for t in texts.values()])[0] == list(texts)
    lang, score = model.predict([None, "", "12 !?", "the and"])
    assert lang == ["und", "und", "und", "en"] and score[:3].tolist() == [0, 0, 0]
    asked = spark.createDataFrame([(1, None, 2), (2, "the and of", 3)], "doc_id long, text string, lang_pred int")
    assert [(r.doc_id, r.lang_pred) for r in language.predict(asked, model).orderBy("doc_id").collect()] == [(1, "und"), (2, "en")]
    none = language.fit(docs.limit(0))
    assert none.predict(["the"])[0] == ["und"]
    assert language.train(["the"], ["en"]).predict(["le"])[0] == ["en"]


def test_rare_words_fall_into_classes():
    known = lm_scoring.Symbols({b"a": 1})([None, "a b A", "b"])
    assert known[0].tolist() == [0, 0]
    rare = 1 + lm_scoring.WORDS + zlib.crc32(b"b") % lm_scoring.CLASSES
    assert known[1].tolist() == [0, 1, rare, 1, 0] and known[2].tolist() == [0, rare, 0]


def test_lm_scores_against_brute_force(spark):
    rows = [(1, "a b a c d"), (2, "A b  b\n"), (3, None), (4, ""), (5, "e f g h a"), (None, "a b"), (2, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    target = spark.createDataFrame([(2,), (2,), (5,), (77,), (None,)], "doc_id long")
    words, t_loss, b_loss = lm_scoring.models(docs, target)
    counts = Counter(w for _, t in rows for w in (t or "").lower().split())
    top = sorted(counts, key=lambda w: (-counts[w], w))
    symbol = lambda w: top.index(w) + 1
    size = lm_scoring.SYMBOLS
    seq = lambda t: [0, *map(symbol, (t or "").lower().split()), 0]

    def loss(texts):
        pairs = Counter(p for t in texts for p in zip(seq(t), seq(t)[1:]))
        n = sum(pairs.values())
        uni = [(sum(c for (_, w), c in pairs.items() if w == s) + 1) / (n + size) for s in range(len(top) + 1)]
        from_ = Counter()
        for (v, _), c in pairs.items():
            from_[v] += c
        return lambda t: np.mean([-math.log((pairs[p] + 50 * uni[p[1]]) / (from_[p[0]] + 50)) for p in zip(seq(t), seq(t)[1:])])

    of_target, of_all = loss([t for d, t in rows if d in (2, 5)]), loss([t for _, t in rows])
    got = lm_scoring.score(docs, words, t_loss, b_loss).collect()
    want = sorted(((d, len(seq(t)) - 1, of_target(t), of_all(t)) for d, t in rows), key=lambda r: (str(r[0]), r[1]))
    for r, w in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens)), want, strict=True):
        assert (r.doc_id, r.n_tokens) == w[:2]
        assert r.target_loss == pytest.approx(w[2], abs=1e-5) and r.background_loss == pytest.approx(w[3], abs=1e-5)
        assert r.score == pytest.approx(w[2] - w[3], abs=1e-5)
    assert lm_scoring.score(docs.limit(0), words, t_loss, b_loss).count() == 0
    assert np.allclose(lm_scoring.models(docs, target.limit(0))[1], math.log(size))


def test_lm_rare_words_are_symbols_of_their_own(spark, monkeypatch):
    """Words beyond the most frequent ones tell target from background, in any number of blocks."""
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(lm_scoring, "PART_BYTES", 4000)
    rows = [(i, " ".join(f"w{i % 2}x{(7 * i + j) % 4000}" for j in range(40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    target = spark.createDataFrame([(i,) for i in range(0, 400, 4)], "doc_id long")
    uni, pairs, n = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    seqs = {d: ["", *t.split(), ""] for d, t in rows}
    for d, s in seqs.items():
        for m in (0, 1):
            if m or d % 4 == 0:
                uni[m].update(s[1:])
                pairs[m].update(zip(s, s[1:]))
                n[m] += len(s) - 1
    size = len(uni[1])
    assert size > lm_scoring.SYMBOLS
    prob = lambda m, v, w: (pairs[m][v, w] + 50 * (uni[m][w] + 1) / (n[m] + size)) / (uni[m][v] + 50)
    for found in (lm_scoring.score(docs, *lm_scoring.models(docs, target)), lm_scoring.scored(docs, target)):
        got = {r.doc_id: r for r in found.collect()}
        assert len(got) == len(rows)
        for d, s in seqs.items():
            want = [np.mean([-math.log(prob(m, v, w)) for v, w in zip(s, s[1:])]) for m in (0, 1)]
            assert (got[d].target_loss, got[d].background_loss) == pytest.approx(tuple(want), abs=1e-9)
    assert lm_scoring.scored(docs.limit(0), target).count() == 0
