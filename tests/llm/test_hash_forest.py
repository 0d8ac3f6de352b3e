import numpy as np
from pyspark.sql import functions as F

from fleetwise.llm import hash_forest as H
from fleetwise.llm import queries as Q


def plain(rows, queries, k=5):
    out = {}
    for q, v in queries:
        near = sorted({(-round(float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), 12), i) for i, w in rows if i != q})
        out[q] = [i for _, i in near[:k]]
    return out


def test_ids_with_several_vectors(spark):
    """Many near vectors of the query's own id, or of another one, crowd out no answer."""
    rng = np.random.default_rng(4)
    near = lambda: (np.array([1.0, 1.0, 1.0]) + rng.normal(0, 0.01, 3)).tolist()
    rows = [(0, near()) for _ in range(9)] + [(7, near()) for _ in range(8)] + [(i, rng.standard_normal(3).tolist()) for i in range(10, 18)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["rank"]): (r.vec_id, r.score) for r in H.nearest(df, F.col("vec_id") == 0, share=16.0).collect()}
    best = {}
    for i, w in rows:
        for q, v in rows:
            if q == 0 and i != 0:
                best[i] = max(best.get(i, -2), np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w))
    want = sorted(best, key=lambda i: -best[i])[:5]
    assert [got[r][0] for r in range(1, 6)] == want and all(abs(got[r][1] - best[got[r][0]]) < 1e-12 for r in got)


def test_extreme_lengths(spark):
    rows = [(0, [1e200, 1e200]), (1, [1.0, 1.0]), (2, [1e200, 2e200]), (3, [1e-200, 1e-200]), (4, [5e-324, 0.0]), (5, [-1e308, -1e308]), (6, [3.0, 3.0])]
    got = H.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=6).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [1, 3, 6, 2, 4, 5]
    score = {r.vec_id: r.score for r in got}
    assert score[1] == score[3] == score[6] and abs(score[1] - 1) < 1e-15
    assert abs(score[2] - 3 / 10 ** 0.5) < 1e-15 and abs(score[4] - 0.5 ** 0.5) < 1e-15 and abs(score[5] + 1) < 1e-15


def test_twenty_blocks_keep_recall(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 100)
    monkeypatch.setattr(H, "QUERIES", 16)
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((2000, 24)))]
    got = H.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    want = plain([(i, np.array(v)) for i, v in rows], [(i, np.array(v)) for i, v in rows if i % 50 == 0])
    hits = sum(r.vec_id in want[r.query_id] for r in got)
    assert len(got) == 200 and hits >= 180


def test_recall(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.QUERIES["op4_nearest_vectors"](spark, sf).collect()
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in Q.table(spark, sf, "embeddings").collect()]
    want = plain(rows, [r for r in rows if r[0] % 50 == 0])
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(found[r.query_id])
    assert set(found) == set(want) and all(len(v) == 5 for v in found.values())
    assert sum(len(set(found[q]) & set(want[q])) for q in want) / sum(map(len, want.values())) >= 0.9


def test_many_blocks_ties_and_unfit_vectors(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    monkeypatch.setattr(H, "QUERIES", 2)
    rng = np.random.default_rng(3)
    same = [1.0, 2.0, 0.0]
    rows = [(i, same) for i in range(0, 400, 7)] + [(i, rng.standard_normal(3).tolist()) for i in range(1, 400) if i % 7]
    unfit = [(1000, None), (1050, []), (1100, [0.0, 0.0, 0.0]), (1150, [1.0, None, 0.0]), (1200, [float("nan"), 1.0, 1.0]),
             (1250, [float("inf"), 1.0, 1.0]), (None, same), (50, rows[-1][1])]
    docs = spark.createDataFrame([*rows, *unfit, rows[0]], "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = H.nearest(docs, F.col("vec_id") % 50 == 0, share=16.0).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
    every = [*rows, unfit[-1]]
    want = plain(every, [(i, v) for i, v in every if i % 50 == 0 and i != 50])
    assert {q: v for q, v in found.items() if q != 50} == want
    assert want[0] == [7, 14, 21, 28, 35] and len(found[50]) == 5


def test_few_rows(spark):
    two = spark.createDataFrame([(0, [1.0, 0.0]), (3, [1.0, 1.0]), (50, [1.0])], "vec_id long, embedding array<float>")
    got = H.nearest(two, F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 3)]
    assert abs(got[0].score - 0.5 ** 0.5) < 1e-15
    assert H.nearest(two.limit(0), F.col("vec_id") % 50 == 0).count() == 0
