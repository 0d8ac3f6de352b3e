import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwise.llm import hard_negatives as H


@pytest.mark.parametrize("dim,size", [(1, 10), (3, 2 ** 29), (64, 300), (64, 2 ** 27), (1024, 2 ** 20), (9000, 2 ** 20), (0, 1)])
def test_products_are_exact(dim, size):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-size, size, (7, dim)), rng.integers(-size, size, (11, dim))
    a[0], b[0] = size, -size
    want = a.astype(object) @ b.astype(object).T if dim else np.zeros((7, 11), object)
    got = H.products(H.Residues(a), slice(1, 7), H.Residues(b), slice(0, 11))
    assert got.dtype == np.int64 and (got == want[1:]).all()
    assert (H.products(H.Residues(a), slice(0, 1), H.Residues(b), slice(0, 1)) == want[:1, :1]).all()


def test_primes_keep_sums_exact():
    for dim in (1, 2, 64, 1000, 4096):
        assert all(dim * ((p - 1) // 2) ** 2 <= 1 << 24 for p in H.primes(dim))
        assert sum(np.log2(H.primes(dim))) > 63


def plain(rows, anchor, scale=256, k=5, low=80):
    """The definition, row by row."""
    every = sorted({(i, lab, tuple(int(np.floor(scale * float(x))) for x in v)) for i, v, lab in rows
                    if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
                    and sum((scale * x) * (scale * x) for x in v) < 2.0 ** 61})
    out = []
    for i, lab, c in every:
        if not anchor(i):
            continue
        near = sorted((-sum(x * y for x, y in zip(c, d)), j, m == lab) for j, m, d in every if j != i and len(d) == len(c))
        for p, j, own in [x for x in near if x[2]][:k]:
            fits = [(s, o) for s, o, same in near if not same and low * -p <= 100 * -s <= 100 * -p][:k]
            out += [(i, j, r + 1, o, -p, -s) for r, (s, o) in enumerate(fits)]
    return sorted(out)


def rows_of(n, dim, rng, hot=0.3):
    same = rng.standard_normal(dim).tolist()
    return [(i, same if rng.random() < hot else rng.standard_normal(dim).tolist(), int(rng.integers(0, 3)) if rng.random() < 0.6 else 1)
            for i in range(n)]


@pytest.mark.parametrize("tile,pairs,chunk", [(1 << 20, 1 << 23, 16 << 20), (50, 40, 64)])
def test_against_definition(spark, monkeypatch, tile, pairs, chunk):
    monkeypatch.setattr(H, "TILE", tile)
    monkeypatch.setattr(H, "CELL_PAIRS", pairs)
    monkeypatch.setattr(H, "CHUNK_BYTES", chunk)
    rng = np.random.default_rng(5)
    rows = rows_of(400, 6, rng) + [(1000 + i, rng.standard_normal(2).tolist(), 1) for i in range(40)]
    edge = [(2000, None, 1), (2001, [], 1), (2020, [], 1), (2002, [], 2), (2003, [None] * 6, 1), (2004, [float("nan")] * 6, 1), (2005, [float("inf")] * 6, 1),
            (None, rows[0][1], 1), (2006, rows[0][1], None), (20, rows[3][1], 2), (40, rows[40][1], rows[40][2]), (41, rows[5][1], 1),
            (2007, [1e200] * 6, 1), (2008, [-3e5] * 6, 1), (2009, [3e5] * 6, 2), (2040, [3e5] * 6, 1), (2010, [0.0] * 6, 1)]
    data = rows + edge
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(5).withColumn("score", F.lit(1)).withColumn("nr", F.lit(2))
    got = sorted(map(tuple, H.mine(df, F.col("vec_id") % 20 == 0).collect()))
    want = plain(data, lambda i: i % 20 == 0)
    assert got == want and len(got) > 100


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.8, 0.0], 2)], "vec_id long, embedding array<float>, label int")
    got = H.mine(df, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 256 * 230, 256 * 204)]
    assert H.mine(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert H.mine(df.where("vec_id <> 1"), F.col("vec_id") == 0).count() == 0  # no positive
    assert H.mine(df, F.col("vec_id") == 7).count() == 0  # no anchor


def test_bounds_stay_in_64_bits(spark):
    scores = [0, 1, -1, 99, -99, 100, -101, 2 ** 61 - 1, -(2 ** 61) + 1, 12345678901234567]
    df = spark.createDataFrame([(s,) for s in scores], "s long")
    for percent in (80, 100, 120, 7):
        got = df.select("s", H._percent(F.col("s"), percent, F.ceil), H._percent(F.col("s"), percent, F.floor)).collect()
        for s, up, down in got:
            assert (up, down) == (-(-s * percent // 100), s * percent // 100)
