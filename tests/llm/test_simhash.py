import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from fleetwise.llm import simhash as S
from fleetwise.llm.common import components


def plain(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), seed=42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, distance=3):
    """Smallest index reachable, by comparing all pairs."""
    of = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2 ** 64 - 1)).count("1") <= distance and of[i] != of[j]:
                a, b = sorted((of[i], of[j]))
                of = [a if x == b else x for x in of]
    return of


def test_fingerprints_and_components(spark):
    base = " ".join(f"w{i}" for i in range(300))
    texts = [base, base.upper(), base.replace("w7 ", "x "), None, "", " \t", "one", "one two", "a b c", "A\nb  c", base + " z"]
    texts += [" ".join(f"v{i * j % 97}" for i in range(60)) for j in range(1, 20)]
    docs = spark.createDataFrame([(i + 5, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id - 5: r for r in S.near_duplicates(docs).collect()}
    fps = [plain(t) for t in texts]
    assert [got[i].fp & (2 ** 64 - 1) for i in range(len(texts))] == fps
    assert [got[i].component_id - 5 for i in range(len(texts))] == groups(fps)
    assert fps[3] == 0 and got[3].component_id == got[4].component_id == 8


@pytest.mark.parametrize("distance", [2, 3])
@pytest.mark.parametrize("hot", [8, 10_000])
def test_hot_keys_lose_no_component(spark, monkeypatch, hot, distance):
    monkeypatch.setattr(S, "HOT", hot)
    rng = np.random.default_rng(distance)
    base = int(rng.integers(0, 2 ** 63))
    fps = {base}
    for _ in range(120):
        x = base
        for b in rng.integers(0, 64, rng.integers(1, 6)):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps | {int(x) for x in rng.integers(0, 2 ** 63, 30)})
    links = S.linked(spark.createDataFrame([(x,) for x in fps], "fp long"), distance)
    rows = links.collect()
    assert all(bin((r.a ^ r.b) & (2 ** 64 - 1)).count("1") <= distance for r in rows)
    found = {r.node: r.component for r in components(links).collect()}
    assert [fps.index(found.get(x, x)) for x in fps] == groups(fps, distance)


def under_broadcasts(plan):
    """Lines of a plan's text below its broadcasts."""
    out, at = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        at = None if at is not None and depth <= at else at
        if at is not None:
            out.append(line)
        elif "BroadcastExchange" in line:
            at = depth
    return out


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_turned_keys_are_not_broadcast(spark):
    # each of the 300 fingerprints has 4 keys, and 17 forms of each; the planner sizes these by the keys
    rng = np.random.default_rng(7)
    fps = sorted({int(x) for x in rng.integers(0, 2 ** 62, 300)} | {int(1 << a) for a in range(62)})
    links = S.linked(spark.createDataFrame([(x,) for x in fps], "fp long"), 3)
    plan = final_plan(links)
    assert "Generate explode" in plan and not [x for x in under_broadcasts(plan) if "Generate" in x]
    assert {(r.a, r.b) for r in links.collect()} == {(a, b) for b in fps for a in fps if a < b and (a ^ b).bit_count() <= 3}


def test_exploded_points_are_not_broadcast(spark, monkeypatch):
    # 80 fingerprints around one have 2,081 points each; the planner sizes them by the 80 rows before the explode
    monkeypatch.setattr(S, "HOT", 8)
    rng = np.random.default_rng(5)
    fps = sorted({int(1 << a | 1 << b | 1 << c) for a, b, c in rng.integers(0, 62, (80, 3))})
    links = S.linked(spark.createDataFrame([(x,) for x in fps], "fp long"), 3)
    found = {r.node: r.component for r in components(links).collect()}
    assert [fps.index(found.get(x, x)) for x in fps] == groups(fps)
    plan = final_plan(links)
    assert "Generate explode" in plan and not [x for x in under_broadcasts(plan) if "Generate" in x]


def test_points_are_spread_over_all_partitions(spark):
    fps = [1 << i for i in range(62)]
    links = S._through_points(spark.createDataFrame([(x,) for x in fps], "fp long").coalesce(1).distinct(), 3)
    assert "REPARTITION_BY_NUM" in final_plan(links)
    assert {(r.a, r.b) for r in links.collect()} >= {(1, x) for x in fps[1:]}


def test_one_document_of_each_group_stays(spark):
    t = " ".join(f"w{i}" for i in range(50))
    rows = [(2, t, "s"), (1, t, None), (1, t, "s"), (None, t, "s"), (7, "quite another text here", "s"), (9, None, "s"), (8, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = S.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == [1, 7, 8, None]
    assert S.deduplicated(docs.limit(0)).count() == 0


def test_an_id_with_texts_of_several_groups_loses_none(spark):
    far = " ".join(f"v{i}" for i in range(40))
    rows = [(3, "b A"), (3, far), (7, "b A"), (3, "b A"), (9, far + " "), (11, "b  a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("root", F.lit(1))
    got = S.deduplicated(docs).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(3, "b A"), (3, far)])
