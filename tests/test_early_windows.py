"""Goldens recorded in the reference's comments for the early-firing demos."""

from conftest import timeline

from fleetwise.operators.early import LONG_MAX, early_session, early_tumbling

B_SCRIPT = [("W", 0), ("E", 1, 0, 1), ("E", 1, 0, 2), ("W", 1), ("E", 2, 0, 2), ("E", 3, 0, 2), ("W", 3),
            ("E", 4, 0, 2), ("E", 5, 0, 2), ("W", 5)]


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_early_tumbling_3s(spark):
    out = early_tumbling(timeline(spark, B_SCRIPT, scale=1000), 3000)
    got = _rows(out, ["is_final", "fired_at", "total"])
    assert got == sorted([(False, 1000, 5), (False, 3000, 4), (True, 3000, 5), (True, LONG_MAX, 6)])


def test_early_tumbling_5s(spark):
    out = early_tumbling(timeline(spark, B_SCRIPT, scale=1000), 5000)
    got = _rows(out, ["is_final", "fired_at", "total"])
    assert got == sorted([(False, 1000, 5), (False, 3000, 9), (True, 5000, 9), (True, LONG_MAX, 2)])


C_HEAD = [("W", 0), ("E", 1000, 0, 1), ("E", 2000, 0, 4), ("E", 3000, 0, 4), ("E", 4000, 0, 4), ("W", 5000),
          ("E", 6000, 0, 5)]
C_TAIL = [("E", 7000, 0, 4), ("W", 10000), ("W", 20000), ("W", 30000), ("W", 40000)]


def test_early_session_case1_with_intermediate_watermark(spark):
    out = early_session(timeline(spark, C_HEAD + [("W", 6500)] + C_TAIL), 5000)
    got = _rows(out, ["window_end", "fired_at", "values", "is_final"])
    assert got == [(11000, 6500, [1, 4, 4, 4, 5], False), (12000, 20000, [1, 4, 4, 4, 4, 5], True)]


def test_early_session_case2_without(spark):
    out = early_session(timeline(spark, C_HEAD + C_TAIL), 5000)
    got = _rows(out, ["window_end", "fired_at", "values", "is_final"])
    assert got == [(12000, 10000, [1, 4, 4, 4, 4, 5], False)]


def test_finish_ordered_list_with_disorder(spark):
    # session with disorder, gap 1 h, bound 0: every element followed by its watermark
    pts = [(1552319238044, 0, 1), (1552319550448, 0, 4), (1552319851529, 0, 4), (1552320152653, 0, 4),
           (1552320237880, 0, 2), (1552320538612, 0, 4), (1552320839585, 0, 4), (1552320994646, 0, 5),
           (1552320945515, 0, 4), (1552321005515, 1, 1)]
    script = []
    wm = None
    for t, k, v in pts:
        script.append(("E", t, k, v))
        wm = t if wm is None else max(wm, t)
        script.append(("W", wm))
    out = early_session(timeline(spark, script), 3_600_000)
    final = {r["key"]: r["values"] for r in out.collect() if r["fired_at"] == LONG_MAX}
    assert final[0] == [1, 4, 4, 4, 2, 4, 4, 4, 5]
    assert final[1] == [1]


def test_finish_ordered_rows_disorder_fixture(spark):
    from fleetwise.operators.early import finish_ordered_rows
    pts = [(1552319238044, 0, 1), (1552319550448, 0, 4), (1552319851529, 0, 4), (1552320152653, 0, 4),
           (1552320237880, 0, 2), (1552320538612, 0, 4), (1552320839585, 0, 4), (1552320994646, 0, 5),
           (1552320945515, 0, 4), (1552321005515, 1, 1)]
    els = spark.createDataFrame([(i, t, k, v) for i, (t, k, v) in enumerate(pts)],
                                "seq bigint, time bigint, key bigint, value bigint")
    rows = finish_ordered_rows(els, 3_600_000).collect()
    lists = {}
    for r in sorted(rows, key=lambda r: (r.key, r.position)):
        lists.setdefault(r.key, []).append(r.value)
    assert lists == {0: [1, 4, 4, 4, 2, 4, 4, 4, 5], 1: [1]}


def test_early_tumbling_makes_the_watermarks_once(spark, monkeypatch):
    """The watermarked timeline feeds several passes; they read it from where it was written."""
    from fleetwise.operators import early, scan
    monkeypatch.setattr(scan, "TARGET_ROWS", 4)
    out = early_tumbling(timeline(spark, B_SCRIPT, scale=1000), 3000)
    assert _rows(out, ["is_final", "fired_at", "total"]) == sorted(
        [(False, 1000, 5), (False, 3000, 4), (True, 3000, 5), (True, early.LONG_MAX, 6)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and "parquet" in plan
