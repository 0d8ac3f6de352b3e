import random

import pytest
from pyspark.sql import functions as F

from fleetwise.llm import decontamination as D
from fleetwise.llm import line_dedup as L
from fleetwise.llm import mixing as M


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Sharing and resharing until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        each = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if each[s] > cap * sizes[s]]
        if not above:
            return each | fixed
        fixed |= {s: cap * sizes[s] for s in above}


def test_mix(spark):
    rows = [(i, "w " * (i % 13), src) for i, src in enumerate(["a", "b", "c", "d", "é", None] * 40)]
    rows += [(1000 + i, "x " * 50, "b") for i in range(60)] + [(7, "tie tie tie", "c")] * 9 + [(2000, None, "a"), (None, "n n", "b"), (3000, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("target", F.lit("old")).repartition(4)
    got = M.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, want_size = {}, {}, {}
    for r in got:
        assert r["size"] == len((r.text or "").split()) and r.taken <= 2 * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        want_size[r.source] = (r.source_size, r.target)
    want = targets(sizes)
    for s in sizes:
        assert want_size[s][0] == sizes[s] and want_size[s][1] == pytest.approx(want[s])
        assert 0 <= want[s] - taken[s] < 10  # to the word, but for the rows that tie at the cut
    again = M.mix(docs.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert M.mix(docs.limit(0)).count() == 0


def test_mixed_documents(spark):
    rows = [(i, " ".join(f"{s}{i}_{j}" for j in range(1 + i % 9)), s, 3) for i in range(90) for s in ("a", "b", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").withColumn("epochs", F.lit("mine"))
    plan = {(r.doc_id, r.source): r.taken for r in M.mix(docs).collect()}
    got = M.mixed(docs)
    assert got.columns == docs.columns
    words, whole = {}, {(r[0], r[2]): r[1] for r in rows}
    for r in got.collect():
        words[r.doc_id, r.source] = words.get((r.doc_id, r.source), 0) + len(r.text.split())
        assert whole[r.doc_id, r.source].startswith(r.text) and r.epochs == "mine"
        assert r.n_chars == (3 if r.text == whole[r.doc_id, r.source] else len(r.text))
    assert words == {k: v for k, v in plan.items() if v}


def test_lines_against_all_pairs(spark):
    base = [f"t{i}" for i in range(20)]
    texts = ["\n".join([" ".join(base), "a b c", "", "!!"]), " ".join(base[::-1]).upper(), " ".join(base[:18]), " ".join(base[:15]),
             "c, b: a\nd e f g", "d e f g h\nd e f g h i j", None, "", " ".join(base[1:] + ["q"]), "a b c d"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "a b c"), (None, "d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line_no", F.lit(5)).withColumn("c", F.lit(1))
    place = lambda d, n: (-1 if d is None else d, n)
    every = [(d, n, frozenset(w for w in "".join(c if c.isalnum() else " " for c in line.lower()).split()))
             for d, t in rows if t for n, line in enumerate(t.split("\n"))]
    every = [x for x in every if x[2]]
    sets = {s for _, _, s in every}
    like = lambda a, b: len(a & b) / len(a | b) >= 0.8
    want = sorted((str(d), n, sum(like(s, o) for o in sets if o != s),
                   any(like(s, o) and place(e, m) < place(d, n) for e, m, o in every)) for d, n, s in every)
    got = sorted((str(r.doc_id), r.line_no, r.n_links, r.removed) for r in L.matched_lines(docs).collect())
    assert got == want
    kept = {(r.doc_id, r.text) for r in L.without_matched_lines(docs).collect()}
    assert (6, None) in kept and (1, "") in kept and (0, texts[0].replace("a b c", "a b c")) not in {(4, texts[4])}
    assert L.matched_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("similarity", [0.7, 0.5, 0.95])
def test_lines_at_other_similarities(spark, similarity):
    rnd = random.Random(int(similarity * 100))
    texts = ["\n".join(" ".join(rnd.sample("abcdefgh", rnd.randrange(1, 7))) for _ in range(8)) for _ in range(12)]
    texts += ["a b c", "a b c d", " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(20, 400))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    every = [(d, n, frozenset(line.split())) for d, t in enumerate(texts) for n, line in enumerate(t.split("\n"))]
    sets = {s for _, _, s in every}
    like = lambda a, b: len(a & b) >= similarity * len(a | b) - 1e-9
    want = sorted((d, n, sum(like(s, o) for o in sets if o != s), any(like(s, o) and (e, m) < (d, n) for e, m, o in every)) for d, n, s in every)
    got = sorted((r.doc_id, r.line_no, r.n_links, r.removed) for r in L.matched_lines(docs, similarity).collect())
    assert got == want


def test_long_lines_that_differ_are_no_candidates(spark, monkeypatch):
    """Long unlike lines that share rare tokens are pruned before the sets are fetched, and no link is lost."""
    rnd = random.Random(5)
    base = [rnd.sample([f"w{i}" for i in range(400)], 130) for _ in range(60)]
    texts = [" ".join(b) for b in base] + [" ".join(b[:120] + ["extra"]) for b in base[:10]]
    sizes, kept = {}, L.stored

    def counted(df, what):
        out = kept(df, what)
        sizes[what] = out.count()
        return out

    monkeypatch.setattr(L, "stored", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_links, r.removed) for r in L.matched_lines(docs).collect()}
    assert got == {i: (int(i < 10 or i >= 60), i >= 60) for i in range(70)}
    assert sizes["line-pairs"] == 10 and sizes["line-sets"] == 20


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_lines_of_all_sizes_that_share_a_rare_token(spark, similarity):
    """Such lines are joined by bands of sizes, and no link is lost within a band or between two."""
    sizes = list(range(1, 90)) + [128, 150, 160, 200, 250, 256]
    texts = [" ".join(["rare"] + [f"w{i}" for i in range(n - 1)]) for n in sizes] + ["w0 RARE", "w1 w2 w3 w4 rare"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    every = [(d, frozenset(t.lower().split())) for d, t in enumerate(texts)]
    sets = {s for _, s in every}
    like = lambda a, b: len(a & b) >= similarity * len(a | b) - 1e-9
    want = sorted((d, sum(like(s, o) for o in sets if o != s), any(like(s, o) and e < d for e, o in every)) for d, s in every)
    assert sorted((r.doc_id, r.n_links, r.removed) for r in L.matched_lines(docs, similarity).collect()) == want
    classes = spark.range(1, 257).select(F.col("id").alias("k"), F.col("id").alias("n"), F.lit(0).alias("low"), F.lit(0).alias("high"),
                                         F.array(F.lit(7)).alias("few"))
    most = L._prefix_rows(classes, similarity).groupBy("key").count().agg(F.max("count")).first()[0]
    assert most <= 256 * (1 - similarity ** L.BAND) + 2


def test_decontamination(spark):
    item = [f"k{i}" for i in range(20)]
    swapped = item[:3] + ["X"] + item[4:9] + ["Y"] + item[10:]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item).upper()), (3, "too short an item"), (4, None), (None, "n " * 9)],
                                      "item_id long, text string")
    rows = [(1, "pre " * 30 + ", ".join(item) + " post"), (2, " ".join(swapped)), (3, " ".join(item[:12])), (4, None), (5, ""),
            (6, " ".join(item[4:17]) + " z"), (7, "clean words only " * 50), (None, " ".join(item)), (1, "x"), (8, " ".join(item[::2] + item[1::2]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("t", F.lit(0)).withColumn("item_id", F.lit(0))
    got = {(r.doc_id, r.item_id): (r.matched, r.window) for r in D.contaminated(docs, benchmark).collect()}
    assert set(got) == {(d, i) for d in (1, 2, 3, 6, None) for i in (1, 2)}
    assert got[1, 1] == (13, 13) and got[2, 2][0] >= 11
    kept = D.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text is not None) == sorted(
        (str(d), t) for d, t in rows if t is not None and (d in (5, 7, 8) or t == "x"))
    assert D.clean(docs.limit(0), benchmark).count() == 0 and D.clean(docs, benchmark.limit(0)).count() == len(rows)


def test_every_place_of_two_substitutions_is_hit():
    from itertools import combinations
    for a, b in combinations(range(D.WINDOW), 2):
        assert any(all(s + o not in (a, b) for o in D.MASKS[0]) for s in range(D.WINDOW - D.SPAN + 1))


def test_items_of_any_length_against_all_diagonals(spark):
    """Every diagonal of every document and item, without seeds."""
    import random
    random.seed(3)
    items = [[f"i{n}p{j}" for j in range(n)] for n in range(1, 15)] + [["a", "b", "a", "b", "a"], ["c"] * 8]
    texts = []
    for item in items:
        n = len(item)
        for spoilt in (0, 1, 2, 3):
            for _ in range(4) if spoilt > 1 else range(n if spoilt else 1):
                at = {_} if spoilt == 1 else set(random.sample(range(n), min(n, spoilt)))
                texts.append(["x"] * random.randint(0, 2) + ["y" if j in at else w for j, w in enumerate(item)] + ["z"] * random.randint(0, 2))
        texts += [item[1:], item[:-1], item[2:]]
    texts += [[random.choice("abc") for _ in range(9)] for _ in range(30)]

    def best(text, item):
        window = min(len(item), D.WINDOW)
        same = [[0 <= j + s < len(text) and text[j + s] == w for j, w in enumerate(item)] for s in range(-len(item), len(text))]
        return max((sum(x[i:i + window]) for x in same for i in range(len(item) - window + 1)), default=0), window

    want = {(d, i): best(t, b) for d, t in enumerate(texts) for i, b in enumerate(items)}
    want = {k: (m, w) for k, (m, w) in want.items() if m >= D.SIMILARITY * w}
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(b)) for i, b in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id): (r.matched, r.window) for r in D.contaminated(docs, benchmark).collect()} == want
