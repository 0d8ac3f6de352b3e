import collections
import hashlib
import random

import numpy as np
import pytest

from fleetwise.llm import repeats as R


def plain(texts, length=R.LENGTH):
    seen = collections.Counter()
    raws = [(t or "").encode() for t in texts]
    for r in raws:
        seen.update(r[i:i + length] for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        covered = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                covered[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        kept = bytes(b for b, c in zip(r, covered) if not c)
        out.append((len(r), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fixture():
    random.seed(5)
    prose = lambda n: " ".join(random.choice(["ab", "cde", "fghi", "é", "the", "of", "xyz"]) for _ in range(n))
    p, q = prose(150), prose(90)
    texts = ["", None, "a" * 500, "b" * 199, "b" * 200, p, p, prose(30) + p + prose(30), prose(30) + p[100:400] + prose(5), q * 3,
             prose(100) + q, "ab" * 300, prose(10) + "a" * 230]
    for _ in range(25):
        at = random.randint(0, len(p) - 220)
        texts.append(prose(20) + p[at:at + random.randint(190, 400)] + prose(20))
    return texts


@pytest.mark.parametrize("group", [3, 256])
def test_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(R, "GROUP", group)
    texts = fixture()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, t string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.without_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts)
    assert R.without_repeats(docs.limit(0)).count() == 0


def test_suffix_sort_is_the_order_of_the_suffixes():
    rng = np.random.default_rng(2)
    parts = [bytes(rng.integers(97, 99, rng.integers(1, 40)).astype(np.uint8)) for _ in range(300)]
    sizes = np.array([50, 1, 2, 97, 150])
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    s = R.Suffixes(data, ends - np.array([len(p) for p in parts]), ends)
    order = s.sort(begin, sizes)
    group = np.repeat(np.arange(5), sizes)
    assert [(group[i], parts[i]) for i in order] == sorted(zip(group, parts))
    plain_order, common = R._plain_order(data, s.begin, ends, group)
    assert [parts[i] for i in plain_order] == [parts[i] for i in order]
    assert (s.neighbours(order) == common).all()


def test_a_hash_collision_is_found_and_mended(monkeypatch):
    contexts = [b"x" * 60 + bytes([i]) * 300 for i in range(4)]
    want = R.repeated_windows(contexts, np.full(4, 100), np.zeros(4, int))
    monkeypatch.setattr(R.Suffixes, "common", lambda self, x, y: np.minimum(self.size[x], self.size[y]))
    assert (R.repeated_windows(contexts, np.full(4, 100), np.zeros(4, int)) == want).all()


def test_anchors_of_long_texts_are_cut_in_pieces(monkeypatch):
    data = np.frombuffer(np.random.default_rng(1).integers(97, 110, 5000).astype(np.uint8).tobytes(), np.uint8)
    whole = R.anchors(data)
    monkeypatch.setattr(R, "CHUNK", 700)
    cut = R.anchors(data)
    starts = lambda a: sorted((s, p) for p, lo, hi in zip(*a[1:]) for s in range(lo, hi + 1))
    assert starts(whole) == starts(cut)
