import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetwise.llm import queries as Q
from fleetwise.llm import secret_scan as S
from fleetwise.llm.automaton import compile_dfa, parse

PARTS = ["token", "secret", "Password", "API_KEY", "apikey", "passwd", "=", ":", " ", '"', "'", "abc", "deadbeef0123", "AKIA", "ABCDEFGH1234",
         "é", "\n", "0123456789abcdef", "ghp_", "eyJab", ".", "-----BEGIN ", "PRIVATE KEY-----", "RSA ", "http", "://", "user", "@", "xoxb-", "-", "0" * 24]


def plain(text, rules=S.RULES):
    """Leftmost matches of each rule that do not overlap, by the library."""
    out = []
    for k, rule in enumerate(rules):
        for m in re.finditer(rule.pattern.encode(), text):
            head = re.match(rule.head.encode(), m.group()).end() if rule.head else 0
            if len(m.group()) - head >= rule.least:
                point = lambda o: sum(b & 0xC0 != 0x80 for b in text[:o])
                out.append((point(m.start()), k, point(m.end())))
    return sorted(out)


@pytest.mark.parametrize("narrow", [1, 4, 96])
def test_spans_against_library(monkeypatch, narrow):
    monkeypatch.setattr(S, "NARROW", narrow)
    scanner, rnd = S.Scanner(S.RULES), random.Random(narrow)
    for _ in range(300):
        texts = ["".join(rnd.choices(PARTS, k=rnd.randrange(60))).encode() for _ in range(rnd.randrange(1, 12))]
        assert scanner.spans(texts) == [plain(t) for t in texts]


@pytest.mark.parametrize("pattern", ["ab{2,3}c?", "(ab|a)*c", "[^a-c]+x", r"(?i:k[ey]+)\x3d\d{2,}", "a(b|c(d|e))+", r"\[\w*\]", "(a|b){2}(c{0,2}d)?"])
def test_automaton_is_the_regex(pattern):
    """Prefixes accepted from the front, and starts found from the back, on all short strings of a small alphabet."""
    front, back = compile_dfa([parse(pattern)]), compile_dfa([parse(pattern)], backward=True, anywhere=True)
    rnd = random.Random(pattern)
    for _ in range(1500):
        s = bytes(rnd.choices(b"abcdexkKEy=12[]_ ", k=rnd.randrange(9)))
        state, ends = 0, set()
        for i, b in enumerate(s):
            state = front.table[state, front.klass[b]]
            if front.tags[state]:
                ends.add(i + 1)
        whole = re.compile(pattern.encode())
        assert ends == {e for e in range(1, len(s) + 1) if whole.fullmatch(s, 0, e)}
        state, starts = 0, set()
        for i in reversed(range(len(s))):
            state = back.table[state, back.klass[s[i]]]
            if back.tags[state]:
                starts.add(i)
        assert starts == {i for i in range(len(s)) if whole.match(s, i)}


def test_minimal_and_refused():
    assert len(compile_dfa([parse("abc|abd|xbc|xbd")]).table) == 5  # start, two on the way, end, dead
    for bad in ("a*", "(a|b?)", "a(", "[a", "a)", ".", "é"):
        with pytest.raises(ValueError):
            compile_dfa([parse(bad)])
    with pytest.raises(ValueError):
        S.Scanner([S.Rule("a", "b"), S.Rule("a", "c")])


def test_rows_texts_and_columns(spark):
    long_one = "x" * 20_000 + "token=abcdefgh " + "0" * 20_000
    rows = [(1, None), (None, ""), (2, "a token = \"0123456789abcdef01234567\" é"), (2, "a token = \"0123456789abcdef01234567\" é"),
            (3, long_one), (4, "secret=token:abcdefgh token=abc"), (5, "é" * 5 + "AKIA" + "A1" * 8), (6, "API_key: 'p" + "=" * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Secrets", F.lit(7)).withColumn("kind", F.lit("k"))
    got = S.scan(docs)
    assert got.columns == ["doc_id", "text", "Secrets", "kind", "_secrets"]
    kinds = [r.kind for r in S.RULES]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert [(s.start, kinds.index(s.kind), s.end) for s in r["_secrets"]] == plain((r.text or "").encode())
    by_id = {r.doc_id: [tuple(s) for s in r["_secrets"]] for r in found}
    assert by_id[4] == [] and by_id[5] == [("access", 5, 25)] and by_id[6] == [("assign", 0, 17)]
    assert by_id[2] == [("assign", 2, 35), ("hex", 11, 35)]
    assert by_id[3] == [("assign", 20000, 20014), ("hex", 20015, 40015)]
    assert S.scan(docs.limit(0)).count() == 0
    own = S.scan(docs.drop("Secrets"), [S.Rule("x", "x+", least=4)]).where("doc_id = 3").first()
    assert [tuple(s) for s in own.secrets] == [("x", 0, 20000)]


def test_query_digests(spark, tmp_path):
    rows = [(1, None), (2, 'token = "0123456789abcdef01234567" ghp_' + "z" * 40), (3, "AKIA" + "A" * 16 + " 0123456789abcdef01234567")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in Q.QUERIES["op11_secret_scan"](spark, str(tmp_path)).collect()}
    assert [(r.n_assign, r.n_access, r.n_hex) for r in map(got.get, (1, 2, 3))] == [(0, 0, 0), (1, 0, 1), (0, 1, 1)]
    assert got[1].base_sha256 == hashlib.sha256(b"").hexdigest() and got[1].spans == ""
    assert got[2].spans == "assign:0:33,hex:9:33,github:35:79"
    assert got[2].base_sha256 == hashlib.sha256(b"assign:0:33,hex:9:33").hexdigest()
    assert got[3].spans == "access:0:20,hex:21:45"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rel = con.sql(Q.ORACLES["op11_secret_scan"])
    assert {tuple(got[r[0]]) for r in rel.fetchall()} == {tuple(r) for r in got.values()}
