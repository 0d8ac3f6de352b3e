import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetwise.llm import token_files as T
from fleetwise.llm.common import scratch
from fleetwise.llm.queries import tokenizer_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=700))
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    starts, area = T.pack_blocks(ids)
    assert (T.unpack_blocks(starts, area, len(ids)) == ids).all()


def test_outliers_go_to_the_exception_list():
    ids = np.full(T.BLOCK, 7, np.uint32)
    ids[3] = 2 ** 31
    starts, area = T.pack_blocks(ids)
    assert len(area) == 7 + 2 + 4  # width 0, one patched value
    assert (T.unpack_blocks(starts, area, len(ids)) == ids).all()


def test_chunked_encoding_is_the_library_s():
    enc = T.Encoder(tokenizer_path())
    random.seed(1)
    signs = "ab's ,\n\t   é1\x1c\x85　'll<|endoftext|>"
    texts = ["".join(random.choice(signs) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    want = [e.ids + [2] for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode(texts, 2)] == want


def test_files(spark, monkeypatch):
    rows = [(3, "b c"), (1, "a a a"), (None, "null id"), (2, None), (5, ""), (4, "x " * 20000), (1, "a a a"), (1, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS start", "2 AS payload")
    path = scratch(spark, "t")
    T.write_tokens(docs, path, tokenizer_path(), 2, partitions=3)
    got = sorted(T.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 1, 1, 2, 3, 4, 5]
    enc = T.Encoder(tokenizer_path())
    at, seen = 0, []
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        at += r.n_tokens
        seen.append((r.doc_id, tuple(r.ids)))
    assert sorted(seen, key=str) == sorted(((d, (*enc.tok.encode(t or "", add_special_tokens=False).ids, 2)) for d, t in rows), key=str)
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in T.token_digest(spark, path).collect()}
    assert digest == {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}
    assert T.encode_and_read_back(docs.limit(0), tokenizer_path()).count() == 0


def test_added_tokens_are_the_library_s():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    random.seed(2)
    signs = [*"ab's ,\n\té1", " ", " word", "<|endoftext|>", "<|endoftext|>", "<|end", "oftext|>"]
    texts = ["end of text <|endoftext|> next", "<|endoftext|>"]
    texts += ["".join(random.choice(signs) for _ in range(random.randint(0, 20))) for _ in range(3000)]
    want = [e.ids + [2] for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert 50256 in want[0] and [x.tolist() for x in T.Encoder(tokenizer_path()).encode(texts, 2)] == want


def test_forgetting_changes_no_id():
    """A memory far too small for the texts, over many batches: the ids are the library's, and the memory stays bounded."""
    from tokenizers import Tokenizer
    tok, enc = Tokenizer.from_file(tokenizer_path()), T.Encoder(tokenizer_path(), memo_bytes=1 << 16)
    random.seed(3)
    words = ["".join(random.choices("abcdeé,.", k=random.randrange(1, 9))) for _ in range(2000)]
    for _ in range(40):
        texts = [" ".join(random.choices(words, k=40)).replace("a ", "a\n") for _ in range(20)]
        assert [x.tolist() for x in enc.encode(texts, 2)] == [e.ids + [2] for e in tok.encode_batch(texts, add_special_tokens=False)]
        assert len(enc.memo) < (1 << 16) / T._ENTRY + 2 * 800


def test_pieces_and_signs_are_the_library_s():
    """Letters of all bytes, each with every sign or none, and words that are one piece only nearly; those known to be
    one piece are not split again."""
    from tokenizers import Tokenizer
    tok, enc = Tokenizer.from_file(tokenizer_path()), T.Encoder(tokenizer_path())
    random.seed(4)
    letters = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xc0, 0x24f)]))
    words = ["".join(random.choices(letters, k=random.randrange(1, 12))) for _ in range(2000)]
    near = ["don't", "'s,", "'ll", "a,,", "x9", "9.", "\xaa\xb5\xba", "\xd7\xf7,", "e\u0301,", "漢字,", "\u0250a", ",", "?!", "a-b", "\U0001f600"]
    texts = [" ".join(w + s for w in random.choices(words + near, k=30) for s in [random.choice(["", *T._SIGNS])]) or "a" for _ in range(300)]
    texts += [t.replace(", ", ",\n") for t in texts]
    assert [x.tolist() for x in enc.encode(texts, 2)] == [e.ids + [2] for e in tok.encode_batch(texts, add_special_tokens=False)]

    class Counting:
        def __init__(self, pieces):
            self.pieces, self.words = pieces, 0

        def encode_batch_fast(self, texts, **how):
            self.words += sum(t.count(enc.letters[32]) for t in texts)
            return self.pieces.encode_batch_fast(texts, **how)

    enc.pieces = Counting(enc.pieces)
    enc.encode(["never seenbefore, wordsofletters; alone"], 2)
    assert enc.pieces.words == 3  # the first follows the line end that is put in front


def test_other_white_space_is_complete():
    assert set(T._OTHER_SPACE) == {c for c in map(chr, range(0x110000)) if (c.isspace() or c in "\x1c\x1d\x1e\x1f\x85") and c not in " \n"}
