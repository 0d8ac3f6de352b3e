"""Language-model scores by cross-entropy difference.

Two bigram models with one vocabulary and one smoothing are counted, one over
the target documents, one over all documents (the background).  A document's
score is the mean over its tokens of target loss minus background loss: the
lower, the closer to the target.

Every different word is a symbol of its own, by its 64-bit hash, and so is
every different pair; both tables grow with the corpus.  Documents are taken
in *blocks* of about ``BLOCK_TOKENS`` tokens.  A block sends each of its
different words and pairs once, with its sums, to the part that holds the
hash; parts are ranges of hashes, as many as the bytes of text ask for.  A
part adds the sums up and answers each block with the counts of what it sent,
in the same order.  So a word or pair that is everywhere costs a number for
each block, and no task holds more than a block or a part.  The driver sees
the sums of blocks and parts only.

``scored`` counts and scores the same documents in one go; ``models`` keeps
the counts as a table, by which ``score`` scores any documents.

Probabilities are interpolated with unigrams (Dirichlet prior of strength
``PRIOR``), and unigrams with one count per symbol, where the vocabulary is
taken to have ``SYMBOLS`` symbols at least.  The text's begin and end are one
more symbol.

Defined cases: a null or empty text has the one token of its end; without any
target document the target model is uniform; target ids may repeat or be
missing from the documents; a null doc_id is background and is scored;
repeated documents count each time; an empty table gives no row; words and
pairs that were never counted have count 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwise.llm.common import stored
from fleetwise.llm.subwords import Numbered

WORDS, CLASSES = 1535, 512
SYMBOLS = WORDS + CLASSES + 1  # symbol 0 is the text's begin and end
PRIOR = 50.0
MEMO = 500_000
BLOCK_TOKENS = 1 << 20
PART_BYTES = 32 << 20  # bytes of text for each part of the tables


class Symbols:
    """Symbols of a closed vocabulary, rare words in classes; the models no longer use them."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.seen, self.symbol = Numbered(), np.zeros(0, np.int64)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """The symbols of each text between its begin and end."""
        if len(self.seen) > MEMO:
            self.forget()
        look = self.seen.__getitem__
        out = []
        for t in texts:
            words = _split(t)
            out.append(np.fromiter(map(look, words), np.int64, len(words)))
        if self.seen.new:
            new = [self.vocabulary.get(w) or 1 + WORDS + zlib.crc32(w) % CLASSES for w in self.seen.new]
            self.symbol = np.concatenate([self.symbol, np.array(new, np.int64)])
            self.seen.new = []
        return [np.concatenate([[0], self.symbol[o], [0]]) for o in out]


def _split(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z): runs of anything but blanks and ASCII controls 9 to 13."""
    return text.encode().lower().split() if text else []


class Block:
    """Different words of consecutive documents and the documents as places among them; place 0 is begin and end."""

    def __init__(self):
        self.seen = Numbered()
        self.seen[b""]
        self.seqs: list[np.ndarray] = []
        self.tokens = 0

    def add(self, text: str | None) -> None:
        words = _split(text)
        seq = np.zeros(len(words) + 2, np.int32)
        seq[1:-1] = np.fromiter(map(self.seen.__getitem__, words), np.int32, len(words))
        self.seqs.append(seq)
        self.tokens += len(seq) - 1

    def hashes(self) -> np.ndarray:
        """Of each word; the last bit tells words (1) from pairs (0)."""
        return np.frombuffer(b"".join(blake2b(w, digest_size=8).digest() for w in self.seen), "<u8") | np.uint64(1)


class Pairs:
    """The pairs of a block's documents and the keys of its words and pairs in ascending order."""

    def __init__(self, words: np.ndarray, seq: np.ndarray, sizes: np.ndarray):
        inner = np.ones(len(seq), bool)
        inner[np.cumsum(sizes) - 1] = False
        at = np.flatnonzero(inner)  # where a pair begins
        pairs, self.pair = np.unique(seq[at].astype(np.int64) * len(words) + seq[at + 1], return_inverse=True)
        self.before, self.after = np.divmod(pairs, len(words))
        self.n_words = len(words)
        keys = np.concatenate([words, _mixed(words[self.before], words[self.after])])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def counts(self, weight: np.ndarray | None = None) -> np.ndarray:
        """How often each key occurs, each pair weighted."""
        n = np.bincount(self.pair, weight, len(self.after))
        return np.concatenate([np.bincount(self.after, n, self.n_words), n]).astype(np.int64)[self.order]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of each pair of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    for by in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(by)
    return (x ^ (x >> np.uint64(33))) & ~np.uint64(1)


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins and the last ends among ascending keys."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _pack(v: np.ndarray) -> bytes:
    """Numbers from 0 as compressed byte planes."""
    width = max(1, -(-int(v.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    squeeze = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return bytes([width]) + squeeze.compress(planes.tobytes()) + squeeze.flush()


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed[1:]), np.uint8).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :packed[0]] = planes.T
    return out.reshape(-1).view("<u8")


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed), dtype=np.uint64)


_BLOCKS = "block long, words binary, seq binary, sizes binary, doc_ids array<long>"
_ROWS = "part int, block long, keys binary, background binary, target binary"
_TOTALS = ", words long, background_tokens long, target_tokens long"
_ANSWERS = "block long, part int, background binary, target binary" + _TOTALS
_TABLE = _ROWS + _TOTALS
_SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents (doc_id, text)."""
    from pyspark import TaskContext
    number = TaskContext.get().partitionId() << 32
    block, ids = Block(), []

    def out():
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()), "words": pa.array([block.hashes().tobytes()], pa.binary()),
            "seq": pa.array([_pack(np.concatenate(block.seqs))], pa.binary()),
            "sizes": pa.array([_pack(np.array([len(s) for s in block.seqs]))], pa.binary()),
            "doc_ids": pa.array([ids], pa.list_(pa.int64()))})

    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            some = batch.slice(at, 512)
            for d, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                block.add(text)
                ids.append(d)
                if block.tokens >= BLOCK_TOKENS:
                    yield out()
                    block, ids, number = Block(), [], number + 1
    if ids:
        yield out()


def _pairs(words: bytes, seq: bytes, sizes: bytes) -> tuple[Pairs, np.ndarray]:
    n = _unpack(sizes).astype(np.int64)
    return Pairs(np.frombuffer(words, np.uint64), _unpack(seq).astype(np.int64), n), n


def _rows(parts: int, counted: bool):
    """What each block sends to each part: its keys, and its sums or 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, target, *rest in zip(*[batch.column(c) for c in ("block", "target", "words", "seq", "sizes")]):
                pairs, sizes = _pairs(*[x.as_py() for x in rest])
                weight = np.zeros(len(sizes))
                weight[np.array(target.as_py() or [], np.int64)] = 1
                n = pairs.counts() * counted, pairs.counts(np.repeat(weight, sizes - 1)) * counted
                cuts = _cuts(pairs.keys, parts)
                cut = lambda v, pack: pa.array([pack(v[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.arange(parts), pa.int32()), "block": pa.array([block.as_py()] * parts, pa.int64()),
                    "keys": cut(pairs.keys, _pack_keys), "background": cut(n[0], _pack), "target": cut(n[1], _pack)})
    return run


def _summed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(different keys, place of each row's keys among them, where each row ends, sums of each key)."""
    sent = [_unpack_keys(k) for k in rows.column("keys").to_pylist()]
    keys, at = np.unique(np.concatenate(sent), return_inverse=True)
    sums = {c: np.bincount(at, np.concatenate([_unpack(n) for n in rows.column(c).to_pylist()]), len(keys)).astype(np.int64)
            for c in ("background", "target")}
    return keys, at, np.cumsum([len(k) for k in sent]), sums


def _is_word(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(1)).astype(bool)


def _totals(keys: np.ndarray, sums: dict[str, np.ndarray], rows: int) -> dict[str, pa.Array]:
    """Different words and tokens of a part, in the first of its rows."""
    word = _is_word(keys)
    totals = {"words": word.sum()} | {c + "_tokens": n[word].sum() for c, n in sums.items()}
    return {c: pa.array([0 if i else int(n) for i in range(rows)], pa.int64()) for c, n in totals.items()}


def _merge(rows: pa.Table) -> pa.Table:
    """All sums of a part as one row."""
    keys, _, _, sums = _summed(rows)
    return pa.table({"part": rows.column("part").combine_chunks()[:1], "block": pa.array([None], pa.int64()),
                     "keys": pa.array([_pack_keys(keys)], pa.binary()),
                     **{c: pa.array([_pack(n)], pa.binary()) for c, n in sums.items()}, **_totals(keys, sums, 1)})


def _answer(rows: pa.Table) -> pa.Table:
    """The sums of the keys each block sent, in its order."""
    keys, at, ends, sums = _summed(rows)
    own = [(block, part, at[e - n:e]) for block, part, e, n in zip(
        rows.column("block").to_pylist(), rows.column("part").to_pylist(), ends, np.diff(ends, prepend=0)) if block is not None]
    return pa.table({"block": pa.array([x[0] for x in own], pa.int64()), "part": pa.array([x[1] for x in own], pa.int32()),
                     **{c: pa.array([_pack(n[x[2]]) for x in own], pa.binary()) for c, n in sums.items()},
                     **_totals(keys, sums, len(own))})


@dataclass(frozen=True)
class Counts:
    """The table of words and pairs: a row for each part, with ascending keys."""
    table: DataFrame
    parts: int


@dataclass(frozen=True)
class Model:
    """What one model needs besides the counts."""
    counts: Counts | None
    name: str
    tokens: int
    symbols: int

    def losses(self, pair, word, before):
        """Minus log probability of words after others, from the counts of the pairs, the words and those before."""
        unigram = (word + 1) / (self.tokens + self.symbols)
        return -np.log((pair + PRIOR * unigram) / (before + PRIOR))

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        """The losses of all words by themselves: gathers them, for small corpora."""
        rows = self.counts.table.select("keys", self.name).collect()
        words = [_unpack(n)[_is_word(_unpack_keys(k))].astype(np.int64) for k, n in rows]
        return self.losses(0, np.concatenate(words or [np.zeros(0)]), 0).astype(dtype or np.float64)


def _sent(docs: DataFrame, target_ids: DataFrame | None, parts: int) -> tuple[DataFrame, DataFrame]:
    """(blocks of the documents, what they send): without target ids, keys alone."""
    blocks = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encoded, _BLOCKS), "blocks")
    of_block = blocks.drop("doc_ids")
    if target_ids is None:
        return blocks, of_block.withColumn("target", F.array().cast("array<int>")).mapInArrow(_rows(parts, False), _ROWS)
    # only ids are joined, not texts
    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    places = blocks.select("block", F.posexplode("doc_ids").alias("at", "doc_id")).join(ids, "doc_id", "left_semi")
    target = stored(places.groupBy("block").agg(F.collect_list("at").alias("target")), "target")
    return blocks, of_block.join(target, "block", "left").mapInArrow(_rows(parts, True), _ROWS)


def _parts(docs: DataFrame) -> int:
    return 8 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES


def _models(counts: Counts | None, words: int, target_tokens: int, background_tokens: int) -> tuple[Model, Model]:
    return (Model(counts, "target", target_tokens, max(SYMBOLS, words)), Model(counts, "background", background_tokens, max(SYMBOLS, words)))


def _total(df: DataFrame) -> list[int]:
    return [n or 0 for n in df.agg(*[F.sum(c) for c in ("words", "target_tokens", "background_tokens")]).first()]


def models(docs: DataFrame, target_ids: DataFrame) -> tuple[Counts, Model, Model]:
    """(counts, target model, background model); ``docs`` has doc_id and
    text, ``target_ids`` the doc_id of the target documents."""
    parts = _parts(docs)
    _, rows = _sent(docs, target_ids, parts)
    counts = Counts(stored(rows.groupBy("part").applyInArrow(_merge, _TABLE), "counts"), parts)
    return counts, *_models(counts, *_total(counts.table))


def score(docs: DataFrame, counts: Counts, target: Model, background: Model) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (means per token, the
    end among them) and score, their difference."""
    blocks, rows = _sent(docs, None, counts.parts)
    rows = rows.union(counts.table.select("part", "block", "keys", "background", "target"))
    return _scores(blocks, rows.groupBy("part").applyInArrow(_answer, _ANSWERS), target, background)


def scored(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """``docs`` scored by the models of themselves."""
    blocks, rows = _sent(docs, target_ids, _parts(docs))
    answers = stored(rows.groupBy("part").applyInArrow(_answer, _ANSWERS), "answers")
    return _scores(blocks, answers, *_models(None, *_total(answers)))


def _scores(blocks: DataFrame, answers: DataFrame, target: Model, background: Model) -> DataFrame:
    # the models go to the tasks without their tables
    of = _models(None, target.symbols, target.tokens, background.tokens)

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        pairs, sizes = _pairs(*[block.column(c)[0].as_py() for c in ("words", "seq", "sizes")])
        answers = answers.sort_by("part")
        begins = np.cumsum(sizes - 1) - (sizes - 1)
        means = {}
        for model in of:
            n = np.empty(len(pairs.keys), np.int64)
            n[pairs.order] = np.concatenate([_unpack(x) for x in answers.column(model.name).to_pylist()])
            word = n[:pairs.n_words]
            loss = model.losses(n[pairs.n_words:], word[pairs.after], word[pairs.before])
            means[model.name] = np.add.reduceat(loss[pairs.pair], begins) / (sizes - 1)
        return pa.table({"doc_id": block.column("doc_ids").combine_chunks().flatten(), "n_tokens": pa.array(sizes - 1),
                         "target_loss": pa.array(means["target"]), "background_loss": pa.array(means["background"]),
                         "score": pa.array(means["target"] - means["background"])})

    return blocks.select("block", "words", "seq", "sizes", "doc_ids").groupBy("block").cogroup(
        answers.select("block", "part", "background", "target").groupBy("block")).applyInArrow(run, _SCORES)
