"""Token-ID files: patched frame-of-reference blocks (PFOR).

``write_tokens`` encodes texts with a public byte-level BPE file of the
``tokenizers`` library, appends an end id to each document and writes the ids
in ascending ``doc_id`` order; ``read_tokens`` / ``token_digest`` read the
files back.  A written folder is a Parquet table of *segments*: consecutive
documents of one range partition, about ``SEGMENT_IDS`` ids each (a document
is never cut), columns ``part`` (range partition), ``seg``, ``start_in_part``,
``n_ids`` and ``payload``.  Spark's committer thus makes the files whole even
when tasks are retried, and any store Spark reads will do.

Payload, little endian::

    magic 'PFR1' | u32 n_ids | u32 n_docs | u32 n_blocks
    document table   n_docs x (i64 doc_id), n_docs x (u8 id is null), n_docs x (u32 n_tokens)
    block index      (n_blocks + 1) x u64 start of each block in the block area
    block            u32 minimum | u8 width | u16 exceptions
                     | packed low bits, 64-bit words | exceptions x u16 position | exceptions x u32 high bits

Each block of ``BLOCK`` ids stores value - minimum in ``width`` bits, where
``width`` is the bit length that ``PERCENTILE`` of its values fit; the high
bits of the others are patched in from the exception list.

Defined cases: a null or empty text is the end id alone; a null ``doc_id``
sorts first; equal ``doc_id``s follow one another in the order of their texts;
an empty table writes no segment and reads back as no row; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import gc
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwise.llm.common import scratch

BLOCK = 128
SEGMENT_IDS = 1 << 18
PERCENTILE = 90
MEMO_BYTES = 512 << 20  # of chunks remembered in one Python worker: less memory means more encoding
BATCH = 1 << 20  # characters of texts taken on at once
_ENTRY = 480  # bytes of a remembered chunk besides its own and its ids', as measured
_HEAD = struct.Struct("<4sIII")

SEGMENTS = "part int, seg int, start_in_part long, n_ids long, n_docs int, payload binary"
DOCS = "doc_id long, start long, n_tokens long, ids array<int>"
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


# ---------------------------------------------------------------- blocks

_BITS_16 = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)  # bit length of 0 .. 65,535


def _bit_length(v: np.ndarray) -> np.ndarray:
    """Bits that each unsigned 32-bit value needs (0 for 0)."""
    high = v >> np.uint32(16)
    out = _BITS_16[v & np.uint32(0xFFFF)]
    return np.where(high > 0, _BITS_16[high] + np.uint8(16), out) if high.any() else out


def pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(block starts, block area) of an array of ids."""
    n = len(ids)
    nb = -(-n // BLOCK)
    if not nb:
        return np.zeros(1, "<u8"), b""
    v = np.zeros(nb * BLOCK, np.uint32)
    v[:n] = ids
    if n < len(v):
        v[n:] = v[n - 1]
    v = v.reshape(nb, BLOCK)
    low = v.min(axis=1)
    v = v - low[:, None]
    bits = _bit_length(v)
    at = min(BLOCK - 1, -(-BLOCK * PERCENTILE // 100) - 1)
    width = np.partition(bits, at, axis=1)[:, at].astype(np.int64)
    patched = bits > width[:, None].astype(np.uint8)
    at_row, at_col = np.nonzero(patched)
    n_patched = patched.sum(axis=1)
    nth = np.arange(len(at_row)) - np.repeat(np.cumsum(n_patched) - n_patched, n_patched)
    high = (v[at_row, at_col].astype(np.uint64) >> width[at_row].astype(np.uint64)).astype("<u4")
    words = _word_bytes(width)
    starts = np.zeros(nb + 1, "<u8")
    np.cumsum(_HEADER + words + 6 * n_patched, out=starts[1:])
    begin = starts[:nb].astype(np.int64)
    area = np.zeros(int(starts[-1]), np.uint8)
    _put(area, begin, low.astype("<u4"))
    area[begin + 4] = width
    _put(area, begin + 5, n_patched.astype("<u2"))
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        _put(area, begin[rows] + _HEADER, _pack(v[rows], int(w)))
    after = begin + _HEADER + words
    _put(area, after[at_row] + 2 * nth, at_col.astype("<u2"))
    _put(area, (after + 2 * n_patched)[at_row] + 4 * nth, high)
    return starts, area.tobytes()


_HEADER = 7  # bytes of minimum, width and number of exceptions


def _word_bytes(width: np.ndarray) -> np.ndarray:
    """Bytes of a block's packed words."""
    return -(-BLOCK * width // 64) * 8


def _put(area: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Write row i of ``values`` at byte ``at[i]``."""
    if len(at) and values.size:
        raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(at), -1)
        area[at[:, None] + np.arange(raw.shape[1])] = raw


def _take(area: np.ndarray, at: np.ndarray, size: int, kind: str) -> np.ndarray:
    """``size`` bytes from each place ``at``, as rows of ``kind``."""
    return np.ascontiguousarray(area[at[:, None] + np.arange(size)]).view(kind)


def _pack(v: np.ndarray, w: int) -> np.ndarray:
    """The low ``w`` bits of each value, row by row, into 64-bit words."""
    words = np.zeros((-(-BLOCK * w // 64), len(v)), "<u8")
    if w:
        cols = np.ascontiguousarray(v.T).astype(np.uint64) & np.uint64((1 << w) - 1)
        for j in range(BLOCK):
            k, off = divmod(j * w, 64)
            words[k] |= cols[j] << np.uint64(off)
            if off + w > 64:
                words[k + 1] |= cols[j] >> np.uint64(64 - off)
    return np.ascontiguousarray(words.T)


def unpack_blocks(starts: np.ndarray, area: bytes, n: int) -> np.ndarray:
    """The ids that ``pack_blocks`` wrote."""
    nb = len(starts) - 1
    out = np.zeros((nb, BLOCK), np.uint32)
    if not nb:
        return out.reshape(-1)
    data, begin = np.frombuffer(area, np.uint8), starts[:nb].astype(np.int64)
    low, width = _take(data, begin, 4, "<u4")[:, 0], data[begin + 4].astype(np.int64)
    n_patched, words = _take(data, begin + 5, 2, "<u2")[:, 0].astype(np.int64), _word_bytes(width)
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            out[rows] = _unpack(_take(data, begin[rows] + _HEADER, int(words[rows[0]]), "<u8"), int(w))
    at_row = np.repeat(np.arange(nb), n_patched)
    if len(at_row):
        nth = np.arange(len(at_row)) - np.repeat(np.cumsum(n_patched) - n_patched, n_patched)
        after = (begin + _HEADER + words)[at_row]
        cols = _take(data, after + 2 * nth, 2, "<u2")[:, 0]
        high = _take(data, after + 2 * n_patched[at_row] + 4 * nth, 4, "<u4")[:, 0]
        out[at_row, cols] |= (high.astype(np.uint64) << width[at_row].astype(np.uint64)).astype(np.uint32)
    out += low[:, None]
    return out.reshape(-1)[:n]


def _unpack(words: np.ndarray, w: int) -> np.ndarray:
    cols = np.ascontiguousarray(words.T)
    out = np.zeros((BLOCK, len(words)), np.uint32)
    mask = np.uint64((1 << w) - 1)
    for j in range(BLOCK):
        k, off = divmod(j * w, 64)
        v = cols[k] >> np.uint64(off)
        if off + w > 64:
            v = v | cols[k + 1] << np.uint64(64 - off)
        out[j] = v & mask
    return out.T


def pack_segment(doc_ids: list, ids: list[np.ndarray]) -> bytes:
    """One payload of whole documents."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    starts, area = pack_blocks(flat)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join((_HEAD.pack(b"PFR1", len(flat), len(ids), len(starts) - 1), known.tobytes(), null.tobytes(),
                     np.array([len(x) for x in ids], "<u4").tobytes(), starts.tobytes(), area))


def unpack_segment(payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc ids, tokens of each, all ids)."""
    magic, n_ids, n_docs, nb = _HEAD.unpack_from(payload)
    if magic != b"PFR1":
        raise ValueError("not a token segment")
    at = _HEAD.size
    known = np.frombuffer(payload, "<i8", n_docs, at)
    null = np.frombuffer(payload, np.uint8, n_docs, at := at + 8 * n_docs)
    counts = np.frombuffer(payload, "<u4", n_docs, at := at + n_docs).astype(np.int64)
    starts = np.frombuffer(payload, "<u8", nb + 1, at := at + 4 * n_docs)
    ids = unpack_blocks(starts, payload[at + 8 * (nb + 1):], n_ids)
    return [None if x else int(d) for d, x in zip(known, null)], counts, ids


# ---------------------------------------------------------------- encoding

#: White space other than the single blank and line end; looking for each by itself is several times faster than one pattern.
_OTHER_ASCII = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_OTHER_SPACE = _OTHER_ASCII + "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
#: Latin letters, and a sign or none: after a blank, the letters are one piece and the sign is another.
_PLAIN = re.compile(r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+[,.;:!?]?")
_SIGNS = ",.;:!?"


def _uneven(t: str) -> bool:
    """Whether a cut at blanks and line ends may not fall between two pieces of the tokenizer's own
    splitting: white space next to white space or at an end of the text, or any of another kind."""
    return (t[0] in " \n" or t[-1] in " \n" or "  " in t or " \n" in t or "\n " in t or "\n\n" in t
            or any(c in t for c in (_OTHER_ASCII if t.isascii() else _OTHER_SPACE)))


def _byte_letters() -> str:
    """The letter for each byte in the pieces of a byte-level tokenizer: itself if visible, else the next from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in seen else next(hidden)) for b in range(256))


class _Memo(dict):
    """Numbers the keys in the order of their first look-up; ``new`` lists those not yet encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class Encoder:
    """Encodes texts, remembering chunks.

    The tokenizer first splits a text into pieces that never reach over a
    single blank or line end between two other characters, and then merges
    inside each piece.  So a text is cut there, each different chunk is
    encoded once by the library and the ids are strung together.  Texts with
    other white space, or with an added token such as <|endoftext|>, are
    encoded whole.

    Chunks are remembered until they take ``memo_bytes``, then forgotten and
    encoded again: the size changes memory and time, not ids.
    """

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers
        self.memo_bytes = memo_bytes
        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.line_end = self._ids(["\n"])[0][0]
        # chunks that are known to be one piece skip the splitting, which takes half of the library's time
        self.letters = dict(enumerate(_byte_letters()))
        self.pieces = Tokenizer(self.tok.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Split(self.letters[ord("\n")], "isolated")
        self.sign_ids = {c: self._ids([c])[0][0] for c in _SIGNS}
        self._forget()

    def _forget(self) -> None:
        self.memo = _Memo()
        gc.freeze()  # the collector would walk through all chunks time and again; they form no cycles
        self.held = 0  # bytes, about
        self.flat = np.zeros(1 << 20, np.uint32)  # the ids of all chunks
        self.used = 0
        self.first, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)  # of each chunk therein

    def _ids(self, texts: list[str], plain: bool = True) -> list[list[int]]:
        # most texts hold no added token: there is none to look for.  Switching costs a millisecond
        if self.tok.encode_special_tokens != plain:
            self.tok.encode_special_tokens = plain
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        """Encode the new chunks.

        A chunk holds no line end but one at its front, and a line end between two chunks is a piece and
        an id of its own: one text holds them all and its ids are cut there.  A key with a line end at
        the front is its chunk; any other stands for ' ' + key.
        """
        new, self.memo.new = self.memo.new, []
        self.held += _ENTRY * len(new) + 4 * sum(map(len, new))
        if len(self.memo) > len(self.first):
            grown = np.zeros(2 * len(self.memo), np.int64)
            self.first, self.size = (np.concatenate([x, grown]) for x in (self.first, self.size))
        plain = [k for k in new if _PLAIN.fullmatch(k)]
        known = set(plain)
        other = [k for k in new if k not in known]
        for front in ("\n", ""):
            keys = [k for k in other if (k[:1] == "\n") == bool(front)]
            if keys:
                self._hold(keys, self._ids(["".join(keys) if front else "\n " + "\n ".join(keys)])[0], bool(front))
        if plain:
            text = "\n " + "\n ".join([k[:-1] if k[-1] in _SIGNS else k for k in plain])
            text = text.encode().decode("latin-1").translate(self.letters)
            self._hold(plain, self.pieces.encode_batch_fast([text], add_special_tokens=False)[0].ids, False,
                       np.array([self.sign_ids.get(k[-1], 0) for k in plain], np.uint32),
                       np.array([k[-1] in _SIGNS for k in plain]))

    def _hold(self, keys: list[str], ids: list[int], with_line_end: bool, signs: np.ndarray | None = None,
              signed: np.ndarray | None = None) -> None:
        """Remember ``ids``, those of the keys, each after a line end; ``signs`` follow the ``signed`` ones."""
        ids = np.array(ids, np.uint32)
        cuts = np.flatnonzero(ids == self.line_end)
        if len(cuts) != len(keys):
            raise ValueError("the tokenizer does not keep line ends apart")
        ends = np.append(cuts[1:], len(ids))
        size = ends - cuts - (not with_line_end)
        if signed is not None:
            ids = np.insert(ids, ends[signed], signs[signed])
            size = size + signed
        if not with_line_end:
            ids = ids[ids != self.line_end]
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used:self.used + len(ids)] = ids
        at = np.fromiter(map(self.memo.__getitem__, keys), np.int64, len(keys))
        self.first[at], self.size[at] = self.used + np.cumsum(size) - size, size
        self.used += len(ids)

    def encode(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """The ids of each text with ``end_id`` appended."""
        if self.held > self.memo_bytes:
            self._forget()
        out: list = [None] * len(texts)
        added = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        uneven = [i for i, t in enumerate(texts) if not t or _uneven(t)]
        for whole, plain in ((uneven, True), (added, False)):
            if whole:
                for i, ids in zip(whole, self._ids([texts[i] for i in whole], plain)):
                    out[i] = np.array([*ids, end_id], np.uint32)
        even = [i for i in range(len(texts)) if out[i] is None]
        look = self.memo.__getitem__
        at = []
        for i in even:
            # every chunk begins at a blank, or with its line end; one is put in front of the text
            chunks = ("\n" + texts[i]).replace("\n", " \n").split(" ")[1:]
            at.append(np.fromiter(map(look, chunks), np.int64, len(chunks)))
        self._learn()
        for i, a in zip(even, at):
            first, size = self.first[a], self.size[a]
            ends = np.cumsum(size)
            ids = np.empty(ends[-1], np.uint32)
            ids[:-1] = self.flat[(np.repeat(first - ends + size, size) + np.arange(ends[-1]))[1:]]
            ids[-1] = end_id  # the id of the line end put in front is left out
            out[i] = ids
        return out


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, memo_bytes: int = MEMO_BYTES) -> Encoder:
    """One encoder for each Python worker, file and size."""
    key = path, memo_bytes
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, memo_bytes)
    return _ENCODERS[key]


def _segments(path: str, end_id: int, memo_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = encoder(path, memo_bytes)
        docs: list = []
        ids: list[np.ndarray] = []
        held, done, seg = 0, 0, 0

        def cut():
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seg": pa.array([seg], pa.int32()),
                "start_in_part": pa.array([done], pa.int64()), "n_ids": pa.array([held], pa.int64()),
                "n_docs": pa.array([len(docs)], pa.int32()),
                "payload": pa.array([pack_segment(docs, ids)], pa.binary())})

        def texts_of(batch):
            """The batch's rows, some ``BATCH`` characters at a time."""
            some, size = [], 0
            for d, t in zip(batch.column(0), batch.column(1)):
                some.append((d.as_py(), t.as_py() or ""))
                size += len(some[-1][1])
                if size >= BATCH:
                    yield some
                    some, size = [], 0
            if some:
                yield some

        for batch in batches:
            for some in texts_of(batch):
                for (d, _), x in zip(some, enc.encode([t for _, t in some], end_id)):
                    docs.append(d)
                    ids.append(x)
                    held += len(x)
                    if held >= SEGMENT_IDS:
                        yield cut()
                        docs, ids, done, held, seg = [], [], done + held, 0, seg + 1
        if docs:
            yield cut()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2,
                 partitions: int | None = None, memo_bytes: int = MEMO_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) and write the token files to ``path``."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the text's hash only deals equal ids over several partitions; the order inside is by (doc_id, text)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(n, "doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    ordered.mapInArrow(_segments(tokenizer_path, end_id, memo_bytes), SEGMENTS).write.parquet(path)


def with_start(spark: SparkSession, path: str) -> DataFrame:
    """The segments with the number of ids before each (``start``).

    One sum for each range partition, running over the partitions in order;
    that table has as many rows as the writer had partitions, so it is small
    enough to broadcast at any input size.
    """
    seg = spark.read.schema(SEGMENTS).parquet(path)
    from pyspark.sql import Window as W
    parts = seg.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    base = parts.select("part", (F.sum("_n").over(W.orderBy("part")) - F.col("_n")).alias("_base"))
    return seg.join(F.broadcast(base), "part").select(
        (F.col("_base") + F.col("start_in_part")).alias("start"), "payload")


def _documents(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs, counts, ids = unpack_segment(payload.as_py())
                ends = np.cumsum(counts)
                cols = {"doc_id": pa.array(docs, pa.int64()), "start": pa.array(start + ends - counts, pa.int64()),
                        "n_tokens": pa.array(counts, pa.int64())}
                ids = ids.astype("<u4")
                if digest:
                    cols["ids_crc32"] = pa.array([zlib.crc32(ids[e - c:e].tobytes()) for e, c in zip(ends, counts)],
                                                 pa.int64())
                else:
                    cols["ids"] = pa.array([ids[e - c:e].astype(np.int32) for e, c in zip(ends, counts)],
                                           pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(cols)
    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a written folder: doc_id, start, n_tokens, ids."""
    return with_start(spark, path).mapInArrow(_documents(False), DOCS)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_tokens``, with the crc32 of each document's ids (little-endian
    unsigned 32-bit) in place of the ids."""
    return with_start(spark, path).mapInArrow(_documents(True), DIGEST)


def encode_and_read_back(docs: DataFrame, tokenizer_path: str, end_id: int = 2, memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """Write ``docs`` below the shared folder and return the digest read from there."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id, memo_bytes=memo_bytes)
    return token_digest(docs.sparkSession, path)
