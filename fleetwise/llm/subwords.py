"""Words and their hashed character n-grams, vectorised in numpy."""

from __future__ import annotations

import re
import zlib

import numpy as np

_WORDS = re.compile(r"[^\W_]+(?:[^\w\s]+[^\W_]+)*")


def words(text: str | None) -> list[str]:
    """Lower-case words; signs inside a word stay, those around it go."""
    return _WORDS.findall(text.lower()) if text else []


class Numbered(dict):
    """Numbers keys in the order of their first look-up; ``new`` lists the
    keys that came since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


def gram_rows(some: list[str], grams: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash row below 2 ** bits, number of the word) for every n-gram of the
    marked words <word>, and for each whole word."""
    code = np.frombuffer("".join(f"<{w}>" for w in some).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, some), np.int64, len(some)) + 2
    of = np.repeat(np.arange(len(some)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(code))  # characters to the end of the word
    step = np.uint64(0x9E3779B97F4A7C15)
    hashed, rows, at = np.zeros(len(code), np.uint64), [], []
    mixed = (code + np.uint64(1)) * step
    for n in range(1, max(grams) + 1):
        # hash of the n characters from each place
        shifted = np.zeros_like(mixed)
        shifted[:max(0, len(mixed) - n + 1)] = mixed[n - 1:]
        hashed = (hashed ^ shifted) * step
        hashed ^= hashed >> np.uint64(29)
        if n in grams:
            ok = left >= n
            rows.append((hashed[ok] * step >> np.uint64(64 - bits)).astype(np.int64))
            at.append(of[ok])
    whole = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % (1 << bits) for w in some], np.int64)
    return np.concatenate([*rows, whole]), np.concatenate([*at, np.arange(len(some))])


def word_means(some: list[str], table: np.ndarray, grams: tuple[int, ...], bits: int) -> np.ndarray:
    """Mean over each word's rows of ``table`` (rows x k): words x k."""
    row, at = gram_rows(some, grams, bits)
    n = np.maximum(1, np.bincount(at, minlength=len(some)))
    return np.stack([np.bincount(at, table[row, j], len(some)) / n for j in range(table.shape[1])], axis=1)


class BagScorer:
    """Mean over a text's words of their linear scores.  Each different word
    is worked out once; above ``memo`` remembered words it starts anew."""

    def __init__(self, table: np.ndarray, grams: tuple[int, ...], bits: int, memo: int = 500_000):
        self.table, self.grams, self.bits, self.memo = table, grams, bits, memo
        self.forget()

    def forget(self) -> None:
        self.seen, self.known = Numbered(), np.zeros((0, self.table.shape[1]))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(means, texts x k; number of words of each)."""
        if len(self.seen) > self.memo:
            self.forget()
        look = self.seen.__getitem__
        bags = []
        for t in texts:
            bag = words(t)
            bags.append(np.fromiter(map(look, bag), np.int64, len(bag)))
        if self.seen.new:
            self.known = np.concatenate([self.known, word_means(self.seen.new, self.table, self.grams, self.bits)])
            self.seen.new = []
        none = np.zeros(self.table.shape[1])
        return (np.array([self.known[b].mean(axis=0) if len(b) else none for b in bags]).reshape(len(texts), -1),
                np.array([len(b) for b in bags], np.int64))
