"""Deterministic automata over bytes, built from regexes.

A pattern is a regex over bytes with literals, ``.``-free classes ``[a-z]``
and ``[^a-z]``, groups ``( )``, ``(?: )`` and ``(?i: )`` (ASCII letters in
either case), ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}`` and the
escapes ``\\xHH``, ``\\n``, ``\\t``, ``\\d``, ``\\w`` and backslash before any
sign.  ``parse`` gives its tree, ``compile_dfa`` turns trees into one
``Dfa``: subset construction over a position automaton, Moore minimisation,
transition arrays over classes of bytes that no pattern tells apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_DIGIT = frozenset(b"0123456789")
_WORD = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")
_NAMED = {"n": frozenset(b"\n"), "t": frozenset(b"\t"), "r": frozenset(b"\r"), "d": _DIGIT, "w": _WORD}
_ANY = frozenset(range(256))


class _Parser:
    """Recursive descent; a node is ('set', bytes), ('cat', nodes), ('or', nodes) or ('times', node, least, most)."""

    def __init__(self, pattern: str):
        self.p, self.at = pattern, 0

    def fail(self):
        raise ValueError(f"cannot read {self.p!r} at {self.at}")

    def peek(self, s: str) -> bool:
        return self.p.startswith(s, self.at)

    def take(self, s: str) -> bool:
        if self.peek(s):
            self.at += len(s)
            return True
        return False

    def union(self, fold: bool):
        options = [self.sequence(fold)]
        while self.take("|"):
            options.append(self.sequence(fold))
        return options[0] if len(options) == 1 else ("or", options)

    def sequence(self, fold: bool):
        parts = []
        while self.at < len(self.p) and self.p[self.at] not in "|)":
            parts.append(self.repeated(fold))
        return ("cat", parts)

    def repeated(self, fold: bool):
        node = self.atom(fold)
        while self.at < len(self.p) and self.p[self.at] in "?*+{":
            sign = self.p[self.at]
            self.at += 1
            if sign == "{":
                end = self.p.find("}", self.at)
                if end < 0:
                    self.fail()
                low, comma, high = self.p[self.at:end].partition(",")
                self.at = end + 1
                node = ("times", node, int(low), int(high) if high else None if comma else int(low))
            else:
                node = ("times", node, int(sign == "+"), 1 if sign == "?" else None)
        return node

    def atom(self, fold: bool):
        if self.take("("):
            if self.take("?i:"):
                fold = True
            else:
                self.take("?:")
            node = self.union(fold)
            if not self.take(")"):
                self.fail()
            return node
        if self.take("["):
            return self.klass(fold)
        if self.p[self.at] in "?*+{.^$":
            self.fail()
        return self.leaf(self.sign(), fold)

    def sign(self) -> frozenset:
        """One sign or escape as a set of bytes (a sign beyond ASCII is no byte and is refused)."""
        if self.take("\\"):
            if self.take("x"):
                self.at += 2
                return frozenset([int(self.p[self.at - 2:self.at], 16)])
            c = self.p[self.at:self.at + 1]
            self.at += 1
            if c in _NAMED:
                return _NAMED[c]
            if not c or c.isalnum():
                self.fail()
        else:
            c = self.p[self.at]
            self.at += 1
        if ord(c) > 127:
            self.fail()
        return frozenset([ord(c)])

    def klass(self, fold: bool):
        other, found = self.take("^"), set()
        first = True
        while first or not self.peek("]"):
            if self.at >= len(self.p):
                self.fail()
            first = False
            low = self.sign()
            if self.peek("-") and not self.peek("-]"):
                self.at += 1
                found.update(range(min(low), max(self.sign()) + 1))
            else:
                found |= low
        self.at += 1
        node = self.leaf(frozenset(found), fold)
        return ("set", _ANY - node[1]) if other else node

    @staticmethod
    def leaf(chars: frozenset, fold: bool):
        if fold:
            text = bytes(chars)
            chars = chars | frozenset(text.lower()) | frozenset(text.upper())
        return ("set", chars)


def parse(pattern: str):
    reader = _Parser(pattern)
    node = reader.union(False)
    if reader.at < len(pattern):
        reader.fail()
    return node


class _Positions:
    """Position automaton of several trees: every byte set is a position with
    the positions that may follow it; a position's tag holds the trees that
    may end there."""

    def __init__(self, backward: bool):
        self.backward = backward
        self.sets: list[frozenset] = []
        self.follow: list[set[int]] = []
        self.tags: list[int] = []

    def add(self, node) -> tuple[set[int], set[int], bool]:
        """(first positions, last positions, whether the empty string matches)."""
        kind = node[0]
        if kind == "set":
            self.sets.append(node[1])
            self.follow.append(set())
            self.tags.append(0)
            at = {len(self.sets) - 1}
            return at, set(at), False
        if kind == "or":
            parts = [self.add(x) for x in node[1]]
            return set().union(*(p[0] for p in parts)), set().union(*(p[1] for p in parts)), any(p[2] for p in parts)
        if kind == "cat":
            return self._chain([lambda x=x: self.add(x) for x in (node[1][::-1] if self.backward else node[1])])
        _, inner, least, most = node
        if most is None:  # the last copy may repeat
            return self._chain([lambda: self.add(inner)] * max(least - 1, 0) + [lambda: self._loop(inner, least == 0)])
        optional = [lambda: (*self.add(inner)[:2], True)] * (most - least)
        return self._chain([lambda: self.add(inner)] * least + optional)

    def _loop(self, inner, may_miss: bool):
        first, last, empty = self.add(inner)
        for x in last:
            self.follow[x] |= first
        return first, last, empty or may_miss

    def _chain(self, parts):
        first, last, empty = set(), set(), True
        for part in parts:
            f, l, e = part()
            for x in last:
                self.follow[x] |= f
            first = first | f if empty else first
            last = last | l if e else l
            empty = empty and e
        return first, last, empty


@dataclass
class Dfa:
    """``table[state, klass[byte]]`` is the next state, ``tags[state]`` the bit
    mask of the patterns that may end there.  State 0 is the start; states
    with a tag come last, from ``tagged`` on."""

    table: np.ndarray
    klass: np.ndarray
    tags: np.ndarray
    tagged: int
    dead: int  # the state no byte leaves and no pattern ends in, or -1

    def rows(self) -> list[list[int]]:
        """The next state of every state and byte, for scalar use."""
        return self.table[:, self.klass].tolist()


def compile_dfa(trees: list, backward: bool = False, anywhere: bool = False) -> Dfa:
    """One minimal automaton of all ``trees``; pattern i ends where bit i of the tag is set.

    ``backward`` reads the bytes from right to left; with ``anywhere`` a match
    may begin at any byte, otherwise at the first.
    """
    positions = _Positions(backward)
    first: set[int] = set()
    for i, tree in enumerate(trees):
        f, last, empty = positions.add(tree)
        if empty:
            raise ValueError("a pattern must not match the empty string")
        first |= f
        for x in last:
            positions.tags[x] |= 1 << i
    member = np.array([[b in s for b in range(256)] for s in positions.sets])
    _, sample, klass = np.unique(member, axis=1, return_index=True, return_inverse=True)
    klass = klass.reshape(-1)
    allowed = [np.flatnonzero(member[:, b]).tolist() for b in sample]
    allowed = [frozenset(a) for a in allowed]
    # subset construction: a state is the set of positions just read; -1 stands for "nothing read yet"
    start = frozenset() if anywhere else frozenset([-1])
    number, states, table = {start: 0}, [start], []
    for state in states:
        may = set(first) if anywhere or -1 in state else set()
        for x in state - {-1}:
            may |= positions.follow[x]
        row = []
        for allow in allowed:
            nxt = frozenset(may & allow)
            if nxt not in number:
                number[nxt] = len(states)
                states.append(nxt)
            row.append(number[nxt])
        table.append(row)
    tags = np.zeros(len(states), np.int64)
    for i, state in enumerate(states):
        for x in state - {-1}:
            tags[i] |= positions.tags[x]
    return _minimal(np.array(table, np.int64), klass.astype(np.uint8), tags)


def _minimal(table: np.ndarray, klass: np.ndarray, tags: np.ndarray) -> Dfa:
    """Moore's refinement: states stay together while their tags and the
    blocks of their successors agree."""
    block = np.unique(tags, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    sample = np.unique(block, return_index=True)[1]
    # the start first, then states without and with tags
    order = np.lexsort((sample, tags[sample] > 0, block[sample] != block[0]))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    table, tags = place[block[table[sample[order]]]], tags[sample[order]]
    stays = np.flatnonzero((table == np.arange(len(table))[:, None]).all(axis=1) & (tags == 0))
    return Dfa(table.astype(np.int32), klass, tags, int((tags == 0).sum()), int(stays[0]) if len(stays) else -1)
