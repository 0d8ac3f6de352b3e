"""Secret scans by one combined deterministic automaton.

All rules' regexes are compiled together (``automaton.compile_dfa``: subset
construction, minimisation, transition arrays).  The combined automaton reads
every text once, from its last byte to its first, and says for every byte
which rules have a match that starts there.  Only at those starts, from left
to right and beyond the last match, the rule's own automaton runs forward to
the longest end; so the matches of a rule are the leftmost, longest and do not
overlap, and nothing is read twice but what is found.

The pass goes over many stretches of text side by side: a text may be cut at
every byte that leads all states to the start (line ends, most punctuation,
all bytes beyond ASCII), and the stretches advance together, one array step a
byte.  When few long stretches are left they are read byte by byte.

A rule may ask that a match, without what its ``head`` matches at its front,
has ``least`` signs: matches that fail are dropped, and what they cover is not
searched again.  ``hex`` states its length in its pattern instead, which finds
the same (a run is matched whole), and spares a start at every short run.

The work is a map over the rows: no shuffle, nothing kept between batches.

Defined cases: a null or empty text has no match; starts and ends count code
points (bytes that continue a sign do not count, so broken UTF-8 is no error);
repeated rows are scanned each for itself; other columns pass through, and an
extra column named like the result makes the result's name begin with "_"; an
empty table gives no row; a rule that matches the empty string is refused.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwise.llm.automaton import compile_dfa, parse
from fleetwise.llm.common import free_name


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    head: str = ""
    least: int = 0


_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""

#: The base rules, then those this scan adds.
BASE = [
    Rule("assign", _HEAD + r"[A-Za-z0-9+/_.=-]+", head=_HEAD, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
]
RULES = BASE + [
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("url_login", r"[a-z][a-z0-9+]*://[A-Za-z0-9._%+-]+:[A-Za-z0-9._%+!$*-]+@"),
]

STRETCH_BYTES = 1 << 22  # bytes of text scanned side by side
NARROW = 96  # with fewer stretches left, byte by byte is faster than array steps

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


class _Longest:
    """A rule's own automaton, run forward from a start."""

    def __init__(self, pattern: str):
        self.dfa = compile_dfa([parse(pattern)])
        self.rows: list[list[int]] | None = None

    def end(self, data: bytes, at: int, stop: int) -> int:
        """End of the longest match in ``data[at:stop]`` that starts at ``at``; -1 without one."""
        if self.rows is None:
            self.rows = self.dfa.rows()
        rows, dead, tagged, state, found = self.rows, self.dfa.dead, self.dfa.tagged, 0, -1
        for i in range(at, stop):
            state = rows[state][data[i]]
            if state >= tagged:
                found = i + 1
            elif state == dead:
                break
        return found


class Scanner:
    """Compiled rules.  Made once on the driver; the arrays travel with the task."""

    def __init__(self, rules: list[Rule]):
        if len({r.kind for r in rules}) < len(rules) or len(rules) > 62:
            raise ValueError("kinds must differ, and there may be 62 of them")
        self.rules = list(rules)
        self.all = compile_dfa([parse(r.pattern) for r in rules], backward=True, anywhere=True)
        self.longest = [_Longest(r.pattern) for r in rules]
        self.heads = [_Longest(r.head) if r.head else None for r in rules]
        classes = self.all.table.shape[1]
        # states are numbered by the place of their row in the flat table
        self.step = (self.all.table * classes).astype(np.int32).reshape(-1)
        self.first_tagged = self.all.tagged * classes
        self.cuts = (self.all.table == 0).all(axis=0)[self.all.klass]

    def starts(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the stretches ``buf[begin:end]`` where a match starts, ascending, and the rules' bits there."""
        classes = self.all.table.shape[1]
        order = np.argsort(begin - end, kind="stable")
        at, left = end[order].copy(), (end - begin)[order]
        state = np.zeros(len(at), np.int32)
        found: list[np.ndarray] = []
        tags: list[np.ndarray] = []
        done = 0
        while True:
            k = int(np.searchsorted(-left, -done, side="left"))  # stretches longer than what is done
            if k < NARROW:
                break
            # all k stretches take as many steps as the shortest of them has left
            for _ in range(int(left[k - 1]) - done):
                at[:k] -= 1
                now = self.step[state[:k] + self.all.klass[buf[at[:k]]]]
                state[:k] = now
                hit = np.flatnonzero(now >= self.first_tagged)
                if len(hit):
                    found.append(at[hit])
                    tags.append(self.all.tags[now[hit] // classes])
            done = int(left[k - 1])
        if k:
            rows, tagged, tag = self.all.rows(), self.all.tagged, self.all.tags
            for lane in range(k):
                s, stop, low = int(state[lane]) // classes, int(at[lane]), int(at[lane]) - int(left[lane]) + done
                hits = []
                for i, byte in zip(range(stop - 1, low - 1, -1), buf[low:stop][::-1].tobytes()):
                    s = rows[s][byte]
                    if s >= tagged:
                        hits.append((i, s))
                if hits:
                    places, states = np.array(hits).T
                    found.append(places)
                    tags.append(tag[states])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places, bits = np.concatenate(found), np.concatenate(tags)
        order = np.argsort(places)
        return places[order], bits[order]

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule, end) in code points, sorted."""
        data = b"".join(texts)
        buf = np.frombuffer(data, np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(size)
        cut = np.flatnonzero(self.cuts[buf])
        begin = np.sort(np.concatenate([ends - size, cut + 1]))
        end = np.sort(np.concatenate([ends, cut]))
        kept = end > begin
        places, bits = self.starts(buf, begin[kept], end[kept])
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        of = np.searchsorted(ends, places, side="right")
        for t in np.unique(of):
            mine = of == t
            first, stop = int(ends[t] - size[t]), int(ends[t])
            found = self._matches(data, places[mine], bits[mine], stop)
            if found:
                signs = np.cumsum((buf[first:stop] & 0xC0) != 0x80)
                signs = np.concatenate([[0], signs])
                out[t] = sorted((int(signs[s - first]), r, int(signs[e - first])) for s, r, e in found)
        return out

    def _matches(self, data: bytes, places: np.ndarray, bits: np.ndarray, stop: int) -> list[tuple[int, int, int]]:
        found = []
        for r, rule in enumerate(self.rules):
            beyond = 0
            for s in places[bits >> r & 1 == 1].tolist():
                if s < beyond:
                    continue
                beyond = self.longest[r].end(data, s, stop)
                front = self.heads[r].end(data, s, beyond) if self.heads[r] else s
                if beyond - front >= rule.least:
                    found.append((s, r, beyond))
        return found


def _scan(scanner: Scanner):
    kinds = pa.array([r.kind for r in scanner.rules], pa.string())

    @F.arrow_udf(SPANS)
    def run(texts: pa.Array) -> pa.Array:
        counts, rows = [], []
        group: list[bytes] = []
        held = 0

        def flush():
            for spans in scanner.spans(group):
                counts.append(len(spans))
                rows.extend(spans)

        for text in texts:
            group.append(text.as_py() or b"")
            held += len(group[-1])
            if held >= STRETCH_BYTES:
                flush()
                group, held = [], 0
        flush()
        start, rule, end = zip(*rows) if rows else ((), (), ())
        structs = pa.StructArray.from_arrays(
            [kinds.take(pa.array(rule, pa.int64())), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
            fields=list(_ARROW.value_type))
        offsets = np.zeros(len(counts) + 1, np.int32)
        np.cumsum(counts, out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), structs, type=_ARROW)
    return run


def scan(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with an array of (kind, start, end) of all matches, by start and then in the rules' order."""
    found = _scan(Scanner(RULES if rules is None else rules))(docs[text].cast("binary"))
    return docs.select(*[docs[c] for c in docs.columns], found.alias(free_name(docs.columns, out)))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
