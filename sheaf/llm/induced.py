"""Suffix order and common prefixes by induced sorting with spilling queues.

``suffix_order`` works on one shard of symbols.  The left-most S positions
(LMS, as in induced sorting) cut the shard into short substrings.  Their
tuples go through a queue that sorts and names them; the names are a shorter
string, ordered by the same function (recursion); and the suffixes wanted are
induced from the LMS order by tuples (symbols up to the next LMS position,
its rank) that go through a queue again.  Every tuple carries what is needed for
the common prefix of neighbours, counted in units of the first level, so
no second look at the text is taken.

A queue holds ``limit`` tuples in memory; more are sorted into runs on
disk (in the shared folder that the caller names) and merged by blocks.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np

#: Common prefixes are counted up to this many units (two bytes each in the tables).
CAP = 60_000


def order_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Indices that sort non-negative int64 pairs."""
    by_first = np.argsort(first)
    sorted_ = first[by_first]
    group = np.cumsum(np.append(False, sorted_[1:] != sorted_[:-1])) if len(first) else sorted_
    if len(first) and int(group[-1]).bit_length() + int(second.max()).bit_length() > 62:
        return np.lexsort((second, first))
    width = max(1, int(second.max(initial=0)).bit_length())
    return by_first[np.argsort((group << width) | second[by_first])]


class TupleQueue:
    """Rows of ``width`` int64 columns, given back in the order of the first two."""

    def __init__(self, limit: int, folder: str | None, width: int = 3):
        self.limit, self.folder, self.width = limit, folder, width
        self.held: list[tuple[np.ndarray, ...]] = []
        self.rows = 0
        self.runs: list[str] = []
        self.fs = None

    def push(self, *columns: np.ndarray) -> None:
        for k in range(0, len(columns[0]), self.limit):
            self.held.append(tuple(c[k : k + self.limit] for c in columns))
            self.rows += len(self.held[-1][0])
            if self.rows >= self.limit and self.folder:
                self._spill()

    def _sorted(self) -> tuple[np.ndarray, ...]:
        cols = tuple(np.concatenate(c) for c in zip(*self.held))
        order = order_of(cols[0], cols[1])
        self.held, self.rows = [], 0
        return tuple(c[order] for c in cols)

    def _open(self):
        if self.fs is None:
            from pyarrow import fs

            uri = re.sub(r"^file:/+", "/", self.folder)
            self.fs, root = (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)
            self.root = f"{root.rstrip('/')}/queue-{uuid.uuid4().hex}"
            self.fs.create_dir(self.root, recursive=True)
        return self.fs

    def _spill(self) -> None:
        fs, cols = self._open(), self._sorted()
        path = f"{self.root}/{len(self.runs)}"
        with fs.open_output_stream(path) as out:
            out.write(np.stack(cols, axis=1).tobytes())
        self.runs.append(path)

    def pop(self) -> Iterator[tuple[np.ndarray, ...]]:
        """All rows in order, by blocks; the runs are deleted."""
        if not self.runs:
            if self.held:
                yield self._sorted()
            return
        tail = np.stack(self._sorted(), axis=1) if self.held else None
        files = [self.fs.open_input_file(p) for p in self.runs]
        try:
            yield from self._merge(files, tail)
        finally:
            for f in files:
                f.close()
            self.fs.delete_dir(self.root)

    def _merge(self, files: list, tail: np.ndarray | None) -> Iterator[tuple[np.ndarray, ...]]:
        size = max(1, self.limit // (len(files) + 1))

        def read(f) -> np.ndarray:
            return np.frombuffer(f.read(size * self.width * 8), dtype=np.int64).reshape(-1, self.width)

        blocks: list[np.ndarray] = [read(f) for f in files]
        if tail is not None:
            blocks.append(tail)
        sources = [*files, *([None] if tail is not None else [])]
        while any(len(b) for b in blocks):
            rows = np.concatenate(blocks)
            owner = np.repeat(np.arange(len(blocks)), [len(b) for b in blocks])
            order = order_of(rows[:, 0], rows[:, 1])
            # rows up to the least last row of a run that may go on are final
            ends = np.cumsum([len(b) for b in blocks]) - 1
            place = np.empty(len(rows), dtype=np.int64)
            place[order] = np.arange(len(rows))
            open_ = [place[ends[k]] for k, s in enumerate(sources) if s is not None and len(blocks[k])]
            final = min(open_) + 1 if open_ else len(rows)
            yield tuple(np.ascontiguousarray(c) for c in rows[order[:final]].T)
            rest = order[final:]
            kept = [rows[np.sort(rest[owner[rest] == k])] for k in range(len(blocks))]
            blocks = [read(s) if s is not None and not len(b) else b for s, b in zip(sources, kept)]
            sources = [s if s is None or len(b) else None for s, b in zip(sources, blocks)]


class RangeMin:
    """Least value of ``lcp[a + 1 .. b]`` for a < b (a table of powers of two)."""

    def __init__(self, lcp: np.ndarray):
        self.table = [np.minimum(lcp, CAP).astype(np.uint16)]
        while 2 ** len(self.table) <= len(lcp):
            last, half = self.table[-1], 2 ** (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            t = self.table[k]
            out[at] = np.minimum(t[low[at]], t[high[at] - (1 << int(k)) + 1])
        return out


class _Level:
    """One string of the recursion.  The last symbol is 0 and occurs once.

    ``units``: units of the first level before each symbol (and after the
    last).  ``names``: common prefix, in units, of two different symbols.
    """

    def __init__(self, symbols: np.ndarray, units: np.ndarray, names: RangeMin | None, limit: int, folder: str | None, cap: int = CAP):
        self.s, self.units, self.names, self.limit, self.folder, self.cap = symbols, units, names, limit, folder, cap
        n = len(symbols)
        change = np.append(np.flatnonzero(symbols[1:] != symbols[:-1]), n - 1)
        self.run = np.repeat(change, np.diff(np.append(-1, change))) - np.arange(n) + 1  # equal symbols from here on
        after = np.arange(n) + self.run
        self.small = np.ones(n, dtype=bool)
        self.small[: n - 1] = symbols[np.minimum(after, n - 1)][: n - 1] > symbols[: n - 1]
        self.lms = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1
        self.next = np.searchsorted(self.lms, np.arange(n), side="right")  # index of the first LMS position behind
        self.next[-1] = len(self.lms) - 1  # the last symbol is its own
        self.bits = int(symbols.max()).bit_length() + 1
        self.per = 62 // self.bits
        typed = np.append(symbols * 2 + self.small, np.zeros(self.per, dtype=np.int64))
        self.word = np.zeros(n, dtype=np.int64)
        for k in range(self.per):
            self.word = (self.word << self.bits) | typed[k : k + n]
        kept = np.arange(1, self.per + 1)
        self.mask = ((1 << (kept * self.bits)) - 1) << ((self.per - kept) * self.bits)

    def _words(self, at: np.ndarray, gap: np.ndarray) -> np.ndarray:
        """The typed symbols from each position to its LMS position, as many as fit."""
        return self.word[at] & self.mask[np.minimum(gap, self.per - 1)]

    def _common(self, a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> np.ndarray:
        """Common prefix of suffixes whose words differ."""
        top = np.frexp((wa ^ wb).astype(np.float64))[1] - 1
        near = np.flatnonzero((wa ^ wb) >> np.minimum(top, 62) == 0)  # rounded up to the next power
        top[near] -= 1
        q = self.per - 1 - top // self.bits
        x, y = a + q, b + q
        out = self.units[x] - self.units[a]
        if self.names:
            other = np.flatnonzero(self.s[x] != self.s[y])
            out[other] += self.names(self.s[x[other]], self.s[y[other]])
        return out

    def _extend(self, a: np.ndarray, b: np.ndarray, lcp: np.ndarray) -> np.ndarray:
        """Common prefixes that ended at one symbol of two types go on to the end of the shorter run.

        One of two neighbours may have ended so in between: the outer ones then end at two
        different symbols, whose own common prefix is still to be counted."""
        x = np.searchsorted(self.units, self.units[a] + lcp) if self.names else a + lcp
        y = np.searchsorted(self.units, self.units[b] + lcp) if self.names else b + lcp
        last = len(self.s) - 1
        whole = (x <= last) & (y <= last) & (lcp < self.cap)
        x, y = np.minimum(x, last), np.minimum(y, last)
        whole &= (self.units[x] - self.units[a] == lcp) & (self.units[y] - self.units[b] == lcp)
        at = np.flatnonzero(whole)
        x, y = x[at], y[at]
        step = np.where(self.s[x] == self.s[y], np.minimum(self.run[x], self.run[y]), 0)
        out = lcp.copy()
        out[at] = self.units[x + step] - self.units[a[at]]
        if self.names:
            x, y = self.s[x + step], self.s[y + step]
            other = np.flatnonzero(x != y)
            out[at[other]] += self.names(x[other], y[other])
        return out

    def order(self, at: np.ndarray, rank: np.ndarray | None, common: RangeMin | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions in order, dense rank of each, common prefix with the one before).

        Without ``rank`` positions are compared up to the next LMS position only.
        What is alike for ``cap`` units counts as alike for ``CAP``, in any order."""
        sets = [at]
        while True:
            gap = self.lms[self.next[sets[-1]]] - sets[-1]
            deeper = np.unique(sets[-1][gap >= self.per]) + self.per
            if not len(deeper) or len(sets) * self.per >= self.cap:
                break
            sets.append(deeper)
        below: tuple[np.ndarray, np.ndarray, RangeMin] | None = None
        for depth in range(len(sets) - 1, -1, -1):
            here = sets[depth]
            queue = TupleQueue(self.limit, self.folder)
            for k in range(0, len(here), self.limit):
                part = here[k : k + self.limit]
                to = self.next[part]
                gap = self.lms[to] - part
                tail = rank[to] if rank is not None else np.zeros(len(part), dtype=np.int64)
                far = np.flatnonzero(gap >= self.per)
                if len(far):
                    tail = tail.copy()
                    tail[far] = 0 if below is None else below[1][np.searchsorted(below[0], part[far] + self.per)]
                queue.push(self._words(part, gap), tail, part)
            words, tails, places = (np.concatenate(c) for c in zip(*queue.pop()))
            a, b = places[:-1], places[1:]
            other_word, other_tail = words[:-1] != words[1:], tails[:-1] != tails[1:]
            new = other_word | other_tail
            lcp = np.full(len(places), CAP, dtype=np.int64)
            lcp[0] = 0
            w = np.flatnonzero(other_word)
            lcp[w + 1] = self._common(a[w], b[w], words[w], words[w + 1])
            t = np.flatnonzero(~other_word & other_tail)
            if len(t):
                to = self.lms[self.next[a[t]]]
                far = to - a[t] >= self.per
                end = np.where(far, a[t] + self.per, to)
                more = np.empty(len(t), dtype=np.int64)
                if far.any():
                    more[far] = below[2](tails[t[far]], tails[t[far] + 1])
                if not far.all():
                    more[~far] = common(tails[t[~far]], tails[t[~far] + 1])
                lcp[t + 1] = self.units[end] - self.units[a[t]] + more
            if rank is not None:
                lcp[1:] = self._extend(a, b, lcp[1:])
            dense = np.cumsum(np.append(False, new)) if len(places) > 1 else np.zeros(len(places), dtype=np.int64)
            if depth:
                by_place = np.argsort(places)
                below = (places[by_place], dense[by_place], RangeMin(lcp[np.append(True, new)]))
        return places, dense, np.minimum(lcp, CAP)

    def lms_order(self) -> tuple[np.ndarray, RangeMin]:
        """Rank of each LMS suffix (in text order) and common prefixes by rank."""
        places, name, lcp = self.order(self.lms, None, None)
        first = np.append(True, name[1:] != name[:-1])
        names = np.empty(len(self.lms), dtype=np.int64)
        names[np.searchsorted(self.lms, places)] = name
        if first.all():
            lcp[1:] = self._extend(places[:-1], places[1:], lcp[1:])
            return names, RangeMin(lcp)
        units = np.append(self.units[self.lms], self.units[-1])
        places, _, lcp = _all(_Level(names, units, RangeMin(lcp[first]), self.limit, self.folder, self.cap))
        rank = np.empty(len(names), dtype=np.int64)
        rank[places] = np.arange(len(names))
        lcp[1:] = self._extend(self.lms[places[:-1]], self.lms[places[1:]], lcp[1:])
        return rank, RangeMin(lcp)


def _all(level: _Level, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    wanted = np.arange(len(level.s)) if wanted is None else wanted
    if len(level.s) == 1 or not len(wanted):
        return wanted, np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=np.int64)
    rank, common = level.lms_order()
    return level.order(wanted, rank, common)


def suffix_order(pieces: list[bytes], wanted: np.ndarray | None = None, limit: int = 1 << 22, folder: str | None = None, cap: int = CAP) -> tuple[np.ndarray, np.ndarray]:
    """(positions in order, common prefix with the one before) of the pieces' suffixes.

    Positions count through the pieces with one place for a separator behind each.
    ``wanted``: the positions to be ordered (default all but separators).
    Prefixes end with their piece and are counted up to ``cap``; suffixes alike for ``cap`` bytes come in any order.
    """
    joined = np.frombuffer(b"\0".join([*pieces, b""]), dtype=np.uint8).astype(np.int64) + 2
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    joined[ends] = 1
    symbols = np.append(joined, 0)
    if wanted is None:
        wanted = np.setdiff1d(np.arange(len(joined)), ends)
    level = _Level(symbols, np.arange(len(symbols) + 1), None, limit, folder, min(cap, CAP))
    places, _, lcp = _all(level, wanted)
    left = ends[np.searchsorted(ends, places)] - places
    room = np.append(0, np.minimum(left[:-1], left[1:])) if len(places) else left
    return places, np.minimum(np.minimum(lcp, room), cap)
