"""Suffix and common-prefix arrays by induced sorting with disk-backed queues.

Texts are sequences of whole numbers with 0 as the end mark of every stretch.
A suffix is *small* (S) or *large* (L) against the next one; the leftmost S
suffixes after an L suffix (the *marks*) are sorted first, through the sequence
of their substrings' names, recursively; the order of all others is induced
from them with a queue that gives out suffix tuples by first symbol and order
of arrival.  Each tuple carries its common prefix with the one before it.  Where
the caller wants only some suffixes, only what induces them is carried along.

The queue spills its blocks to an unlinked scratch file of the task (as
Spark's own sorts do) once they pass a memory bound; no other task reads that
file.  Only tuples that wait in the queue can spill: the sequence, the order
and the prefixes that come out are arrays in memory, so the caller keeps
shards small enough for that.  Sequences of more than ``FEW_NAMES`` names are
put in order by rank doubling in memory instead of another recursion, and the
prefixes of the marks come from comparing them, not from the deeper level.
Work goes through whole queue buckets at a time, in numpy.
"""

from __future__ import annotations

import tempfile

import numpy as np

from . import common as C

END = 0
BIG = np.int64(1) << 40


class BucketQueue:
    """Priority queue of (symbol; position, common prefix), first in first out
    within a symbol.  Blocks beyond ``memory`` bytes go to disk."""

    def __init__(self, memory: int):
        self.memory, self.held, self.file = memory, 0, None
        self.blocks: dict[int, list] = {}
        self.spilled = 0

    def push(self, symbol: int, tuples: np.ndarray) -> None:
        if self.held + tuples.nbytes > self.memory:
            self._spill()
        self.blocks.setdefault(symbol, []).append(tuples)
        self.held += tuples.nbytes

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for blocks in self.blocks.values():
            for i, b in enumerate(blocks):
                if isinstance(b, np.ndarray):
                    at = self.file.seek(0, 2)
                    self.file.write(b.tobytes())
                    blocks[i] = (at, b.shape)
                    self.spilled += b.nbytes
        self.held = 0

    def pop(self, symbol: int) -> np.ndarray | None:
        """All tuples waiting under the symbol, in order of arrival."""
        out = []
        for b in self.blocks.pop(symbol, ()):
            if isinstance(b, tuple):
                self.file.seek(b[0])
                b = np.frombuffer(self.file.read(int(np.prod(b[1])) * 8), np.int64).reshape(b[1])
            else:
                self.held -= b.nbytes
            out.append(b)
        return np.concatenate(out, axis=1) if out else None

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S); end marks are S."""
    n = len(t)
    nxt = np.append(t[1:], END)
    differs = t != nxt
    differs[-1] = True
    at = np.flatnonzero(differs)
    small = np.repeat(t[at] < nxt[at], np.diff(np.concatenate(([-1], at))))[:n]
    small[t == END] = True
    return small


def marks_of(t: np.ndarray, small: np.ndarray) -> np.ndarray:
    m = small.copy()
    m[1:] &= ~small[:-1]
    m[0] = False
    m |= t == END
    return np.flatnonzero(m)


def _between(lcp: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Smallest common prefix on the way from one chosen tuple to the next."""
    out = np.full(len(at), -1, np.int64)
    if len(at) > 1:
        bounds = np.stack([at[:-1] + 1, at[1:] + 1], 1).ravel()
        ext = np.append(lcp, BIG)
        out[1:] = np.minimum.reduceat(ext, bounds)[::2]
    return out


class Steps:
    """Common prefixes of tuples that one symbol receives in different steps.

    A tuple induced now follows, under its symbol, the tuple induced last;
    their common prefix is one more than the smallest value met in between.
    """

    def __init__(self):
        self.low = np.empty(1024, np.int64)
        self.n = 0
        self.at: dict[int, tuple[int, int]] = {}

    def close(self, lcp: np.ndarray) -> None:
        if self.n == len(self.low):
            self.low = np.concatenate((self.low, np.empty_like(self.low)))
        self.low[self.n] = lcp.min()
        self.n += 1

    def since(self, symbol: int, lcp: np.ndarray, first: int, last: int) -> int:
        """Value for the first tuple given to ``symbol`` in the present step."""
        before = self.at.get(symbol)
        self.at[symbol] = (self.n, int(lcp[last + 1:].min(initial=BIG)))
        if before is None:
            return 0
        step, tail = before
        between = int(self.low[step + 1:self.n].min(initial=BIG))
        return min(tail, between, int(lcp[:first + 1].min())) + 1


def reached(wanted: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the suffixes through which the wanted ones are induced, from each of
    these to before the next mark; and the next marks, where that begins.

    Order and prefixes among them need no other suffix.
    """
    last = np.zeros(len(wanted), np.int32)
    at = np.flatnonzero(wanted)
    last[at] = at + 1
    np.maximum.accumulate(last, out=last)
    mark = np.repeat(np.append(0, marks + 1).astype(np.int32), np.diff(np.concatenate(([0], marks, [len(wanted)]))))
    needed = last >= np.maximum(mark, 1)
    after = marks[marks > 0]
    return needed, after[needed[after - 1]]


def induce(t: np.ndarray, small: np.ndarray, symbols: list[int], seeds, up: bool, memory: int,
           run_length: np.ndarray | None, needed: np.ndarray) -> dict[int, np.ndarray]:
    """One pass over the symbols: up, L tuples from the marks; down, S from L;
    of the ``needed`` suffixes only.

    ``seeds`` gives per symbol its (position; prefix) tuples in the order of
    the pass; a prefix is that with the tuple before in the pass.  Returns the
    induced tuples per symbol in the same form.  ``run_length`` (length of the
    run of equal symbols from each position) is given if prefixes are carried:
    at the seam of L and S tuples under one symbol the shorter run is the
    common prefix.
    """
    queue, done, steps = BucketQueue(memory), {}, Steps()
    before = np.zeros_like(t)  # the symbol that a suffix induces, END for none
    before[1:] = np.where((small[:-1] != up) & needed[:-1], t[:-1], END)

    def emit(tuples):
        pos, lcp = tuples
        first = before[pos]
        at = np.flatnonzero(first)
        if len(at):
            of = first[at]
            by = np.argsort(of, kind="stable")
            of = of[by]
            cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
            ext = None if run_length is None else np.append(lcp, BIG)
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)]):
                idx, symbol = at[by[a:b]], int(of[a])
                new = np.zeros((2, b - a), np.int64)
                new[0] = pos[idx] - 1
                if run_length is not None:
                    if b - a > 1:
                        bounds = np.stack([idx[:-1] + 1, idx[1:] + 1], 1).ravel()
                        new[1, 1:] = np.minimum.reduceat(ext, bounds)[::2] + 1
                    new[1, 0] = steps.since(symbol, lcp, int(idx[0]), int(idx[-1]))
                queue.push(symbol, new)
        if run_length is not None:
            steps.close(lcp)

    for c in symbols if up else symbols[::-1]:
        got = []
        while (waiting := queue.pop(c)) is not None:
            got.append(waiting)
            emit(waiting)
        if got:
            done[c] = np.concatenate(got, axis=1)
        extra = seeds.get(c)
        if extra is not None:
            extra = extra.copy()
            if run_length is not None:
                extra[1, 0] = min(run_length[done[c][0, -1]], run_length[extra[0, 0]]) if got else 0
            emit(extra)
    queue.close()
    return done


def _down_seeds(large: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """L tuples in descending order, each with the prefix it shares with the next larger one."""
    out = {}
    for c, (pos, lcp) in large.items():
        back = np.zeros((2, len(pos)), np.int64)
        back[0] = pos[::-1]
        back[1, 1:] = lcp[1:][::-1]
        out[c] = back
    return out


def _by_symbol(t: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> dict[int, np.ndarray]:
    of = t[pos]
    cuts = np.flatnonzero(of[1:] != of[:-1]) + 1
    return {int(of[a]): np.stack([pos[a:b], lcp[a:b]]).astype(np.int64)
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)])} if len(pos) else {}


def _next(places: np.ndarray) -> np.ndarray:
    """For every position the first of the ascending places at or after it."""
    return np.repeat(places, np.diff(np.concatenate(([-1], places))))


def common_prefixes(t: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Common prefix of each listed suffix with the one listed before it,
    eight symbols at a time (if they are bytes) and then one by one."""
    out = np.zeros(len(pos), np.int64)
    a, b = pos[1:].copy(), pos[:-1].copy()
    live = np.arange(1, len(pos))
    if t.dtype == np.uint8:
        eight = np.ascontiguousarray(np.ndarray(len(t), "<u8", np.append(t, np.zeros(8, np.uint8)), strides=(1,)))
        whole = _next(np.flatnonzero(t == END)) - np.arange(len(t)) >= 8
        go, x, y = live, a, b
        while len(go):
            same = (eight[x] == eight[y]) & whole[x]
            go, x, y = go[same], x[same] + 8, y[same] + 8
            out[go] += 8
        a, b = a + out[1:], b + out[1:]
    while len(live):
        same = (t[a] == t[b]) & (t[a] != END)
        live, a, b = live[same], a[same] + 1, b[same] + 1
        out[live] += 1
    return out


def _by_value(x: np.ndarray) -> np.ndarray:
    """Positions in the order of (value, position); values are whole numbers below about ``len(x)``."""
    bits = len(x).bit_length()
    return np.sort((x.astype(np.int64) << bits) | np.arange(len(x))) & ((1 << bits) - 1)


def doubled_order(t: np.ndarray) -> np.ndarray:
    """Suffixes by rank doubling: the end of the recursion, for a short
    sequence over many names.  Positions of end marks are left out."""
    n = len(t)
    ends = np.flatnonzero(t == END)
    reach = _next(ends) - np.arange(n)

    # a rank is the number of suffixes known to be smaller; only suffixes that
    # share theirs, and go on, are looked at again
    order = _by_value(t)
    heads = np.flatnonzero(np.append(True, t[order[1:]] != t[order[:-1]]))
    size = np.diff(np.append(heads, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, size)
    tied = order[np.repeat(size > 1, size)]
    live = tied[t[tied] != END]
    k = 1
    while len(live := live[reach[live] >= k]):
        second = np.zeros(len(live), np.int64)
        on = reach[live] > k
        second[on] = rank[live[on] + k] + 1
        both = rank[live] * (n + 1) + second
        by = np.argsort(both)
        live, both = live[by], both[by]
        old = rank[live]
        group = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        heads = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        size = np.diff(np.append(heads, len(live)))
        first = np.repeat(group, np.diff(np.append(group, len(live))))
        rank[live] = old + np.repeat(heads, size) - first
        live = live[np.repeat(size > 1, size)]
        k *= 2
    return _by_value(rank)[len(ends):]  # equal suffixes stand in order of position


def sorted_marks(t: np.ndarray, small: np.ndarray, marks: np.ndarray, symbols: list[int], memory: int) -> np.ndarray:
    """The marks (end marks left out) in the order of their suffixes.

    Of equal substrings from mark to mark one is induced; the others share its name.
    """
    which = np.flatnonzero(t[marks] != END)
    inner = marks[which]
    if not len(inner):
        return inner
    h = C.Stretches(C.mix(t.astype(np.uint64) + np.uint64(1))).hash(inner, marks[which + 1] + 1)
    by = np.argsort(h)
    h = h[by]
    heads = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    group = np.full(len(t), -1, np.int32)
    group[inner[by[heads]]] = np.arange(len(heads))
    needed, start = reached(group >= 0, marks)
    start = start[np.argsort(t[start], kind="stable")]  # end marks come first
    large = induce(t, small, symbols, _by_symbol(t, start, np.zeros(len(start))), True, memory, None, needed)
    down = induce(t, small, symbols, {c: x[:, ::-1] for c, x in large.items()}, False, memory, None, needed)
    order = np.concatenate([down[c][0, ::-1] for c in symbols if c in down])
    order = order[group[order] >= 0]
    if len(heads) == len(inner):
        return order
    name = np.empty(len(heads), np.int64)
    name[group[order]] = np.arange(1, len(heads) + 1)
    short = np.zeros(len(marks), np.int64)  # the sequence of names; end marks stay end marks
    short[which[by]] = np.repeat(name, np.diff(np.append(heads, len(inner))))
    if len(heads) <= FEW_NAMES and len(short) > SHORT:
        return marks[suffix_order(short, memory, carry=False)[0]]
    return marks[doubled_order(short)]


FEW_NAMES = 2048
SHORT = 64


def suffix_order(t: np.ndarray, memory: int = 64 << 20, carry: bool = True,
                 wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """All suffixes in order (end marks left out), and with ``carry`` the
    common prefix of each with the one before it; prefixes end at end marks.
    With ``wanted`` (flags) only these and the suffixes they are induced through."""
    if not len(t):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    small = suffix_types(t)
    marks = marks_of(t, small)
    symbols = np.flatnonzero(np.bincount(t)).tolist()
    inner = sorted_marks(t, small, marks, symbols, memory)
    needed, start = reached(t != END if wanted is None else wanted, marks)
    begins = np.zeros(len(t), bool)
    begins[start] = True
    inner = inner[begins[inner]]
    run_length = None
    lcp = np.zeros(len(inner), np.int64)
    if carry:
        lcp = common_prefixes(t, inner)
        edge = np.flatnonzero(np.append(t[1:] != t[:-1], True))
        run_length = _next(edge) - np.arange(len(t)) + 1
    ends = start[t[start] == END]
    seeds = _by_symbol(t, np.concatenate((ends, inner)), np.concatenate((np.zeros(len(ends), np.int64), lcp)))
    large = induce(t, small, symbols, seeds, True, memory, run_length, needed)
    down = induce(t, small, symbols, _down_seeds(large), False, memory, run_length, needed)
    pos, out = [], []
    for c in symbols:
        up_part, down_part = large.get(c), down.get(c)
        if up_part is not None:
            pos.append(up_part[0])
            out.append(up_part[1])
        if down_part is not None:
            pos.append(down_part[0, ::-1])
            back = np.zeros(down_part.shape[1], np.int64)
            back[1:] = down_part[1, 1:][::-1]
            if run_length is not None and up_part is not None:
                back[0] = min(run_length[up_part[0, -1]], run_length[down_part[0, -1]])
            out.append(back)
    if not pos:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(pos), np.concatenate(out) if carry else None
