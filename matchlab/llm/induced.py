"""External induced sorting of the suffixes of one shard, with the lengths of
their common prefixes, up to a depth that is enough to find repeats.

The text lies in a file, as 16-bit symbols (0: the end of a piece). Suffixes
that begin smaller than their successor after a larger one (the starred ones)
are ordered first: their substrings up to the next starred one get ranks as
names, and the string of names is sorted in turn, by doubling, until names
are unique or span the depth. From their order all others are induced: going
up through the symbols, each suffix hands its left neighbour, if that is
larger, to the queue of the neighbour's symbol; going down, likewise those
that are smaller. The queue is a priority queue by symbol whose entries come
out in the order in which they went in: sorted runs, which it writes to disk
when it holds more than ``memory`` entries. An entry carries the position and
the length of the prefix it shares with the entry before it: one more than
the smallest such length between the two suffixes that induced them.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

_KEY = 6        # symbols of ten bits in a key


class SymbolQueue:
    """Entries (position, common prefix) by symbol, first in first out."""

    def __init__(self, folder: str, memory: int = 1 << 22):
        self.folder, self.memory, self.held, self.size, self.runs = folder, memory, {}, 0, []

    def push(self, symbols: np.ndarray, positions: np.ndarray, prefixes: np.ndarray) -> None:
        """Entries sorted by symbol."""
        cuts = np.flatnonzero(np.diff(symbols.astype(np.int32), prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(symbols)]):
            self.held.setdefault(int(symbols[a]), []).append((positions[a:b], prefixes[a:b]))
        self.size += len(symbols)
        if self.size > self.memory:
            self._spill()

    def _spill(self) -> None:
        index, at = {}, 0
        names = [os.path.join(self.folder, f"{id(self)}-{len(self.runs)}-{k}") for k in "pl"]
        with open(names[0], "wb") as p, open(names[1], "wb") as c:
            for s in sorted(self.held):
                n = 0
                for positions, prefixes in self.held[s]:
                    p.write(positions.astype(np.int64).tobytes())
                    c.write(prefixes.astype(np.uint16).tobytes())
                    n += len(positions)
                index[s] = at, n
                at += n
        self.runs.append((*names, index))
        self.held, self.size = {}, 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All entries of a symbol."""
        found = []
        for p, c, index in self.runs:
            at, n = index.pop(symbol, (0, 0))
            if n:
                found.append((np.fromfile(p, np.int64, n, offset=8 * at), np.fromfile(c, np.uint16, n, offset=2 * at)))
        mine = self.held.pop(symbol, [])
        self.size -= sum(len(x) for x, _ in mine)
        found += mine
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.uint16)
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def mapped(path: str, kind, n: int) -> np.ndarray:
    """A new file as an array; a plain one, whose parts are cheaper to take."""
    return np.asarray(np.memmap(path, kind, "w+", shape=(n,)))


class _Handed:
    """Common prefixes of the suffixes handed to each symbol's queue, one after the other."""

    def __init__(self, symbols: int, depth: int):
        self.since = np.zeros(symbols, np.uint16)   # smallest since the symbol got its last one
        self.met = np.zeros(symbols, bool)
        self.depth = depth

    def hand(self, prefixes: np.ndarray, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """``prefixes`` of all suffixes passed, each with its predecessor; those ``at`` hand
        on a suffix, sorted by ``symbols``. Their common prefixes."""
        levels = [prefixes]
        while 1 << len(levels) <= len(prefixes):
            half, last = 1 << (len(levels) - 1), levels[-1]
            levels.append(np.minimum(last[:-half], last[half:]))
        first = np.concatenate([[True], symbols[1:] != symbols[:-1]])
        low = np.where(first, 0, np.concatenate([[0], at[:-1] + 1]))
        out = np.empty(len(at), np.uint16)
        span = at - low + 1
        level = np.frexp(span.astype(np.float64))[1] - 1
        for k in range(int(level.max()) + 1):
            m = level == k
            if m.any():
                out[m] = np.minimum(levels[k][low[m]], levels[k][at[m] - (1 << k) + 1])
        out[first] = np.minimum(out[first], self.since[symbols[first]])
        smallest = prefixes.min()
        rest = np.minimum.accumulate(prefixes[::-1])[::-1]
        self.since = np.minimum(self.since, smallest)
        last = np.concatenate([first[1:], [True]])
        after = at[last] + 1
        self.since[symbols[last]] = np.where(after < len(prefixes), rest[np.minimum(after, len(rest) - 1)], 0xFFFF)
        met = self.met[symbols] | ~first
        self.met[symbols] = True
        return np.where(met, np.minimum(out.astype(np.int64) + 1, self.depth), 0).astype(np.uint16)


class Suffixes:
    """``text``: a memory-mapped array of symbols that ends with 0."""

    def __init__(self, text: np.ndarray, depth: int, folder: str, memory: int = 1 << 22):
        self.text, self.depth, self.folder, self.memory = text, depth, folder, memory
        n = len(text)
        change = np.flatnonzero(text[1:] != text[:-1])          # last places of equal runs
        run_end = np.append(change, n - 1)
        runs = np.diff(run_end, prepend=-1)
        self.run = self._file("run", np.uint16, n)              # equal symbols from here on
        self.run[:] = np.minimum(np.repeat(run_end, runs) - np.arange(n) + 1, depth)
        small = np.append(text[change] < text[change + 1], True)
        self.small = np.repeat(small, runs)                     # begins smaller than its successor
        star = self.small.copy()
        star[0] = False
        star[1:] &= ~self.small[:-1]
        star[n - 1] = True
        self.star = np.flatnonzero(star)
        self.top = int(text.max()) + 1

    def _file(self, name: str, kind, n: int) -> np.ndarray:
        return mapped(os.path.join(self.folder, name), kind, n)

    # the starred suffixes

    def _keys(self, at: np.ndarray, offset: int, lengths: np.ndarray) -> np.ndarray:
        key = np.zeros(len(at), np.uint64)
        for k in range(_KEY):
            place = np.minimum(at + offset + k, len(self.text) - 1)
            symbol = (self.text[place].astype(np.uint64) * np.uint64(2) + self.small[place].astype(np.uint64)) + np.uint64(1)
            key = key << np.uint64(10) | np.where(offset + k < lengths, symbol, np.uint64(0))
        return key

    @staticmethod
    def _refine(rank: np.ndarray, active: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Ranks (places of their groups' first members) of the active ones, by key within
        each group; the active ones whose group has several members."""
        order = np.lexsort((key, rank[active]))
        items, r, k = active[order], rank[active][order], key[order]
        group = np.concatenate([[True], r[1:] != r[:-1]])
        begins = group | np.concatenate([[True], k[1:] != k[:-1]])
        i = np.arange(len(items))
        start = np.maximum.accumulate(np.where(group, i, 0))
        own = np.maximum.accumulate(np.where(begins, i, 0))
        rank[items] = r + (own - start)
        single = begins & np.concatenate([begins[1:], [True]])
        return items[~single]

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """The starred positions in the order of their suffixes, and each's common prefix with the one before."""
        at, m, n = self.star, len(self.star), len(self.text)
        lengths = np.append(np.diff(at) + 1, 1)
        rank, active, offset = np.zeros(m, np.int64), np.arange(m), 0
        while len(active) and offset <= self.depth:
            active = self._refine(rank, active, self._keys(at[active], offset, lengths[active]))
            offset += _KEY
            active = active[lengths[active] > offset]
        levels, step = [rank.astype(np.int32)], 1
        order = np.argsort(rank, kind="stable")
        r = rank[order]
        tied = np.zeros(m, bool)
        same = r[1:] == r[:-1]
        tied[order[1:][same]] = tied[order[:-1][same]] = True
        active = np.flatnonzero(tied)
        while len(active) and 2 * step <= self.depth + 2:      # a starred substring has two symbols or more
            after = active + step
            key = np.where(after < m, rank[np.minimum(after, m - 1)] + 1, 0)
            active = self._refine(rank, active, key)
            step *= 2
            levels.append(rank.astype(np.int32))
        order = np.argsort(rank, kind="stable")
        a, b = order[:-1].copy(), order[1:].copy()
        prefix = np.zeros(len(a), np.int64)
        going = np.ones(len(a), bool)
        for k in range(len(levels) - 1, -1, -1):
            same = going & (levels[k][a] == levels[k][b])
            fa, fb = a + (1 << k), b + (1 << k)
            prefix[same] += at[np.minimum(fa[same], m - 1)] - at[a[same]]
            ended = same & ((fa >= m) | (fb >= m))
            a[same], b[same] = np.minimum(fa[same], m - 1), np.minimum(fb[same], m - 1)
            going &= ~ended & (prefix < self.depth)
        i = np.flatnonzero(going)
        x, y = at[a[i]], at[b[i]]
        while len(i):
            ok = (x < n) & (y < n)
            ok[ok] = self.text[x[ok]] == self.text[y[ok]]
            i, x, y = i[ok], x[ok] + 1, y[ok] + 1
            prefix[i] += 1
            ok = prefix[i] < self.depth
            i, x, y = i[ok], x[ok], y[ok]
        return at[order], np.concatenate([[0], np.minimum(prefix, self.depth)]).astype(np.uint16)

    # induction

    def _pass(self, queue: SymbolQueue, handed: _Handed, positions, prefixes, small: bool):
        """Hands on the left neighbours of the suffixes passed; those with the same symbol come back."""
        left = positions - 1
        ok = left >= 0
        ok[ok] = self.small[left[ok]] == small
        at = np.flatnonzero(ok)
        if not len(at):
            if len(prefixes):
                handed.since = np.minimum(handed.since, prefixes.min())
            return
        symbols = self.text[left[at]]
        order = np.argsort(symbols, kind="stable")
        at, symbols = at[order], symbols[order]
        queue.push(symbols, left[at], handed.hand(prefixes, at, symbols))

    def buckets(self):
        """For each symbol, from the last to the first: its suffixes in order
        and their common prefixes with the one before (0 for the first)."""
        order, prefix = self.stars()
        first = self.text[order]
        up, handed = SymbolQueue(self.folder, self.memory), _Handed(self.top, self.depth)
        kept = SymbolQueue(self.folder, self.memory)
        for c in range(self.top):
            last = None
            while True:
                positions, prefixes = up.pop(c)
                if not len(positions):
                    break
                last = positions[-1]
                kept.push(np.full(len(positions), c), positions, prefixes)
                self._pass(up, handed, positions, prefixes, False)
            a, b = np.searchsorted(first, [c, c + 1])
            if b > a:
                prefixes = prefix[a:b].copy()
                prefixes[0] = 0 if last is None else min(self.run[last], self.run[order[a]])
                self._pass(up, handed, order[a:b], prefixes, False)
            handed.since[:] = 0
        down, handed = SymbolQueue(self.folder, self.memory), _Handed(self.top, self.depth)
        end = len(self.text) - 1
        for c in range(self.top - 1, -1, -1):
            positions, prefixes = [], []
            while True:
                p, q = down.pop(c)
                if not len(p):
                    break
                positions.append(p)
                prefixes.append(q)
                self._pass(down, handed, p, q, True)
            p, q = kept.pop(c)
            small_p = np.concatenate(positions) if positions else np.empty(0, np.int64)
            small_q = np.concatenate(prefixes) if prefixes else np.empty(0, np.uint16)
            if c == 0 and self.text[end] == 0:     # the text's last suffix, the smallest of all: nothing hands it on
                small_p, small_q = np.append(small_p, end), np.append(small_q, np.uint16(min(1, len(small_p))))
                self._pass(down, handed, small_p[-1:], small_q[-1:], True)
            if len(p):
                back = np.concatenate([[0], q[:0:-1]]).astype(np.uint16)
                if len(small_p):
                    back[0] = min(self.run[small_p[-1]], self.run[p[-1]])
                self._pass(down, handed, p[::-1], back, True)
            joined = np.concatenate([p, small_p[::-1]])
            pre = np.concatenate([q, small_q[1:][::-1] if len(small_q) else small_q])
            if len(small_p):
                between = min(self.run[p[-1]], self.run[small_p[-1]]) if len(p) else 0
                pre = np.concatenate([q, [between], small_q[1:][::-1]]).astype(np.uint16)
            handed.since[:] = 0
            if len(joined):
                yield joined, pre


def repeats(pieces: list[bytes], length: int, memory: int = 1 << 22) -> list[np.ndarray]:
    """For each piece (UTF-8) the places at which a string of ``length`` bytes
    begins that begins anywhere else in the pieces too, as rows [from, to) of
    the bytes they cover."""
    sizes = np.array([len(p) + 1 for p in pieces], np.int64)
    if not len(sizes):
        return []
    ends = np.cumsum(sizes)
    with tempfile.TemporaryDirectory() as folder:
        text = mapped(os.path.join(folder, "text"), np.uint16, int(ends[-1]))
        for p, e in zip(pieces, ends):
            text[e - len(p) - 1:e - 1] = np.frombuffer(p, np.uint8).astype(np.uint16) + 1
        begins = mapped(os.path.join(folder, "begins"), bool, len(text))
        for positions, prefixes in Suffixes(text, length, folder, memory).buckets():
            room = ends[np.searchsorted(ends, positions, side="right")] - 1 - positions
            common = np.minimum(prefixes[1:], np.minimum(room[1:], room[:-1]))
            same = np.flatnonzero(common >= length)
            begins[positions[same]] = begins[positions[same + 1]] = True
        out = []
        for e, n in zip(ends, sizes):
            at = np.flatnonzero(begins[e - n:e - 1])
            if len(at):
                cut = np.flatnonzero(np.diff(at) > length) + 1
                out.append(np.stack([at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])] + length], axis=1))
            else:
                out.append(np.empty((0, 2), np.int64))
        del text, begins
    return out
