"""Texts as symbols of a small, fixed alphabet, so that tables over n-grams
of symbols have a proven size whatever the corpus.

Symbols (five bits): 0 white space (runs count once), 1-26 the letters a to z,
27-29 other letters, by code point, 30 digits, 31 everything else. From
``MERGED`` on, a symbol stands for many characters; who uses the table has to tell
these apart by other means (``quality.events``).
"""

from __future__ import annotations

import numpy as np

SYMBOLS = 32
MERGED = 27
_TABLE: list[np.ndarray] = []


def table() -> np.ndarray:
    """The symbol of every code point."""
    if not _TABLE:
        t = np.full(0x110000, 31, np.uint8)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                t[c] = 27 + c % 3
            elif x.isdigit():
                t[c] = 30
        t[ord("a"):ord("z") + 1] = np.arange(1, 27)
        t[[32, *range(9, 14)]] = 0
        _TABLE.append(t)
    return _TABLE[0]


def codes(text: str) -> np.ndarray:
    """Code points."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(symbols: np.ndarray, n: int) -> np.ndarray:
    """The n-gram that ends at each symbol, five bits for each symbol; white
    space stands before the first."""
    out = symbols.astype(np.uint32)
    for k in range(1, n):
        out[k:] |= symbols[:-k].astype(np.uint32) << np.uint32(5 * k)
    return out


class Sums:
    """Counts of codes, gathered sparsely."""

    def __init__(self):
        self.codes, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def add(self, codes: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            codes, counts = np.unique(codes, return_counts=True)
        if not len(self.codes):
            self.codes, self.counts = codes, counts.astype(np.int64)
            return
        both, at = np.unique(np.concatenate([self.codes, codes]), return_inverse=True)
        sums = np.zeros(len(both), np.int64)
        n = len(self.codes)
        sums[at[:n]] = self.counts
        sums[at[n:]] += counts
        self.codes, self.counts = both, sums
