"""Byte-level BPE of whole texts by cached chunks.

A chunk is a space and what follows it up to the next cut. Cuts lie before a
space that ends a word, or that stands between other white space and a word:
there the byte-level pre-tokenizer always begins a new piece, so the ids of a
text are the ids of its chunks in order. A task encodes each distinct chunk
once (the cache is emptied when it is full, so memory is bounded) and puts
the ids of all texts together with array operations.
"""

from __future__ import annotations

import gc
import json
import re
from itertools import chain

import numpy as np

#: The code points with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ODD = re.compile(f" [{WHITE}]")
_CUT = re.compile(f"(?<![{WHITE}]) | (?=[^{WHITE}])")


def added_tokens(spec: str) -> dict[str, int]:
    """Added tokens of a tokenizer file; what this module can't do is refused."""
    t = json.loads(spec)
    pre = t.get("pre_tokenizer") or {}
    if t.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or t["model"]["type"] != "BPE":
        raise ValueError("a byte-level BPE tokenizer without a normalizer is needed")
    for a in t.get("added_tokens", ()):
        if a["lstrip"] or a["rstrip"] or a["single_word"]:
            raise ValueError(f"added token {a['content']!r}: stripping and whole words aren't supported")
    return {a["content"]: a["id"] for a in t.get("added_tokens", ())}


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start+1, .. of ``length`` each, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


class _Index(dict):
    """Numbers keys as they come; ``new``: those met since it was last emptied."""

    def __init__(self):
        self.new = []

    def __missing__(self, key):
        self.new.append(key)
        n = self[key] = len(self)
        return n


class ChunkEncoder:
    """``encode_new(chunks) -> list of id lists`` is called for distinct chunks not in the cache."""

    def __init__(self, encode_new, added: dict[str, int], limit: int = 400_000, decimals: bool = False):
        self.encode_new, self.added, self.limit, self.decimals = encode_new, added, limit, decimals
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.clear()

    def clear(self):
        self.index, self.strings = _Index(), []
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)

    def _keys(self, text: str, keys: list) -> None:
        """A chunk's key is the text behind its space, at the start of a
        segment a 1-tuple; an added token's is a 2-tuple."""
        if self.split_added and any(a in text for a in self.added):
            for i, part in enumerate(self.split_added.split(text)):
                if i % 2:
                    keys.append((part, self.added[part]))
                elif part:
                    self._segment(part, keys)
        elif text:
            self._segment(text, keys)

    def _segment(self, text: str, keys: list) -> None:
        parts = _CUT.split(text) if text[-1] == " " or _ODD.search(text) else text.split(" ")
        if parts[0]:
            parts[0] = (parts[0],)
            keys += parts
        else:
            keys += parts[1:]

    def _learn(self) -> None:
        """Ids of the chunks that the index met for the first time."""
        new, self.index.new = self.index.new, []
        plain = [" " + k if k.__class__ is str else k[0] for k in new if k.__class__ is str or len(k) == 1]
        lists = self.encode_new(plain) if plain else []
        if len(plain) < len(new):
            made = iter(lists)
            lists = [[k[1]] if k.__class__ is tuple and len(k) == 2 else next(made) for k in new]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        n, at = int(lengths.sum()), len(self.index) - len(new)
        while self.used + n > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while len(self.index) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.empty_like(self.lengths)])
        self.lengths[at:at + len(new)] = lengths
        self.starts[at:at + len(new)] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used:self.used + n] = np.fromiter(chain.from_iterable(lists), np.uint32, n)
        self.used += n
        if self.decimals:
            self.strings += [",".join(map(str, x)) for x in lists]

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of all texts, the end of each text's ids, and with
        ``decimals`` each text's ids as decimals joined by commas."""
        on = gc.isenabled()
        gc.disable()        # nothing here makes cycles; the collector would walk the cache again and again
        try:
            return self._encode(texts)
        finally:
            if on:
                gc.enable()

    def _encode(self, texts):
        keys, ends = [], []
        for t in texts:
            self._keys(t, keys)
            ends.append(len(keys))
        if len(self.index) > self.limit:
            self.clear()
        slots = np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))
        if self.index.new:
            self._learn()
        joined = []
        if self.decimals:
            string, listed = self.strings.__getitem__, slots.tolist()
            joined = [",".join(map(string, listed[a:b])) for a, b in zip([0, *ends], ends)]
        lengths = self.lengths[slots]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[ragged(self.starts[slots], lengths)], upto[np.array(ends, np.int64)] if ends else upto[:0], joined
