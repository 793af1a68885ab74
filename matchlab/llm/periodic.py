"""Periodic runs of words, found by an enhanced suffix array.

A task numbers the words of a slice of documents, document by document, so
that suffixes of two documents never share a prefix, and sorts all suffixes of
the slice at once (prefix doubling, only among those still tied). The ranks
after each doubling give longest common prefixes by descent. Every entry k of
the LCP array with depth d splits an LCP interval in two; the suffixes i of the
smaller part are checked: is i + d, or i - d, in the other part? Then the two
suffixes share exactly d words, so a square of period d ends where it can't go
on (a branching tandem repeat). Each is rotated to the left as far as it goes,
2^j words at a time by equal ranks of 2^j words; what it passes over is one
run. Of equal stretches the smallest period stays. Interval bounds come from
range minima; there are no tree nodes. A suffix is in O(log n) smaller parts,
so the work is O(n log n) numbers, in arrays.

Documents are independent: the job is map only, a slice holds about
``SLICE_CHARS`` characters (one longer text makes a slice of its own, with
memory for 4 * log2(longest repeat) + 100 bytes a word).

Defined results: a null, empty or blank text has no words and no runs; a null
id is kept as it is; repeated rows are treated row by row; an empty table gives
an empty one; further columns are ignored.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchlab.llm.chunks import ragged
from matchlab.llm.common import column, id_text, slices

WORD = re.compile("[^\x20\x09-\x0d]+")


def suffix_order(symbols: np.ndarray, ends: np.ndarray):
    """Suffix array, inverse, and ranks by words compared (1, 2, 4, ..) of
    ``symbols``, in which the entries at ``ends`` are unique."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    sizes = np.bincount(rank)
    # a rank is the place of its group's first suffix
    first = np.cumsum(sizes) - sizes
    rank = first[rank].astype(np.int32)
    levels, h = [rank], 1
    tied = np.flatnonzero(np.repeat(sizes, sizes) > 1)         # places in the order that aren't settled
    while len(tied):
        at = order[tied]
        key = rank[at].astype(np.int64) << 32 | rank[at + h]   # tied suffixes have h words at least before their end
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        begins = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(begins) - 1
        rank = rank.copy()
        rank[at] = tied[begins][group]
        levels.append(rank)
        tied = tied[np.bincount(group)[group] > 1]
        h *= 2
    return order, rank, levels


def common(levels: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of suffixes ``a`` and ``b`` (all a != b)."""
    a, b = a.copy(), b.copy()
    start = a.copy()
    for j in range(len(levels) - 1, -1, -1):
        same = levels[j][a] == levels[j][b]
        a[same] += 1 << j
        b[same] += 1 << j
    return a - start


def nearest_less(v: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the first place of the stretch before it with greater
    values, and the last place of the stretch behind it with values not less;
    ``longest``: a bound on these stretches."""
    n = len(v)
    tables = [v]
    while 1 << len(tables) <= longest:
        t, half = tables[-1], 1 << (len(tables) - 1)
        tables.append(np.minimum(t[:-half], t[half:]) if len(t) > half else t[:0])
    left = right = np.arange(n)
    for j in range(len(tables) - 1, -1, -1):
        t, w = tables[j], 1 << j
        if not len(t):
            continue
        lo = left - w
        left = np.where((lo >= 0) & (t[np.clip(lo, 0, len(t) - 1)] > v), lo, left)
        hi = right + 1
        right = np.where((hi + w <= n) & (t[np.clip(hi, 0, len(t) - 1)] >= v), right + w, right)
    return left, right


def squares(order, place, lcp, limit):
    """(start, period) of every branching tandem repeat: suffixes start and
    start + period share exactly ``period`` words. ``limit``: the greatest
    period to look at, by suffix."""
    splits = np.flatnonzero(lcp)
    if not len(splits):
        return order[:0], order[:0]
    # stretches of the LCP array without a zero are groups of suffixes with the same first word
    inner = lcp[splits]
    jump = np.flatnonzero(np.concatenate([[True], np.diff(splits) > 1]))
    longest = int(np.diff(np.append(jump, len(splits))).max())
    left, right = nearest_less(lcp, longest)
    use = inner <= limit[order[splits]]
    k = splits[use]
    d, lo, hi = lcp[k], left[k] - 1, right[k]
    small_left = k - lo <= hi - k + 1
    begin, size = np.where(small_left, lo, k), np.where(small_left, k - lo, hi - k + 1)
    other, most = np.where(small_left, k, lo), np.where(small_left, hi, k - 1)
    found = []
    block = np.cumsum(size) // (1 << 22)        # a bounded number of checks at once
    for b in range(int(block[-1]) + 1 if len(block) else 0):
        own = block == b
        i = order[ragged(begin[own], size[own])]
        depth, low, high = (np.repeat(x[own], size[own]) for x in (d, other, most))
        for start, partner in ((i, i + depth), (i - depth, i - depth)):
            at = place[np.clip(partner, 0, len(place) - 1)]
            hit = (partner >= 0) & (partner < len(place)) & (at >= low) & (at <= high)
            found.append((start[hit], depth[hit]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def runs_of(symbols: np.ndarray, ends: np.ndarray, least: int, exponent: int):
    """Starts, lengths and smallest periods of all runs of ``least`` symbols
    and ``exponent`` periods at least, by start and period. Symbols of
    different documents differ, and each document ends (``ends``) in a unique
    symbol of its own."""
    none = np.zeros(0, np.int64)
    if not len(symbols):
        return none, none, none
    order, place, levels = suffix_order(symbols, ends)
    lcp = np.zeros(len(symbols), np.int64)
    tied = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    lcp[tied] = common(levels, order[tied - 1], order[tied])
    sizes = np.diff(np.concatenate([[-1], ends]))
    limit = np.repeat(sizes // exponent, sizes)
    start, period = squares(order, place, lcp, limit)
    stop = start + 2 * period
    begin = start.copy()
    for j in range(len(levels) - 1, -1, -1):        # rotate left
        a = begin - (1 << j)
        ok = a >= 0
        ok[ok] = levels[j][a[ok]] == levels[j][a[ok] + period[ok]]
        begin[ok] -= 1 << j
    length = stop - begin
    long = (length >= least) & (length >= exponent * period)
    begin, length, period = begin[long], length[long], period[long]
    by = np.lexsort((period, length, begin))
    begin, length, period = begin[by], length[by], period[by]
    new = np.ones(len(begin), bool)
    new[1:] = (np.diff(begin) != 0) | (np.diff(length) != 0)        # the smallest period of equal stretches
    begin, length, period = begin[new], length[new], period[new]
    by = np.lexsort((period, begin))
    return begin[by], length[by], period[by]


def number(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of documents' words, and where each document's end symbol is."""
    lists, base = [], 0
    for own in words:
        index: dict[str, int] = {}
        lists.append([base + index.setdefault(w, len(index)) for w in own])
        base += len(index) + 1
        lists.append((base - 1,))
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), np.cumsum(sizes) - 1


def find_runs(df: DataFrame, least: int = 6, exponent: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (array of start, length, period, in
    words, by start and period) and ``collapsed``: the text's words, without
    those that a run holds after its first period, joined by one space. A run
    is a stretch of at least ``least`` words and ``exponent`` smallest periods
    that no neighbouring word continues."""
    schema = f"doc_id {dict(df.dtypes)[id_col]}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"

    def work(batches):
        for part in slices(batches):
            words = [WORD.findall(t) for t in column(part, "text").to_pylist()]
            symbols, ends = number(words)
            begin, length, period = runs_of(symbols, ends, least, exponent)
            starts = np.concatenate([[0], ends + 1]).astype(np.int64)
            owner = np.searchsorted(starts, begin, side="right") - 1
            delta = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(delta, begin + period, 1)
            np.add.at(delta, begin + length, -1)
            gone = np.cumsum(delta) > 0
            touched = set(owner.tolist())
            kept = [" ".join([w for w, g in zip(own, gone[starts[k]:].tolist()) if not g] if k in touched else own)
                    for k, own in enumerate(words)]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))]).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (begin - starts[owner], length, period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), spans), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    return id_text(df, id_col=id_col, text_col=text_col).mapInArrow(work, schema)


def periodic_tails(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text``: with h = crc32(id as text), n words, g = h // 10 and
    h % 10 = 0, the words from a = g % n on repeat with period
    1 + (n - a) // (3 + g % 8); such a text's words are joined by one space.
    Other texts stay as they are, and so do texts without words or with a null id."""
    h = F.crc32(df[id_col].cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split(F.coalesce(df[text_col], F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    t = id_text(df, h.alias("h"), words.alias("w"), id_col=id_col, text_col=text_col)
    t = t.select("doc_id", "text", "w", F.size("w").alias("n"), F.floor(F.col("h") / 10).alias("g"))
    t = t.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    t = t.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    tail = F.expr("concat_ws(' ', slice(w, 1, CAST(a + p AS INT)), transform(sequence(a + p, greatest(n - 1, a + p)), i -> IF(i < n, w[CAST(a + (i - a) % p AS INT)], NULL)))")
    return t.select("doc_id", F.when(F.col("n") > 0, tail).otherwise(F.col("text")).alias("text"))


def run_digests(df: DataFrame) -> DataFrame:
    """The runs of documents with periodic tails, as digests."""
    found = find_runs(periodic_tails(df))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))))
    t = found.select("*", top.alias("top"))
    length, period = F.col("top.length"), -F.col("top.p")
    return t.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.s")).alias("start"), length.alias("length"),
                    period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
