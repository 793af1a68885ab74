"""Exact order statistics of many columns without sorting or shuffling rows.

The value at a rank is looked for in an interval of the doubles' order. A pass
over the table counts, for all columns at once, the values in each of 1,024
equal parts of every interval; the part that holds the rank is the next interval. A
rank is found when its part holds a single value, at the latest after seven
passes. A task sends counts only: at most (columns * ranks * 1,024) rows, whatever
the number of rows and of distinct values.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchlab.session import discard, importable, materialize

PARTS = 1 << 10
_FLIP = np.int64(0x7FFFFFFFFFFFFFFF)


def keys_of(x: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles (NaN last, as Spark sorts them; -0.0 is 0.0)."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.int64)
    return bits ^ ((bits >> np.int64(63)) & _FLIP)


def value_of(key: int) -> float:
    k = np.int64(key)
    return float(np.array([k ^ ((k >> np.int64(63)) & _FLIP)]).view(np.float64)[0])


def _count(keys: np.ndarray, lo: int, hi: int, step: int) -> tuple:
    """Parts with values, how many, the least and the greatest of each."""
    own = keys[(keys >= lo) & (keys <= hi)]
    part = ((own.astype(np.uint64) - np.uint64(lo % (1 << 64))) // np.uint64(step)).astype(np.int64)
    n = np.bincount(part, minlength=PARTS)
    least, most = np.full(PARTS, _FLIP), np.full(PARTS, -_FLIP - 1)
    np.minimum.at(least, part, own)
    np.maximum.at(most, part, own)
    seen = np.flatnonzero(n)
    return seen, n[seen], least[seen], most[seen]


def exact_ranks(df: DataFrame, cols: list[str], ranks_of: Callable[[int], list[int]]) -> dict[str, tuple[int, dict[int, float]]]:
    """For each column (as doubles) its number of values that aren't null, n, and
    the values at the ranks ``ranks_of(n)`` (from 1, ascending)."""
    importable(df.sparkSession)
    rows = materialize(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]), "selection")
    try:
        first = rows.agg(*[F.count(f"c{i}") for i in range(len(cols))]).first()
        found = {c: (first[i], {}) for i, c in enumerate(cols)}
        everything = (-(1 << 63), (1 << 63) - 1)
        open_ = {(i, r): (*everything, r) for i, c in enumerate(cols) if first[i] for r in ranks_of(first[i])}     # interval, rank in it
        while open_:
            spans = sorted({(i, lo, hi) for (i, _), (lo, hi, _) in open_.items()})
            counts = _pass(rows, spans)
            for (i, r), (lo, hi, rank) in list(open_.items()):
                for part, n, least, most in counts[spans.index((i, lo, hi))]:
                    if rank <= n:
                        break
                    rank -= n
                if least == most:
                    found[cols[i]][1][r] = value_of(least)
                    del open_[i, r]
                else:
                    open_[i, r] = (least, most, rank)
        return found
    finally:
        discard(rows)


def _pass(rows: DataFrame, spans: list[tuple[int, int, int]]) -> list[list[tuple]]:
    """For each interval its parts in order: (part, count, least key, greatest key)."""
    steps = [-(-(hi - lo + 1) // PARTS) for _, lo, hi in spans]

    def work(batches):
        for b in batches:
            keys, out = {}, []
            for s, ((i, lo, hi), step) in enumerate(zip(spans, steps)):
                if i not in keys:
                    keys[i] = keys_of(b.column(i).drop_null().to_numpy(zero_copy_only=False))
                part, n, least, most = _count(keys[i], lo, hi, step)
                out.append((np.full(len(part), s), part, n, least, most))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)], ["span", "part", "n", "least", "most"])

    sums = rows.mapInArrow(work, "span bigint, part bigint, n bigint, least bigint, most bigint").groupBy("span", "part").agg(
        F.sum("n"), F.min("least"), F.max("most"))
    out = [[] for _ in spans]
    for span, *rest in sorted(map(tuple, sums.collect())):
        out[span].append(tuple(rest))
    return out
