"""A random forest for several classes, grown on histograms that Spark sums.

Features become bins (cuts at exact quantiles of all rows). All trees grow level
by level: one pass over the rows a level adds up class counts per (tree, node,
feature, bin) in every task, tasks by tree add these up and pick each node's
split, and only the splits reach the driver. A task's sums are at most trees *
2^(depth-1) * features * bins * classes cells whatever the number of rows, and
partitions grow with the table up to ``PARTITION_ROWS`` rows.

Every tree counts each row a Poisson number of times (mean ``subsample``), by a
hash of the row and the tree, so the model is the same on any layout; rows equal
in everything are drawn together. A node may split on ``colsample`` of the
features (rounded up). A split has the greatest Gini gain (ties: first feature,
then lowest cut) with at least ``min_instances`` counts on both sides; siblings
that are leaves of the same class become one leaf again. A row's probabilities
are the mean of its leaves' class shares. Rows without a label take no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchlab.operators.boosting import Booster, Tree, _matrix, _packed, nodes_of, quantile_cuts
from matchlab.session import discard, importable, materialize, materialize_counted

#: Rows of a partition: at least, unless that makes fewer than ``LEAST`` of them, and at most about.
SMALL_ROWS, PARTITION_ROWS, LEAST = 10_000, 500_000, 32
#: Rows that are counted at once, so that their cells stay in the cache.
BLOCK = 1 << 14


@dataclass(frozen=True)
class Params:
    trees: int = 300
    max_depth: int = 4
    subsample: float = 0.8
    colsample: float = 0.8
    min_instances: int = 3
    min_gain: float = 0.0
    bins: int = 32
    classes: int = 3
    seed: int = 42


@dataclass
class Forest(Booster):
    """A fitted forest: a list of one tree each, whose values are class counts."""
    settings: ClassVar = Params
    params: Params = field(default_factory=Params)

    def probabilities(self, values: np.ndarray) -> np.ndarray:
        bins = self.bins(values)
        votes = np.zeros((len(bins), self.params.classes))
        for tree, in self.trees:
            counts = np.array(tree.value, float)
            sums = counts.sum(axis=1, keepdims=True)
            votes += (counts / np.maximum(sums, 1))[nodes_of(tree, bins)]
        return votes / np.maximum(votes.sum(axis=1, keepdims=True), 1e-300)


def poisson_table(mean: float) -> np.ndarray:
    """The count of every 16-bit number, taken as a share of 2^16."""
    p = [math.exp(-mean)]
    while len(p) < 32:
        p.append(p[-1] * mean / len(p))
    return np.searchsorted(np.cumsum(p), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def lanes(keys: np.ndarray, turn: int, seed: int) -> np.ndarray:
    """Four 16-bit numbers a row, for the trees 4 * ``turn`` to 4 * ``turn`` + 3."""
    x = keys + np.uint64((seed * 1_000_003 + turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).astype("<u8").view("<u2").reshape(-1, 4)


def columns_of(tree: int, node: int, n: int, p: Params) -> list[int]:
    """Features that a node may split on."""
    take = min(n, max(1, math.ceil(round(p.colsample * n, 9))))
    return sorted(np.random.default_rng([p.seed, tree, node]).permutation(n)[:take].tolist())


class Histogram:
    """One task's class counts: for every open tree (node, feature, bin, class)."""

    def __init__(self, trees: list, open_: list, level: int, n_features: int, p: Params):
        self.trees, self.open, self.level, self.p = trees, open_, level, p
        self.cells = n_features * p.bins * p.classes
        self.sums = {t: np.zeros(2**level * self.cells, np.int64) for t in open_}
        self.table = poisson_table(p.subsample)

    def add(self, keys: np.ndarray, labels: np.ndarray, bins: np.ndarray) -> None:
        p, first = self.p, 2**self.level - 1
        offsets = np.arange(bins.shape[1], dtype=np.intp) * (p.bins * p.classes)
        codes = np.ascontiguousarray((bins.astype(np.intp) * p.classes + labels[:, None] + offsets).T)
        turn, drawn = None, None
        for t in self.open:
            if t // 4 != turn:
                turn, drawn = t // 4, lanes(keys, t // 4, p.seed)
            times = self.table[drawn[:, t % 4]]
            at = nodes_of(self.trees[t][0], bins).astype(np.intp) - first if self.level else np.zeros(len(bins), np.intp)
            cell = codes + np.maximum(at, 0) * self.cells if self.level else codes
            times = np.where(at >= 0, times, 0).astype(np.float64)
            self.sums[t] += np.bincount(cell.ravel(), np.broadcast_to(times, cell.shape).ravel(), len(self.sums[t])).astype(np.int64)


def best_splits(tree: int, sums: np.ndarray, level: int, n_features: int, p: Params) -> list[tuple]:
    """(tree, node, feature, cut, gain, class counts, class counts left) of every
    node of the level that has rows; feature -1: it stays a leaf."""
    sums = sums.reshape(2**level, n_features, p.bins, p.classes)

    def gini(x, n):
        return 1 - ((x / np.maximum(n, 1)[..., None])**2).sum(axis=-1)

    out = []
    for k, own in enumerate(sums):
        node, total = 2**level - 1 + k, own[0].sum(axis=0)
        n = total.sum()
        if not n:
            continue
        use = columns_of(tree, node, n_features, p)
        left = own[use].cumsum(axis=1)[:, :-1]
        right = total - left
        nl, nr = left.sum(axis=-1), right.sum(axis=-1)
        gain = np.round(gini(total, n) - nl / n * gini(left, nl) - nr / n * gini(right, nr), 12)      # ties up to float error go to the first
        gain[(nl < p.min_instances) | (nr < p.min_instances)] = -np.inf
        f, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
        split = gain[f, cut] > 0 and gain[f, cut] >= p.min_gain
        out.append((tree, node, use[f] if split else -1, int(cut), float(gain[f, cut]) if split else 0.0, total.tolist(), left[f, cut].tolist()))
    return out


def prune(tree: Tree, i: int = 0) -> None:
    """Leaves of the same class below one node become one leaf."""
    if tree.feature[i] < 0:
        return
    kids = 2 * i + 1, 2 * i + 2
    for c in kids:
        prune(tree, c)
    if all(tree.feature[c] < 0 for c in kids) and len({int(np.argmax(tree.value[c])) for c in kids}) == 1:
        tree.feature[i], tree.cut[i], tree.gain[i] = -1, 0, 0.0


def fit(train: DataFrame, columns: list[str], p: Params = Params(), label: str = "label", id_col: str = "match_id", fill: dict | None = None) -> Forest:
    """Trees for ``label`` (0 .. classes - 1) from ``columns`` (nulls: ``fill``, else 0), on all labelled rows."""
    if not 2 <= p.bins <= 256:
        raise ValueError("2 to 256 bins")
    importable(train.sparkSession)
    fill = dict(fill or {})
    values = [F.coalesce(F.col(c).cast("double"), F.lit(float(fill.get(c, 0.0)))).alias(c) for c in columns]
    labelled = train.where(F.col(label).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"), *values)
    rows, n = materialize_counted(labelled.select(F.xxhash64("_id", "_label", *columns).alias("_key"), "_label", *columns), "forest")
    if not n:
        discard(rows)
        raise ValueError("no labelled rows to fit on")
    model = Forest(list(columns), quantile_cuts(rows, columns, p.bins), [[Tree.root(p.max_depth)] for _ in range(p.trees)], p, fill)
    bare = Forest(model.columns, model.cuts, [], p)

    def binned(batches):
        for b in batches:
            x = bare.bins(np.stack([b.column(2 + i).to_numpy(zero_copy_only=False) for i in range(len(columns))], axis=1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _packed(x)], ["_key", "_label", "_bins"])

    parts = max(min(-(-n // SMALL_ROWS), LEAST), -(-n // PARTITION_ROWS))
    state = materialize(rows.repartition(parts, "_key").mapInArrow(binned, "_key bigint, _label int, _bins binary"), "forest")
    discard(rows)
    try:
        open_ = list(range(p.trees))
        for level in range(p.max_depth):
            open_ = _level(model, state, open_, level, parts)
            if not open_:
                break
    finally:
        discard(state)
    for tree, in model.trees:
        tree.value = [x or [0] * p.classes for x in tree.value]
        prune(tree)
    return model


def _level(model: Forest, state: DataFrame, open_: list, level: int, parts: int) -> list:
    """Splits the nodes of a level; the trees in which one was split."""
    p, n_features = model.params, len(model.columns)
    trees = state.sparkSession.sparkContext.broadcast(model.trees)     # trees of 2^(depth+1) nodes

    def count(batches):
        own = Histogram(trees.value, open_, level, n_features, p)
        for b in batches:
            for k in range(0, b.num_rows, BLOCK):
                x = b.slice(k, BLOCK)
                own.add(x.column(0).to_numpy().view(np.uint64), x.column(1).to_numpy(), _matrix(x.column(2), np.uint8, n_features))
        for t, sums in own.sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["tree", "sums"])

    def best(batches):
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for t, sums in zip(b.column(0).to_pylist(), b.column(1)):
                sums = np.frombuffer(sums.as_buffer(), np.int64)
                found[t] = found[t] + sums if t in found else sums
        rows = [r for t, sums in found.items() for r in best_splits(t, sums, level, n_features, p)]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["tree", "node", "feature", "cut", "gain", "total", "left"])

    sums = state.mapInArrow(count, "tree int, sums binary").repartition(min(parts, p.trees), "tree")
    split = set()
    for r in sums.mapInArrow(best, "tree int, node int, feature int, cut int, gain double, total array<bigint>, left array<bigint>").collect():     # trees * 2^level rows at most
        tree = model.trees[r.tree][0]
        tree.value[r.node] = list(r.total)
        if r.feature >= 0:
            split.add(r.tree)
            tree.feature[r.node], tree.cut[r.node], tree.gain[r.node] = r.feature, r.cut, r.gain
            tree.value[2 * r.node + 1], tree.value[2 * r.node + 2] = list(r.left), [x - y for x, y in zip(r.total, r.left)]
    trees.destroy()
    return sorted(split)
