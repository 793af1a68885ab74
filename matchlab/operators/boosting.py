"""Boosted trees for several classes at once (softmax loss), grown on
histograms that Spark sums.

Features become bins (cuts at exact quantiles). A round grows one tree a class,
all of them level by level: one pass over the rows a level adds up gradients
and hessians per (class, node, feature, bin) in every task, and one grouped sum
over the tasks gives the histograms, at most classes * 2^(depth-1) * features *
bins cells whatever the number of rows. The driver picks the splits from them.
A row's scores are carried from round to round: they are written every
``stride`` rounds, and in between the trees since then are added on the fly. The
first pass of a round also adds up the loss of the validation rows, so stopping
costs no pass of its own.

Gradients are summed as integers (multiples of 2^-24), so sums, and with them
the model, don't depend on the order or number of tasks. Row samples are taken by
hash of the id.

Split gain and leaf weights are the usual second-order ones:
``(GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)) / 2 - gamma``, both children with
``H >= min_child_weight``; a node is split if the best gain is positive (ties:
first feature, then lowest cut); a leaf's weight is ``-rate * G / (H + l)``.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchlab.operators.skew import running_total
from matchlab.session import discard, importable, materialize, materialize_counted

UNIT = float(1 << 24)
#: Rows of the training table that a partition holds about.
PARTITION_ROWS = 50_000


@dataclass(frozen=True)
class Params:
    rounds: int = 300
    max_depth: int = 4
    rate: float = 0.05
    subsample: float = 0.8
    colsample: float = 0.8
    min_child_weight: float = 3.0
    gamma: float = 0.1
    reg_lambda: float = 1.0
    patience: int = 20
    bins: int = 64
    classes: int = 3
    seed: int = 42
    stride: int = 16


@dataclass
class Tree:
    """Node i's children are 2i+1 (bin <= cut) and 2i+2; feature -1: a leaf."""
    feature: list
    cut: list
    value: list
    gain: list

    @classmethod
    def root(cls, depth: int):
        n = 2 ** (depth + 1) - 1
        return cls([-1] * n, [0] * n, [0.0] * n, [0.0] * n)


def nodes_of(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The node that each row of ``bins`` ends in. Whole columns are compared,
    once an inner node; columns that lie in one piece (Fortran order) are fastest."""
    kind = np.min_scalar_type(len(tree.feature)).type

    def end(i):
        if tree.feature[i] < 0:
            return kind(i)
        left, right = end(2 * i + 1), end(2 * i + 2)
        goes_right = np.negative((bins[:, tree.feature[i]] > tree.cut[i]).astype(kind))      # all bits or none
        return left ^ (goes_right & (left ^ right))

    return np.broadcast_to(end(0), len(bins))


def add_scores(trees: list, bins: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Scores after the rounds in ``trees``, added one after the other."""
    scores = scores.copy(order="K")
    for own in trees:
        for k, t in enumerate(own):
            scores[:, k] += np.array(t.value)[nodes_of(t, bins)]
    return scores


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sampled(ids: np.ndarray, turn: int, p: Params) -> np.ndarray:
    """Rows that a round trains on: by a hash of id, round and seed."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((p.seed * 1_000_003 + turn) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).astype(np.float64) < p.subsample * 2.0**64


def columns_of(turn: int, k: int, n: int, p: Params) -> list[int]:
    """Features that a tree may split on."""
    take = max(1, round(p.colsample * n))
    return sorted(np.random.default_rng([p.seed, turn, k]).permutation(n)[:take].tolist())


class Histogram:
    """One task's sums: gradients and hessians per cell (class, node, feature,
    bin), and the loss of the validation rows (in the first pass of a round)."""

    def __init__(self, since: list, growing: list, level: int, turn: int, n_features: int, p: Params):
        self.since, self.growing, self.level, self.turn, self.p = since, growing, level, turn, p
        self.g, self.h = np.zeros((2, p.classes, 2**level, n_features, p.bins), np.int64)
        self.loss, self.held = 0, 0

    def add(self, ids, labels, held, bins, scores) -> None:
        p, width = self.p, 2**self.level
        use = ~held & sampled(ids, self.turn, p)
        if self.level == 0 and held.any():
            prob = softmax(add_scores(self.since, pick(bins, held), pick(scores, held)))
            loss = -np.log(np.maximum(prob[np.arange(len(prob)), labels[held]], 1e-15))
            self.loss += int(np.rint(loss * UNIT).sum())
            self.held += len(loss)
        bins, labels = pick(bins, use), labels[use]
        prob = softmax(add_scores(self.since, bins, pick(scores, use)))
        for k in range(p.classes):
            at, q, own, label = np.zeros(len(bins), np.intp), prob[:, k], bins, labels
            if self.level:
                at = nodes_of(self.growing[k], bins).astype(np.intp) - (width - 1)
                inside = at >= 0
                if not inside.all():
                    at, q, own, label = at[inside], q[inside], pick(bins, inside), labels[inside]
            at *= p.bins
            g = np.rint((q - (label == k)) * UNIT)
            h = np.rint(np.maximum(2 * q * (1 - q), 1e-16) * UNIT)
            for f in columns_of(self.turn, k, bins.shape[1], p):
                cell = at + own[:, f]
                self.g[k, :, f] += np.bincount(cell, g, width * p.bins).astype(np.int64).reshape(width, p.bins)
                self.h[k, :, f] += np.bincount(cell, h, width * p.bins).astype(np.int64).reshape(width, p.bins)

    def rows(self) -> tuple:
        """cell, gradients, hessians; cell -1 has the validation rows' loss and number."""
        g, h = self.g.ravel(), self.h.ravel()
        found = np.flatnonzero((g != 0) | (h != 0))
        if not self.held:
            return found, g[found], h[found]
        return tuple(np.concatenate([[x], y]) for x, y in ((-1, found), (self.loss, g[found]), (self.held, h[found])))


def pick(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Those rows, every column in one piece."""
    return x.T.compress(rows, axis=1).T


def grow(growing: list, level: int, turn: int, sums: tuple, n_features: int, p: Params) -> bool:
    """Splits the nodes of a level by the summed histograms; False: none was split."""
    width, first, any_split = 2**level, 2**level - 1, False
    shape = (p.classes, width, n_features, p.bins)
    g, h = np.zeros(shape), np.zeros(shape)
    cells, gs, hs = sums
    own = cells >= 0
    g.ravel()[cells[own]], h.ravel()[cells[own]] = gs[own] / UNIT, hs[own] / UNIT
    for k, tree in enumerate(growing):
        use = columns_of(turn, k, n_features, p)
        for node in range(width):
            gn, hn = g[k, node][use], h[k, node][use]
            gt, ht = gn[0].sum(), hn[0].sum()
            if level == 0:
                tree.value[0] = -p.rate * gt / (ht + p.reg_lambda)
            gl, hl = gn.cumsum(axis=1)[:, :-1], hn.cumsum(axis=1)[:, :-1]
            gr, hr = gt - gl, ht - hl
            gain = (gl**2 / (hl + p.reg_lambda) + gr**2 / (hr + p.reg_lambda) - gt**2 / (ht + p.reg_lambda)) / 2 - p.gamma
            gain[(hl < p.min_child_weight) | (hr < p.min_child_weight)] = -np.inf
            gain = np.round(gain, 9)        # ties up to float error go to the first
            f, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
            if not gain[f, cut] > 0:
                continue
            any_split, i = True, first + node
            tree.feature[i], tree.cut[i], tree.gain[i] = use[f], int(cut), float(gain[f, cut])
            for child, gc, hc in ((2 * i + 1, gl[f, cut], hl[f, cut]), (2 * i + 2, gr[f, cut], hr[f, cut])):
                tree.value[child] = -p.rate * gc / (hc + p.reg_lambda)
    return any_split


class Patience:
    """Best round so far, and whether ``patience`` rounds in a row brought no smaller loss."""

    def __init__(self, patience: int):
        self.patience, self.losses = patience, []

    def add(self, loss: float) -> bool:
        self.losses.append(loss)
        return len(self.losses) - self.best >= self.patience

    @property
    def best(self) -> int:
        return int(np.argmin(self.losses)) + 1 if self.losses else 0


@dataclass
class Booster:
    """A fitted ensemble; ``transform`` adds ``probability`` and ``prediction``."""
    settings: ClassVar = Params
    columns: list
    cuts: list
    trees: list
    params: Params = field(default_factory=Params)
    fill: dict = field(default_factory=dict)
    losses: list = field(default_factory=list)

    @property
    def best_iteration(self) -> int:
        return len(self.trees)

    def bins(self, values: np.ndarray) -> np.ndarray:
        out = np.empty((len(values), len(self.cuts)), np.uint8, order="F")
        for i, c in enumerate(self.cuts):
            out[:, i] = np.searchsorted(c, values[:, i], side="left")
        return out

    def probabilities(self, values: np.ndarray) -> np.ndarray:
        return softmax(add_scores(self.trees, self.bins(values), np.zeros((len(values), self.params.classes), order="F")))

    def transform(self, df: DataFrame) -> DataFrame:
        importable(df.sparkSession)
        model = df.sparkSession.sparkContext.broadcast(self)        # rounds * classes trees of 2^(depth+1) nodes

        @F.pandas_udf("array<double>")
        def score(*values):
            import pandas as pd
            return pd.Series(list(np.ascontiguousarray(model.value.probabilities(np.stack([v.to_numpy(np.float64) for v in values], axis=1)))))

        filled = [F.coalesce(F.col(c).cast("double"), F.lit(float(self.fill.get(c, 0.0)))) for c in self.columns]
        out = df.withColumn("_p", score(*filled))
        best = F.array_position("_p", F.array_max("_p")) - 1
        return out.select(*df.columns, array_to_vector("_p").alias("probability"), best.cast("double").alias("prediction"))

    def importance(self) -> list[tuple]:
        """(feature, mean gain of its splits, number of its splits) for every feature."""
        gains = [[] for _ in self.columns]
        for own in self.trees:
            for t in own:
                for f, x in zip(t.feature, t.gain):
                    if f >= 0:
                        gains[f].append(x)
        return [(c, float(np.mean(x)) if x else 0.0, len(x)) for c, x in zip(self.columns, gains)]

    def save(self, path: str, spark: SparkSession) -> None:
        text = json.dumps({"columns": self.columns, "cuts": [list(map(float, c)) for c in self.cuts], "params": asdict(self.params), "fill": self.fill,
                           "losses": self.losses, "trees": [[asdict(t) for t in own] for own in self.trees]})
        spark.createDataFrame([(text,)], "model string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark: SparkSession):
        d = json.loads(spark.read.parquet(path).first()["model"])
        return cls(d["columns"], [np.array(c) for c in d["cuts"]], [[Tree(**t) for t in own] for own in d["trees"]],
                   cls.settings(**d["params"]), d["fill"], d["losses"])


def quantile_cuts(df: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 cuts a column: the greatest values of ``bins`` parts of
    about equal numbers of rows. Values are counted before they are ranked."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])))
    counts = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("k"))
    total = counts.groupBy("c").agg(F.sum("k").alias("n"))
    ranked = running_total(counts, ["c"], "v", "k", "upto").join(total, "c")
    part = F.floor((F.col("upto") - 1) * bins / F.col("n"))
    found = {}
    for r in ranked.groupBy("c", part.alias("part")).agg(F.max("v").alias("v")).collect():      # columns * bins rows at most
        found.setdefault(r["c"], []).append(r["v"])
    return [np.array(sorted(found.get(c, []))[:-1], np.float64) for c in columns]


def fit(train: DataFrame, columns: list[str], held: Column, p: Params = Params(), label: str = "label", id_col: str = "match_id",
        fill: dict | None = None) -> Booster:
    """Trees for ``label`` (0 .. classes - 1) from ``columns`` (nulls: ``fill``,
    else 0). ``held`` marks validation rows; their mean log loss ends training
    when ``patience`` rounds in a row brought no smaller one, and the rounds up
    to the best stay. Without validation rows all rounds are grown."""
    if not 2 <= p.bins <= 256:
        raise ValueError("2 to 256 bins")
    importable(train.sparkSession)
    fill = dict(fill or {})
    values = [F.coalesce(F.col(c).cast("double"), F.lit(float(fill.get(c, 0.0)))).alias(c) for c in columns]
    rows, n = materialize_counted(train.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label).cast("int").alias("_label"),
                                               F.coalesce(held, F.lit(False)).alias("_held"), *values), "boosting")
    model = Booster(list(columns), quantile_cuts(rows.where("NOT _held"), columns, p.bins), [], p, fill)
    bare = Booster(model.columns, model.cuts, [], p)

    def binned(batches):
        for b in batches:
            x = bare.bins(np.stack([b.column(3 + i).to_numpy(zero_copy_only=False) for i in range(len(columns))], axis=1))
            zeros = np.zeros((b.num_rows, p.classes))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), _packed(x), _packed(zeros)], names)

    names = ["_id", "_label", "_held", "_bins", "_scores"]
    schema = "_id bigint, _label int, _held boolean, _bins binary, _scores binary"
    state = materialize(rows.repartition(max(1, -(-n // PARTITION_ROWS)), "_id").mapInArrow(binned, schema), "boosting")
    discard(rows)
    try:
        _rounds(model, state, p)
    finally:
        discard(model.__dict__.pop("state", state))
    return model


def _packed(x: np.ndarray) -> pa.Array:
    """A matrix as binary values, one a row."""
    x = np.ascontiguousarray(x)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.strides[0]), len(x), [None, pa.py_buffer(x)]).cast(pa.binary())


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    """The inverse of ``_packed``, every column in one piece."""
    x = column.cast(pa.binary(width * np.dtype(kind).itemsize))
    return np.asfortranarray(np.frombuffer(x.buffers()[1], kind)[x.offset * width:][:len(x) * width].reshape(-1, width))


def _arrays(b: pa.RecordBatch, p: Params, n_features: int):
    return (b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False),
            _matrix(b.column(3), np.uint8, n_features), _matrix(b.column(4), np.float64, p.classes))


def _rounds(model: Booster, state: DataFrame, p: Params) -> None:
    n_features, written, stop = len(model.columns), 0, Patience(p.patience)
    model.state = state

    def cells(growing, level, turn):
        since = model.trees[written:]

        def work(batches):
            own = Histogram(since, growing, level, turn, n_features, p)
            for b in batches:
                if b.num_rows:
                    own.add(*_arrays(b, p, n_features))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in own.rows()], ["cell", "g", "h"])

        sums = model.state.mapInArrow(work, "cell bigint, g bigint, h bigint").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        return tuple(sums[c].to_numpy() for c in ("cell", "g", "h"))

    for turn in range(p.rounds + 1):
        growing = [Tree.root(p.max_depth) for _ in range(p.classes)]
        first = cells(growing, 0, turn)
        loss = np.flatnonzero(first[0] == -1)
        if turn and len(loss) and stop.add(int(first[1][loss[0]]) / UNIT / int(first[2][loss[0]])):
            break
        if turn == p.rounds:
            break
        split = grow(growing, 0, turn, first, n_features, p)
        for level in range(1, p.max_depth):
            if not split:
                break
            split = grow(growing, level, turn, cells(growing, level, turn), n_features, p)
        model.trees.append(growing)
        if len(model.trees) - written == p.stride:
            since, old = model.trees[written:], model.state

            def carry(batches):
                for b in batches:
                    _, _, _, bins, scores = _arrays(b, p, n_features)
                    yield pa.RecordBatch.from_arrays([*b.columns[:4], _packed(add_scores(since, bins, scores))], b.schema.names)

            model.state = materialize(old.mapInArrow(carry, old.schema), "boosting")
            discard(old)
            written = len(model.trees)
    model.losses = stop.losses
    if stop.losses:
        del model.trees[stop.best:]
