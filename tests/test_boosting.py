"""Three-class boosting on summed histograms against a booster that looks at rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from match_cases import rows
from matchlab.config import NOTEBOOK
from matchlab.operators import boosting, ml
from matchlab.operators.boosting import Params, Patience, columns_of, quantile_cuts, sampled, softmax
from matchlab.schemas import FEATURE_COLS
from matchlab.session import scratch_path

COLS = ["a", "b", "c", "d"]


def table(spark, n=500, seed=3, noise=False):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = rng.integers(0, 3, n) if noise else (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(int) + (x[:, 3] + rng.normal(size=n) * .3 > .5)
    ids = rng.permutation(n * 7)[:n]
    held = ids % 5 == 0
    df = spark.createDataFrame([(int(i), float(k), bool(h), *map(float, v)) for i, k, h, v in zip(ids, y, held, x)],
                               "match_id bigint, label double, held boolean, " + ", ".join(f"{c} double" for c in COLS))
    return df, x, y, ids, held


def brute(x, y, ids, held, cuts, p):
    """Every split of every node tried on the rows themselves."""
    scores, rounds, losses = np.zeros((len(x), p.classes)), [], []
    for turn in range(p.rounds):
        prob, trees = softmax(scores), []
        for k in range(p.classes):
            use = ~held & sampled(ids, turn, p)
            g, h = prob[:, k] - (y == k), np.maximum(2 * prob[:, k] * (1 - prob[:, k]), 1e-16)
            splits, add = [], np.zeros(len(x))

            def node(mask, level):
                own = mask & use
                gt, ht = g[own].sum(), h[own].sum()
                best = None
                if level < p.max_depth:
                    for f in columns_of(turn, k, x.shape[1], p):
                        for c in cuts[f]:
                            left = own & (x[:, f] <= c)
                            gl, hl = g[left].sum(), h[left].sum()
                            if hl >= p.min_child_weight and ht - hl >= p.min_child_weight:
                                gain = (gl**2 / (hl + p.reg_lambda) + (gt - gl)**2 / (ht - hl + p.reg_lambda) - gt**2 / (ht + p.reg_lambda)) / 2 - p.gamma
                                if gain > 1e-7 and (best is None or gain > best[0] + 1e-5):
                                    best = gain, f, c
                if best is None:
                    add[mask] = -p.rate * gt / (ht + p.reg_lambda)
                    return
                splits.append((level, best[1], float(best[2]), round(best[0], 3)))
                node(mask & (x[:, best[1]] <= best[2]), level + 1)
                node(mask & (x[:, best[1]] > best[2]), level + 1)

            node(np.ones(len(x), bool), 0)
            trees.append(splits)
            scores[:, k] += add
        rounds.append(trees)
        losses.append(-np.log(softmax(scores)[held, y[held]]).mean())
    return rounds, losses, softmax(scores)


def shape(model):
    """The splits of every tree, depth first."""
    def walk(t, i, level):
        if t.feature[i] < 0:
            return []
        return [(level, t.feature[i], float(model.cuts[t.feature[i]][t.cut[i]]), round(t.gain[i], 3))] + walk(t, 2 * i + 1, level + 1) + walk(t, 2 * i + 2, level + 1)
    return [[walk(t, 0, 0) for t in own] for own in model.trees]


@pytest.mark.parametrize("p", [Params(rounds=3, max_depth=3, rate=.5, subsample=1.0, colsample=1.0, gamma=.05, bins=16, patience=99),
                               Params(rounds=5, max_depth=2, rate=.3, subsample=.7, colsample=.5, min_child_weight=8, bins=8, stride=2, patience=99)])
def test_equals_a_booster_on_rows(spark, p):
    df, x, y, ids, held = table(spark)
    model = boosting.fit(df.repartition(3), COLS, F.col("held"), p)
    rounds, losses, prob = brute(x, y, ids, held, model.cuts, p)
    n = len(model.trees)
    assert shape(model) == rounds[:n]
    assert np.allclose(model.losses, losses, atol=1e-5) and n == int(np.argmin(losses)) + 1
    if n == p.rounds:
        assert np.allclose(model.probabilities(x), prob, atol=1e-5)


def test_same_model_on_any_layout(spark):
    df, *_ = table(spark)
    p = Params(rounds=3, max_depth=3, rate=.5)
    a, b = (boosting.fit(d, COLS, F.col("held"), p) for d in (df.coalesce(1), df.repartition(7, "label")))
    assert a.trees == b.trees and a.losses == b.losses


def test_stops_within_patience(spark):
    df, *_ = table(spark, noise=True)
    model = boosting.fit(df, COLS, F.col("held"), Params(rounds=40, max_depth=2, rate=.8, patience=3, min_child_weight=1, gamma=0.0))
    assert len(model.losses) == model.best_iteration + 3 < 40
    assert model.losses[model.best_iteration - 1] == min(model.losses)


def test_patience():
    def grown(losses, patience):
        stop = Patience(patience)
        n = next((n for n, x in enumerate(losses, 1) if stop.add(x)), len(losses))
        return n, stop.best
    assert grown([5, 4, 3, 3.5, 3.2, 3.1, 2.0], 3) == (6, 3)
    assert grown([5, 4, 3, 3.5, 3.2, 3.1, 2.0], 5) == (7, 7)
    assert grown([1.0, 2.0], 5) == (2, 1) and grown([2.0, 2.0, 2.0], 2) == (3, 1) and grown([], 5) == (0, 0)


def test_limits_and_empty_sides(spark):
    df, *_ = table(spark, 200)
    none = boosting.fit(df, COLS, F.lit(False), Params(rounds=2, max_depth=2, gamma=1e6))
    assert none.losses == [] and all(set(t.feature) == {-1} for own in none.trees for t in own) and len(none.trees) == 2
    assert [n for _, _, n in none.importance()] == [0] * 4
    empty = boosting.fit(df.limit(0), COLS, F.lit(False), Params(rounds=1))
    assert np.allclose(empty.probabilities(np.zeros((2, 4))), 1 / 3)
    gone = df.withColumn("a", F.lit(None).cast("double"))
    model = boosting.fit(gone, COLS, F.col("held"), Params(rounds=2, max_depth=2), fill={"a": 1.0})
    assert dict((c, n) for c, _, n in model.importance())["a"] == 0


def test_quantile_cuts(spark):
    df = spark.createDataFrame([(float(i % 10), float(i), 1.0) for i in range(1000)], "a double, b double, c double")
    a, b, c = quantile_cuts(df, ["a", "b", "c"], 10)
    assert a.tolist() == [float(i) for i in range(9)] and b.tolist() == [100.0 * i - 1 for i in range(1, 10)] and c.tolist() == []


def test_model_of_the_18_features(spark):
    rng = np.random.default_rng(1)
    recs = [(i, *[float(v) for v in np.round(rng.normal(i % 3, .8, len(FEATURE_COLS)), 2)], float(i % 3)) for i in range(400)]
    df = spark.createDataFrame(recs, "match_id bigint, " + ", ".join(f"{c} double" for c in FEATURE_COLS) + ", label double")
    model = ml.fit(df, NOTEBOOK, "gbt", num_trees=6, max_depth=2, rate=.5, early_stopping_rounds=2)
    p = ml.predict(model, df)
    assert all(abs(r[0] - 1) < 1e-9 for r in p.select(F.col("win_prob") + F.col("draw_prob") + F.col("loss_prob")).collect())
    assert ml.accuracy_logloss(p).first()["accuracy"] > .9
    imp = ml.feature_importance(model).collect()
    assert len(imp) == len(FEATURE_COLS) and imp[0]["n_splits"] > 0 and imp[0]["importance"] == imp[0]["mean_gain"]
    base = scratch_path(spark, "gbt")
    ml.save_model(model, base, {"n_training_samples": 400})
    assert ml.load_metadata(base)["best_iteration"] == model.best_iteration == len(model.trees)
    a, b = (rows(ml.predict(m, df).orderBy("match_id"), "prediction", "win_prob") for m in (model, ml.load_model(base)))
    assert a == b


def test_a_tasks_sums_stay_in_one_table():
    """Batches are added up in arrays; only the sums of a whole task leave it."""
    rng, p = np.random.default_rng(5), Params(subsample=1.0, colsample=1.0, bins=8, max_depth=2)
    n, growing = 300, [boosting.Tree.root(2) for _ in range(3)]
    for k, t in enumerate(growing):
        t.feature[0], t.cut[0], t.value[1], t.value[2] = k, 3, -.25, .5
    ids, labels, held = np.arange(n), rng.integers(0, 3, n).astype(np.int32), rng.random(n) < .2
    bins, scores = rng.integers(0, 8, (n, 4)).astype(np.uint8), rng.normal(size=(n, 3))
    for level in (0, 1):
        sums = boosting.Histogram([growing], growing, level, 1, 4, p)
        for i in range(0, n, 70):
            sums.add(*(x[i:i + 70] for x in (ids, labels, held, bins, scores)))
        found = {c: (g, h) for c, g, h in zip(*sums.rows())}
        new = scores + np.where(bins[:, :3] > 3, .5, -.25)
        prob, want = softmax(new), {}
        for i in np.flatnonzero(~held):
            for k in range(3):
                node = int(bins[i, k] > 3) if level else 0
                for f in range(4):
                    cell, q = ((k * 2**level + node) * 4 + f) * 8 + int(bins[i, f]), prob[i, k]
                    g, h = want.get(cell, (0, 0))
                    want[cell] = g + int(np.rint((q - (labels[i] == k)) * boosting.UNIT)), h + int(np.rint(2 * q * (1 - q) * boosting.UNIT))
        if not level:
            want[-1] = int(np.rint(-np.log(prob[held, labels[held]]) * boosting.UNIT).sum()), int(held.sum())
        assert found == want


def test_packed_rows():
    for x in (np.arange(12, dtype=np.uint8).reshape(4, 3), np.linspace(0, 1, 8).reshape(4, 2)):
        packed = boosting._packed(np.asfortranarray(x))
        assert packed.to_pylist() == [r.tobytes() for r in x]
        assert (boosting._matrix(packed.slice(1, 2), x.dtype, x.shape[1]) == x[1:3]).all()


def test_nodes_of_deep_trees():
    rng = np.random.default_rng(2)
    tree, bins = boosting.Tree.root(8), rng.integers(0, 64, (200, 5)).astype(np.uint8)
    for i in range(255):
        if rng.random() < .9:
            tree.feature[i], tree.cut[i] = int(rng.integers(0, 5)), int(rng.integers(10, 50))
    want = []
    for r in bins:
        i = 0
        while tree.feature[i] >= 0:
            i = 2 * i + 1 + int(r[tree.feature[i]] > tree.cut[i])
        want.append(i)
    assert boosting.nodes_of(tree, bins).tolist() == want
