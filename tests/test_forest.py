"""The forest against one grown in plain Python from the same draws."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlab.operators import forest, ml

P = forest.Params(trees=6, max_depth=3, bins=8)
COLS = ["a", "b", "c"]


def _table(spark, n=500):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(n, 3)), 1)
    y = (x[:, 0] + rng.normal(size=n) > 0).astype(int) + (x[:, 1] > 1)
    return spark.createDataFrame([(i, *map(float, r), float(k)) for i, (r, k) in enumerate(zip(x, y))], "match_id bigint, a double, b double, c double, label double")


def _brute(keys, x, y, cuts, tree, p):
    """The nodes of one tree: node -> (feature, greatest value that goes left) or class counts."""
    times = [int(forest.poisson_table(p.subsample)[forest.lanes(np.array([k], np.uint64), tree // 4, p.seed)[0, tree % 4]]) for k in keys]
    rows = [r for r, n in enumerate(times) for _ in range(n)]

    def counts(own):
        return [sum(y[r] == k for r in own) for k in range(p.classes)]

    def gini(own):
        return 1 - sum((k / len(own))**2 for k in counts(own))

    def grow(node, own, depth):
        best, feature, cut = 0, None, None
        if depth < p.max_depth:
            for f in forest.columns_of(tree, node, len(cuts), p):
                for c in cuts[f]:
                    left, right = [r for r in own if x[r][f] <= c], [r for r in own if x[r][f] > c]
                    if min(len(left), len(right)) >= p.min_instances:
                        gain = round(gini(own) - len(left) / len(own) * gini(left) - len(right) / len(own) * gini(right), 12)
                        if gain > best:
                            best, feature, cut = gain, f, c
        if feature is None:
            return counts(own)
        kids = grow(2 * node + 1, [r for r in own if x[r][feature] <= cut], depth + 1), grow(2 * node + 2, [r for r in own if x[r][feature] > cut], depth + 1)
        same = all(isinstance(k, list) for k in kids) and np.argmax(kids[0]) == np.argmax(kids[1])
        return counts(own) if same else (feature, cut, *kids)

    return grow(0, rows, 0)


def _share(node, row):
    while isinstance(node, tuple):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return np.array(node) / sum(node)


def test_forest_by_brute_force(spark):
    df = _table(spark)
    model = forest.fit(df, COLS, P)
    data = df.select("*", F.xxhash64("match_id", F.col("label").cast("int"), *COLS).alias("k")).collect()
    x, y, keys = [[r[c] for c in COLS] for r in data], [int(r.label) for r in data], [r.k % (1 << 64) for r in data]
    for f, cuts in enumerate(model.cuts):       # exact quantiles of all rows
        v = sorted(r[f] for r in x)
        upto = {a: sum(b <= a for b in v) for a in v}
        part = {a: (upto[a] - 1) * P.bins // len(v) for a in upto}
        assert cuts.tolist() == sorted(max(a for a in part if part[a] == k) for k in set(part.values()))[:-1]
    trees = [_brute(keys, x, y, model.cuts, t, P) for t in range(P.trees)]
    want = np.array([np.mean([_share(t, r) for t in trees], axis=0) for r in x])
    assert np.allclose(model.probabilities(np.array(x)), want) and any(isinstance(t, tuple) for t in trees)


def test_draws_are_poisson():
    table = forest.poisson_table(.8)
    n = np.concatenate([table[forest.lanes(np.arange(20_000, dtype=np.uint64), k, 42)].ravel() for k in range(3)])
    for k in range(5):
        assert abs((n == k).mean() - math.exp(-.8) * .8**k / math.factorial(k)) < .005


def test_split_candidates_come_from_all_rows(spark):
    """Two equally likely classes part at a value that a sample's quantiles would miss: one row of 20,000 above it is enough."""
    df = spark.range(20_000).select(F.col("id").alias("match_id"), *[F.col("id").cast("double").alias(c) for c in ml.FEATURE_COLS],
                                    (F.col("id") >= 10_000).cast("double").alias("label"))
    for seed in (1, 2):
        model = ml.fit(df, ml.NOTEBOOK.with_(seed=seed), "forest", num_trees=3, max_depth=1, colsample=1.0)
        right = ml.predict(model, df).where("prediction = label").count()
        assert right == 20_000       # MLlib, which takes candidates from 10,000 random rows: some rows wrong


def test_rows_without_label_or_id(spark):
    df = _table(spark, 60)
    more = df.unionByName(df.limit(3).withColumn("label", F.lit(None).cast("double")))
    assert forest.fit(more, COLS, P).trees == forest.fit(df, COLS, P).trees
    nulls = df.withColumn("match_id", F.when(F.col("match_id") % 2 == 0, F.col("match_id")))
    assert np.isfinite(forest.fit(nulls, COLS, P).probabilities(np.zeros((1, 3)))).all()
    with pytest.raises(ValueError):
        forest.fit(df.limit(0), COLS, P)
