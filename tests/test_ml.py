"""ML metrics on fixed scores, medians, split, model sanity."""

import numpy as np
from pyspark.sql import functions as F

from match_cases import rows
from matchlab.config import NOTEBOOK
from matchlab.operators import ml
from matchlab.schemas import FEATURE_COLS


def _fixed(spark):
    # label, prediction, win/draw/loss probabilities (9 rows)
    data = [(0, 0, .7, .2, .1), (0, 0, .6, .3, .1), (0, 1, .3, .5, .2), (1, 1, .2, .6, .2),
            (1, 0, .5, .3, .2), (1, 2, .2, .3, .5), (2, 2, .1, .2, .7), (2, 2, .2, .2, .6),
            (2, 0, .4, .3, .3)]
    return spark.createDataFrame([(float(a), float(b), c, d, e) for a, b, c, d, e in data],
                                 "label double, prediction double, win_prob double, draw_prob double, loss_prob double")


def test_metrics_by_hand(spark):
    p = _fixed(spark)
    m = ml.accuracy_logloss(p).first()
    assert m["accuracy"] == round(5 / 9, 9)
    ll = -np.mean(np.log([.7, .6, .3, .6, .3, .3, .7, .6, .3]))
    assert abs(m["log_loss"] - ll) < 1e-9
    conf = {r["label"]: (r["pred_0"], r["pred_1"], r["pred_2"]) for r in ml.confusion(p).collect()}
    assert conf == {0.0: (2, 1, 0), 1.0: (1, 1, 1), 2.0: (1, 0, 2)}
    rep = {r["class"]: r for r in ml.class_report(p).collect()}
    assert abs(rep["W"]["precision"] - round(2 / 4, 6)) < 1e-12
    assert abs(rep["W"]["recall"] - round(2 / 3, 6)) < 1e-12
    f1_w = 2 * .5 * (2 / 3) / (.5 + 2 / 3)
    assert abs(rep["W"]["f1"] - round(f1_w, 6)) < 1e-12
    assert rep["macro avg"]["support"] == 9


def test_exact_median(spark):
    vals = [3.0, 1.0, 2.0, 10.0, 7.0, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = ml.feature_medians(df, ["x"]).first()["median"]
    assert got == float(np.median(vals))
    df2 = spark.createDataFrame([(v,) for v in vals[:5]], "x double")
    assert ml.feature_medians(df2, ["x"]).first()["median"] == float(np.median(vals[:5]))


def test_split_is_deterministic_and_proportional(spark):
    df = spark.range(20000).withColumnRenamed("id", "match_id")
    train, test = ml.split(df, NOTEBOOK)
    n = test.count()
    assert 3700 < n < 4300 and train.count() + n == 20000
    assert ml.split(df, NOTEBOOK)[1].count() == n


def test_forest_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(1)
    recs = []
    for i in range(300):
        y = i % 3
        feats = [float(rng.normal(y, 0.3)) for _ in FEATURE_COLS]
        recs.append((i, *feats, float(y)))
    schema = "match_id bigint, " + ", ".join(f"{c} double" for c in FEATURE_COLS) + ", label double"
    df = spark.createDataFrame(recs, schema)
    model = ml.fit(df, NOTEBOOK, "forest", num_trees=20)
    p = ml.predict(model, df)
    s = p.select((F.col("win_prob") + F.col("draw_prob") + F.col("loss_prob")).alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in s)
    acc = ml.accuracy_logloss(p).first()["accuracy"]
    base = df.filter("label = 0").count() / df.count()
    assert acc > base
    imp = ml.feature_importance(model)
    assert imp.count() == len(FEATURE_COLS)
    assert abs(sum(r["importance_pct"] for r in imp.collect()) - 100) < 0.01


def test_drivers_fixed_weights(spark):
    scored = spark.createDataFrame([(1, *[float(i) for i in range(len(FEATURE_COLS))])],
                                   "fixture_id bigint, " + ", ".join(f"{c} double" for c in FEATURE_COLS))
    stats = spark.createDataFrame([(c, 0.0, 1.0) for c in FEATURE_COLS], "column_name string, mean double, std double")
    imp = spark.createDataFrame([(c, 1.0) for c in FEATURE_COLS], "feature string, importance_pct double")
    d = ml.drivers(scored, stats, imp, k=3)
    got = rows(d.orderBy("rank"), "rank", "feature")
    assert [f for _, f in got] == FEATURE_COLS[::-1][:3]


def test_exact_median_hot_value_many_ranges(spark):
    rng = np.random.default_rng(3)
    a = np.concatenate([np.zeros(4000), rng.normal(1.0, 2.0, 8001)])
    b = np.concatenate([rng.integers(0, 50, 6000).astype(float), np.full(3000, 7.0)])
    df_a = spark.createDataFrame([(float(x),) for x in a], "x double").repartition(8)
    df_b = spark.createDataFrame([(float(x),) for x in b], "x double").repartition(8)
    assert ml.feature_medians(df_a, ["x"]).first()["median"] == float(np.median(a))
    assert ml.feature_medians(df_b, ["x"]).first()["median"] == float(np.median(b))


def test_impute_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 2.0), (None, 4.0), (5.0, 6.0)], "a double, b double")
    tr, te = ml.impute(df, [df], NOTEBOOK, cols=["a", "b"])
    assert sorted(rows(tr, "a")) == [(1.0,), (3.0,), (3.0,), (5.0,)]
    assert sorted(rows(te, "b")) == [(2.0,), (4.0,), (4.0,), (6.0,)]
    z, = ml.impute(df, [], NOTEBOOK.with_(impute="zero"), cols=["a", "b"])
    assert sorted(rows(z, "a")) == [(0.0,), (1.0,), (3.0,), (5.0,)]
