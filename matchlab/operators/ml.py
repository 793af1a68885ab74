"""Model input, training, evaluation, explanation and scoring.

The original fits a boosted-tree library on one machine. ``model="gbt"`` is
its counterpart: three-class boosted trees with the original's limits, grown
on histograms that Spark sums (``boosting``), stopped on the joint log loss. The
default is a random forest with the original's tree count, depth and sampling
rates, grown the same way (``forest``); MLlib's multinomial logistic regression is an option. Metrics,
baselines and drivers are DataFrame aggregates.
"""

from __future__ import annotations

import datetime as _dt
import json

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.functions.columns import label_code, label_text, result_text
from matchlab.operators import boosting, forest
from matchlab.operators.selection import exact_ranks
from matchlab.operators.skew import positions
from matchlab.schemas import FEATURE_COLS, LABEL_MAP
from matchlab.session import discard, materialize, materialize_counted

EPS = 1e-15
PROB_COLS = ["win_prob", "draw_prob", "loss_prob"]


# ---------------------------------------------------------------- M01-M04

def training_set(mf: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """Rows with a known result from ``cfg.train_from`` on:
    match_id, date, the 18 features (double), label (0/1/2)."""
    df = mf.filter(F.col("result").isNotNull())
    if cfg.train_from is not None:
        df = df.filter(F.col("date") >= F.lit(cfg.train_from))
    return df.select("match_id", "date", *[F.col(c).cast("double").alias(c) for c in FEATURE_COLS],
                     label_code("result").alias("label"))


def split_bucket(col: str = "match_id") -> Column:
    """Deterministic bucket 0..9999 from the md5 of the key — the
    same value in every engine, independent of partitioning."""
    return F.conv(F.substring(F.md5(F.col(col).cast("string")), 1, 8), 16, 10).cast("bigint") % 10000


def stratified_split(df: DataFrame, cfg: FeatureConfig = NOTEBOOK, key: str = "match_id", label: str = "label"):
    """(train, test) with exactly round(ratio * n) test rows of each class of
    n rows (half up): those with the smallest md5 of their key (ties: smallest
    key). Rows get their rank within the class from sorted ranges and the counts
    of earlier ranges, so a class of any size is spread over many tasks, and the
    split is the same on any layout. Rows are told apart by their key; rows with
    the same key may come in either part."""
    placed = positions(df.withColumn("_h", F.md5(F.col(key).cast("string"))), [label], ["_h", key], "_rank", "_n")
    test = F.col("_rank") <= F.floor(F.col("_n") * F.lit(cfg.test_ratio) + 0.5)
    both = materialize(placed.select(*df.columns, test.alias("_test")), "split")
    return both.where("NOT _test").drop("_test"), both.where("_test").drop("_test")


def split(df: DataFrame, cfg: FeatureConfig = NOTEBOOK, key: str = "match_id"):
    """(train, test) by hash bucket; each class keeps the ratio in
    expectation (the share of a class of n rows in the test part has a
    standard deviation of sqrt(ratio * (1 - ratio) / n))."""
    b = split_bucket(key)
    cut = int(round(cfg.test_ratio * 10000))
    return df.filter(b >= cut), df.filter(b < cut)


def feature_medians(df: DataFrame, cols=FEATURE_COLS) -> DataFrame:
    """column_name, median per column (mean of the two middle values
    for an even count), by exact selection (``selection.exact_ranks``): a few
    scans of the columns, no shuffle of rows. Columns without values are left out."""
    found = exact_ranks(df, list(cols), lambda n: sorted({(n + 1) // 2, n // 2 + 1}))
    rows = [(c, (min(v.values()) + max(v.values())) / 2.0) for c, (_, v) in found.items() if v]
    return df.sparkSession.createDataFrame(rows, "column_name string, median double")


def impute_values(train: DataFrame, cfg: FeatureConfig = NOTEBOOK, cols=FEATURE_COLS) -> dict:
    """What fills nulls: the train medians (``impute='median'``) of the
    columns that have nulls (one aggregate finds them), or 0 (``'zero'``)."""
    if cfg.impute == "zero":
        return {c: 0.0 for c in cols}
    nulls = train.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    todo = [c for c in cols if nulls[c]]
    if not todo:
        return {}
    return {r["column_name"]: float(r["median"]) for r in feature_medians(train, todo).collect() if r["median"] is not None}


def impute(train: DataFrame, others: list[DataFrame], cfg: FeatureConfig = NOTEBOOK, cols=FEATURE_COLS):
    """All tables with the nulls of ``cols`` filled."""
    values = impute_values(train, cfg, cols)
    return [d.fillna(values) if values else d for d in [train] + list(others)]


def scaler_stats(train: DataFrame, cols=FEATURE_COLS, digits: int = 9) -> DataFrame:
    """column_name, mean, std (sample deviation, as MLlib's
    StandardScaler uses; multiply by sqrt((n-1)/n) for the population
    one) — one aggregate."""
    aggs = [F.struct(F.lit(c).alias("column_name"), F.round(F.avg(c), digits).alias("mean"),
                     F.round(F.stddev_samp(c), digits).alias("std")).alias(c) for c in cols]
    return train.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in cols])))


# ---------------------------------------------------------------- M05-M07

#: Partitions of the training table of a linear model. MLlib adds up by partition, so a
#: fixed number, by hash of the id and sorted, gives the same model on any cluster.
TRAIN_PARTITIONS = 32


def _prepare(medians: dict | None) -> list:
    """Pipeline stages from the 18 columns to ``features``, scaled. Nulls are filled
    with ``medians`` inside the pipeline, so a saved model has them, too."""
    fill = ", ".join(f"coalesce(CAST({c} AS DOUBLE), {float((medians or {}).get(c, 0.0))!r}D) AS _x_{c}" for c in FEATURE_COLS)
    return [SQLTransformer(statement=f"SELECT *, {fill} FROM __THIS__"),
            VectorAssembler(inputCols=[f"_x_{c}" for c in FEATURE_COLS], outputCol="features_raw"),
            StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)]


def fit(train: DataFrame, cfg: FeatureConfig = NOTEBOOK, model: str = "forest", num_trees: int = 300,
        max_depth: int = 4, rate: float = 0.05, subsample: float = 0.8, colsample: float = 0.8,
        early_stopping_rounds: int = 20, validation_ratio: float = 0.1, min_instances: int = 3,
        min_gain: float | None = None, medians: dict | None = None):
    """M04+M05 (+M06 for ``model='gbt'``): a fitted model whose
    ``transform`` adds ``probability`` (3 classes) and ``prediction``.
    ``min_instances`` and ``min_gain`` (none given: 0.1 for ``gbt``, else 0)
    limit leaves and splits. Every model is fitted on all rows of ``train``.

    ``gbt``: ``boosting.fit`` with ``num_trees`` rounds at most, stopped by
    ``early_stopping_rounds`` on a hash-held-out validation part of ``train``
    (never the test split); ``min_instances`` is the least hessian sum of a
    leaf."""
    if model == "gbt":
        p = boosting.Params(num_trees, max_depth, rate, subsample, colsample, float(min_instances), 0.1 if min_gain is None else min_gain,
                            patience=early_stopping_rounds, classes=len(LABEL_MAP), seed=cfg.seed)
        held = ((split_bucket("match_id") * 7919) % 10000) < int(validation_ratio * 10000)
        return boosting.fit(train, FEATURE_COLS, held, p, fill=medians)
    if model == "forest":
        p = forest.Params(num_trees, max_depth, subsample, colsample, min_instances, min_gain or 0.0, classes=len(LABEL_MAP), seed=cfg.seed)
        return forest.fit(train, FEATURE_COLS, p, fill=medians)
    if model != "logistic":
        raise ValueError(f"unknown model {model!r}")
    data = _training_input(train)
    try:
        clf = LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", maxIter=200, regParam=0.01)
        return Pipeline(stages=[*_prepare(medians), clf]).fit(data)
    finally:
        discard(data)


def _training_input(train: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The training table, all of it, written once (MLlib passes over it several times) and
    dealt over ``TRAIN_PARTITIONS`` by id, sorted, as it is read: which files a
    scan's partition holds depends on how the file system lists them. Only a caller
    that asks for about ``max_rows`` rows gets a part, by hash of the id; ``fit`` never does."""
    data, n = materialize_counted(train, "training")
    if max_rows is not None and n > max_rows:
        share = F.pmod(F.xxhash64("match_id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / n)
        data, whole = materialize(data.where(share), "training"), data
        discard(whole)
    dealt = data.repartition(TRAIN_PARTITIONS, "match_id").sortWithinPartitions("match_id")
    dealt._scratch = data._scratch
    return dealt


def predict(model, df: DataFrame) -> DataFrame:
    """Adds prediction (0/1/2), predicted_result (W/D/L) and the three
    class probabilities as doubles."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))
    keep = [c for c in df.columns]
    return out.select(*keep, F.col("prediction"), label_text("prediction").alias("predicted_result"),
                      *[p[i].alias(c) for i, c in enumerate(PROB_COLS)])


# ---------------------------------------------------------------- M08-M11

def _prob_of_label() -> Column:
    l = F.col("label").cast("int")
    return F.when(l == 0, F.col("win_prob")).when(l == 1, F.col("draw_prob")).otherwise(F.col("loss_prob"))


def accuracy_logloss(pred: DataFrame, digits: int = 9) -> DataFrame:
    """N, accuracy, multi-class log loss (probabilities clipped at
    1e-15) — one aggregate."""
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), digits).alias("accuracy"),
        F.round(F.avg(-F.log(F.greatest(_prob_of_label(), F.lit(EPS)))), digits).alias("log_loss"),
    )


def confusion(pred: DataFrame) -> DataFrame:
    """Label x prediction counts (pred_0..pred_2, zeros filled) and
    the row-normalised rates."""
    classes = sorted(float(v) for v in LABEL_MAP.values())
    c = (pred.groupBy("label").pivot("prediction", classes).count().fillna(0))
    names = {str(v): f"pred_{int(v)}" for v in classes}
    c = c.select("label", *[F.col(f"`{k}`").cast("bigint").alias(v) for k, v in names.items()])
    total = sum((F.col(v) for v in list(names.values())[1:]), F.col(list(names.values())[0]))
    return c.select("label", *names.values(),
                    *[F.round(F.col(v) / total, 6).alias(f"{v}_rate") for v in names.values()])


def class_report(pred: DataFrame, digits: int = 6) -> DataFrame:
    """Per class precision, recall, F1, support, then 'macro avg' and
    'weighted avg' rows (class = label text)."""
    rows = []
    for name, k in LABEL_MAP.items():
        rows.append(F.struct(
            F.lit(name).alias("class"),
            F.count_if((F.col("label") == k) & (F.col("prediction") == k)).alias("tp"),
            F.count_if(F.col("prediction") == k).alias("predicted"),
            F.count_if(F.col("label") == k).alias("support")))
    per = pred.agg(*[r.alias(f"_{i}") for i, r in enumerate(rows)]).select(
        F.inline(F.array(*[F.col(f"_{i}") for i in range(len(rows))])))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.select("class", p.alias("precision"), r.alias("recall"), "support")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(0.0))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.sum("support").alias("support"), F.avg("f1").alias("f1"))
    wsum = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    weighted = per.agg(F.lit("weighted avg").alias("class"), wsum("precision").alias("precision"),
                       wsum("recall").alias("recall"), F.sum("support").alias("support"), wsum("f1").alias("f1"))
    out = per.unionByName(macro).unionByName(weighted)
    return out.select("class", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("bigint").alias("support"))


def label_mode(train: DataFrame) -> DataFrame:
    """A05 on the label: the most frequent class (ties -> smallest code)."""
    return (train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("label")).limit(1).select(F.col("label").alias("majority_label")))


def class_priors(train: DataFrame) -> DataFrame:
    """Class frequencies of the training labels, one row: win_prob,
    draw_prob, loss_prob, majority (0/1/2)."""
    n = F.count(F.lit(1))
    g = train.agg(*[(F.count_if(F.col("label") == k) / n).alias(c)
                    for c, k in zip(PROB_COLS, sorted(LABEL_MAP.values()))])
    best = (F.when((F.col("win_prob") >= F.col("draw_prob")) & (F.col("win_prob") >= F.col("loss_prob")), 0.0)
            .when(F.col("draw_prob") >= F.col("loss_prob"), 1.0).otherwise(2.0))
    return g.withColumn("majority", best)


def prior_predict(train: DataFrame, df: DataFrame) -> DataFrame:
    """The majority baseline as a model: every row gets the training class
    frequencies as probabilities and the majority class as prediction.
    The priors are scalar subqueries over ``train`` (merged into one
    aggregate by the optimizer), not a join."""
    pr = class_priors(train)
    probs = {c: pr.select(c).scalar() for c in PROB_COLS}
    maj = pr.select("majority").scalar()
    return df.select(*df.columns, maj.alias("prediction"), label_text(maj).alias("predicted_result"),
                     *[probs[c].alias(c) for c in PROB_COLS])


#: Weights of a fixed linear model: a stem's weight counts for the home side and
#: against the away side. Not fitted; its predictions differ from row to row and
#: can be written in SQL, so reports and metrics can be checked on it.
FIXED_STEM_WEIGHTS = {
    "win_rate_last10": 1.5, "draw_rate_last10": -0.5, "avg_goals_scored_last20": 0.375,
    "avg_goals_conceded_last20": -0.25, "avg_goal_diff_last10": 0.25, "goal_diff_trend": 0.125,
    "ranking_proxy": 1.0, "ranking_change": 0.75}
FIXED_H2H_WEIGHT, FIXED_DRAW = 1.25, 0.0625


def fixed_predict(df: DataFrame) -> DataFrame:
    """The fixed linear model: prediction, predicted_result and the softmax of
    (s, ``FIXED_DRAW``, -s), where s is the weighted sum of the features."""
    s = F.lit(0.0)
    for stem, w in FIXED_STEM_WEIGHTS.items():
        s = s + (F.col(f"home_{stem}") - F.col(f"away_{stem}")) * w
    s = s + (F.col("h2h_team_a_win_rate") - 0.33) * FIXED_H2H_WEIGHT
    out = df.withColumn("_s", s).withColumns({"_w": F.exp("_s"), "_d": F.exp(F.lit(FIXED_DRAW)), "_l": F.exp(-F.col("_s"))})
    total = F.col("_w") + F.col("_d") + F.col("_l")
    out = out.withColumns({p: F.col(e) / total for p, e in zip(PROB_COLS, ("_w", "_d", "_l"))})
    best = (F.when((F.col("_w") >= F.col("_d")) & (F.col("_w") >= F.col("_l")), 0.0)
            .when(F.col("_d") >= F.col("_l"), 1.0).otherwise(2.0))
    return out.withColumn("prediction", best).select(*df.columns, "prediction", label_text("prediction").alias("predicted_result"), *PROB_COLS)


#: A small fixed ensemble over the features: (feature, greatest value that goes
#: left, left, right) or a leaf's weight; one tree a class and round.
FIXED_ROUNDS = [
    [("home_win_rate_last10", 0.3, ("away_win_rate_last10", 0.5, 0.1, -0.2), ("away_win_rate_last10", 0.3, 0.4, 0.15)),
     ("h2h_total", 8.0, 0.05, -0.1),
     ("away_win_rate_last10", 0.5, -0.1, 0.35)],
    [("home_goal_diff_trend", 0.0, -0.05, 0.2), 0.0, ("home_goal_diff_trend", 0.0, 0.1, ("home_win_rate_last10", 0.5, -0.05, -0.3))],
]


def fixed_trees() -> boosting.Booster:
    """``FIXED_ROUNDS`` as a model. Not fitted; its predictions can be written in SQL."""
    cuts = {c: set() for c in FEATURE_COLS}

    def collect(node):
        if isinstance(node, tuple):
            cuts[node[0]].add(node[1])
            collect(node[2]), collect(node[3])

    def fill(tree, node, i):
        if isinstance(node, tuple):
            tree.feature[i], tree.cut[i], tree.gain[i] = FEATURE_COLS.index(node[0]), sorted(cuts[node[0]]).index(node[1]), 1.0
            fill(tree, node[2], 2 * i + 1), fill(tree, node[3], 2 * i + 2)
        else:
            tree.value[i] = node
        return tree

    for own in FIXED_ROUNDS:
        for node in own:
            collect(node)
    trees = [[fill(boosting.Tree.root(2), node, 0) for node in own] for own in FIXED_ROUNDS]
    return boosting.Booster(FEATURE_COLS, [np.array(sorted(cuts[c])) for c in FEATURE_COLS], trees)


def fixed_importance(spark) -> DataFrame:
    """feature, importance_pct of the fixed model: shares of the absolute weights."""
    w = {f"{side}_{stem}": abs(x) for stem, x in FIXED_STEM_WEIGHTS.items() for side in ("home", "away")}
    w |= {"h2h_team_a_win_rate": FIXED_H2H_WEIGHT, "h2h_total": 0.0}
    total = sum(w[c] for c in FEATURE_COLS)
    return spark.createDataFrame([(c, round(w[c] * 100.0 / total, 4)) for c in FEATURE_COLS], "feature string, importance_pct double")


def baseline_lift(train: DataFrame, test: DataFrame, pred: DataFrame, digits: int = 9) -> DataFrame:
    """Majority class of train, its accuracy on test, the model's
    accuracy and the lift in percent (null when the baseline is 0)."""
    maj = label_mode(train).select("majority_label").scalar()
    base = test.agg(F.avg((F.col("label") == maj).cast("double")).alias("baseline_accuracy"))
    model_acc = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).scalar()
    return base.select(label_text(maj).alias("majority_class"),
                       F.round("baseline_accuracy", digits).alias("baseline_accuracy"),
                       F.round(model_acc, digits).alias("model_accuracy"),
                       F.round(F.try_divide((model_acc - F.col("baseline_accuracy")) * 100.0,
                                            F.col("baseline_accuracy")), 4).alias("lift_pct"))


# ---------------------------------------------------------------- M12

def feature_importance(model, top: int | None = None) -> DataFrame:
    """Feature, importance, percent of total, rank; for trees of any kind
    importance is the mean gain per split, with ``mean_gain`` and ``n_splits``
    (gain and weight) as well; for a linear model, the sum of absolute
    coefficients. One row per feature (18), built from the fitted model."""
    spark = _spark()
    last = model.stages[-1] if isinstance(model, PipelineModel) else None
    if isinstance(model, boosting.Booster):
        df = spark.createDataFrame(model.importance(), "feature string, mean_gain double, n_splits bigint").withColumn("importance", F.col("mean_gain"))
    else:
        coef = last.coefficientMatrix.toArray()
        imp = [float(sum(abs(coef[r][i]) for r in range(coef.shape[0]))) for i in range(len(FEATURE_COLS))]
        df = spark.createDataFrame(list(zip(FEATURE_COLS, imp)), "feature string, importance double")
    w = Window.orderBy(F.desc("importance"), F.asc("feature"))
    out = df.select("feature", "importance",
                    F.round(F.col("importance") * 100.0 / F.sum("importance").over(Window.partitionBy(F.lit(1))), 4)
                    .alias("importance_pct"),
                    F.row_number().over(w).alias("rank"), *[c for c in ("mean_gain", "n_splits") if c in df.columns])
    return out.filter(F.col("rank") <= top) if top else out


def tree_split_stats(model, path: str) -> DataFrame:
    """M12 (gain and weight per feature): save the trees to ``path`` and aggregate
    the stored nodes: mean gain per split and split count per feature."""
    spark = _spark()
    model.save(path, spark)
    schema = "columns array<string>, trees array<array<struct<feature:array<int>,gain:array<double>>>>"
    trees = spark.read.parquet(path).select(F.from_json("model", schema).alias("m")).select("m.columns", F.explode(F.flatten("m.trees")).alias("t"))
    nodes = trees.select("columns", F.inline(F.arrays_zip("t.feature", "t.gain")).alias("fi", "gain")).where("fi >= 0")
    return nodes.groupBy(F.element_at("columns", F.col("fi") + 1).alias("feature")).agg(F.avg("gain").alias("mean_gain"), F.count(F.lit(1)).alias("n_splits"))


# ---------------------------------------------------------------- M14-M19

def score(model, features: DataFrame, cfg: FeatureConfig = NOTEBOOK,
          predicted_at: Column | None = None, keep_features: bool = False) -> DataFrame:
    """predicted_result, three rounded probabilities, confidence =
    the largest, predicted_at (``current_timestamp`` unless given)."""
    p = predict(model, features) if model is not None else features
    d = cfg.round_digits
    ids = [c for c in ("fixture_id", "group_name", "home_team", "away_team", "match_date") if c in features.columns]
    extra = FEATURE_COLS if keep_features else []
    return p.select(*ids, "predicted_result", *[F.round(c, d).alias(c) for c in PROB_COLS],
                    F.round(F.greatest(*[F.col(c) for c in PROB_COLS]), d).alias("confidence"),
                    (predicted_at if predicted_at is not None else F.current_timestamp()).alias("predicted_at"),
                    *extra)


def score_prior(train: DataFrame, features: DataFrame, cfg: FeatureConfig = NOTEBOOK,
                predicted_at: Column | None = None, keep_features: bool = False) -> DataFrame:
    """M14 with the majority-baseline model (deterministic)."""
    return score(None, prior_predict(train, features), cfg, predicted_at, keep_features)


def drivers(scored: DataFrame, stats: DataFrame, importance: DataFrame, k: int = 5,
            scale: str = "z") -> DataFrame:
    """M17 (``scale='z'``: (x - mean) / (std + 1e-9) x importance percent) and
    M18 (``scale='raw'``: x x importance): the k features with the largest
    absolute score per fixture, with direction. ``scored`` must carry the
    18 feature columns (``keep_features=True``)."""
    long = scored.select("fixture_id", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in FEATURE_COLS])))
    imp = importance.select("feature", F.col("importance_pct").alias("_imp"))
    j = long.join(imp, on="feature", how="left")
    if scale == "z":
        st = stats.select(F.col("column_name").alias("feature"), "mean", "std")
        j = j.join(st, on="feature", how="left")
        s = (F.col("value") - F.col("mean")) / (F.col("std") + 1e-9) * F.coalesce(F.col("_imp"), F.lit(0.0))
    elif scale == "raw":
        s = F.col("value") * F.coalesce(F.col("_imp"), F.lit(0.0))
    else:
        raise ValueError(scale)
    j = j.withColumn("score", F.round(s, 9))
    w = Window.partitionBy("fixture_id").orderBy(F.desc(F.abs("score")), F.asc("feature"))
    return (j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("fixture_id", "rank", "feature", "value", "score",
                    F.when(F.col("score") > 0, "up").otherwise("down").alias("direction")))


def result_label(df: DataFrame) -> DataFrame:
    """Adds result_text ('X Wins' / 'Draw')."""
    return df.withColumn("result_text", result_text("predicted_result", "home_team", "away_team"))


def save_model(model, path: str, metadata: dict) -> None:
    """The fitted model (with the values that fill nulls) and a one-row
    metadata table next to it; ``metadata`` should have n_training_samples."""
    md = dict(metadata)
    if isinstance(model, boosting.Booster):
        model.save(f"{path}/model", _spark())
        md["model"] = "forest" if isinstance(model, forest.Forest) else "gbt"
        if md["model"] == "gbt":
            md.setdefault("best_iteration", model.best_iteration)
    else:
        model.write().overwrite().save(f"{path}/model")
    spark = _spark()
    md.setdefault("feature_cols", FEATURE_COLS)
    md.setdefault("label_map", LABEL_MAP)
    md.setdefault("training_date", _dt.datetime.now(_dt.timezone.utc).isoformat())
    spark.createDataFrame([(json.dumps(md, sort_keys=True),)], "metadata string") \
        .write.mode("overwrite").json(f"{path}/metadata")


def load_metadata(path: str) -> dict:
    return json.loads(_spark().read.json(f"{path}/metadata").first()["metadata"])


def load_model(path: str):
    kinds = {"gbt": boosting.Booster, "forest": forest.Forest}
    kind = load_metadata(path).get("model")
    if kind in kinds:
        return kinds[kind].load(f"{path}/model", _spark())
    return PipelineModel.load(f"{path}/model")


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()
