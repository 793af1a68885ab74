"""Less travelled paths: corrupt CSV lines, schema table, inventory, model
save/load, GBT option, raw drivers, split statistics of the forest."""

import numpy as np
from pyspark.sql import functions as F

from match_cases import rows
from matchlab.config import NOTEBOOK
from matchlab.operators import ml, reports
from matchlab.schemas import FEATURE_COLS, RESULTS
from matchlab.session import scratch_path
from matchlab.sources import files


def test_corrupt_lines_kept(spark):
    path = scratch_path(spark, "bad_csv")
    spark.createDataFrame([("date,home_team,away_team,home_score,away_score,tournament,city,country,neutral",),
                           ("2000-01-01,A,B,1,0,T,c,k,TRUE",),
                           ("2000-01-02,A,B,one,0,T,c,k,TRUE",)], "v string") \
        .coalesce(1).write.text(path)
    df = files.read_csv(spark, path, RESULTS, corrupt_col="_corrupt_record").cache()
    assert df.count() == 2
    bad = df.filter(F.col("_corrupt_record").isNotNull()).collect()
    assert len(bad) == 1 and bad[0]["home_score"] is None


def test_schema_table_and_inventory(spark):
    df = spark.range(3).withColumn("x", F.lit("a"))
    assert rows(files.schema_table(df), "column_name", "data_type") == [("id", "bigint"), ("x", "string")]
    inv = {r["table_name"]: r["n_rows"] for r in reports.table_inventory(
        spark, {"a": df, "b": spark.range(5)}).collect()}
    assert inv == {"a": 3, "b": 5, "TOTAL": 8}


def _toy(spark, n=240):
    rng = np.random.default_rng(7)
    recs = []
    for i in range(n):
        y = i % 3
        recs.append((i, *[float(rng.normal(y, 0.5)) for _ in FEATURE_COLS], float(y)))
    schema = "match_id bigint, " + ", ".join(f"{c} double" for c in FEATURE_COLS) + ", label double"
    return spark.createDataFrame(recs, schema)


def test_save_load_and_split_stats(spark):
    df = _toy(spark)
    model = ml.fit(df, NOTEBOOK, "forest", num_trees=5)
    base = scratch_path(spark, "model")
    ml.save_model(model, base, {"n": 1})
    again = ml.load_model(base)
    a = rows(ml.predict(model, df).orderBy("match_id"), "prediction")
    b = rows(ml.predict(again, df).orderBy("match_id"), "prediction")
    assert a == b
    assert spark.read.json(f"{base}/metadata").count() == 1
    st = ml.tree_split_stats(model, scratch_path(spark, "model_stats"))
    got = st.collect()
    assert got and all(r["n_splits"] > 0 for r in got)
    assert {r["feature"] for r in got} <= set(FEATURE_COLS)


def test_nulls_are_filled_by_the_saved_model(spark):
    df = _toy(spark)
    gaps = df.withColumn(FEATURE_COLS[0], F.when(F.col("match_id") % 5 != 0, F.col(FEATURE_COLS[0])))
    medians = ml.impute_values(gaps, NOTEBOOK)
    assert set(medians) == {FEATURE_COLS[0]}
    model = ml.fit(gaps, NOTEBOOK, "forest", num_trees=5, medians=medians)
    base = scratch_path(spark, "model")
    ml.save_model(model, base, {"n_training_samples": gaps.count()})
    a = rows(ml.predict(ml.load_model(base), gaps).orderBy("match_id"), "prediction", "win_prob")
    b = rows(ml.predict(model, gaps.fillna(medians)).orderBy("match_id"), "prediction", "win_prob")
    assert a == b and ml.load_metadata(base)["n_training_samples"] == 240


def test_model_does_not_depend_on_the_input_partitions(spark):
    df = _toy(spark)
    probs = [rows(ml.predict(ml.fit(d, NOTEBOOK, "forest", num_trees=10), df).orderBy("match_id"), "win_prob") for d in (df.repartition(2), df.repartition(7, "label"))]
    assert probs[0] == probs[1]


def test_training_rows_are_bounded(spark):
    df = _toy(spark, 900)
    data = ml._training_input(df, 300)
    assert 200 < data.count() < 400


def test_raw_drivers(spark):
    scored = spark.createDataFrame([(1, *[float(i) for i in range(len(FEATURE_COLS))])],
                                   "fixture_id bigint, " + ", ".join(f"{c} double" for c in FEATURE_COLS))
    imp = spark.createDataFrame([(c, 1.0 if i % 2 == 0 else 0.0) for i, c in enumerate(FEATURE_COLS)],
                                "feature string, importance_pct double")
    d = ml.drivers(scored, None, imp, k=2, scale="raw").orderBy("rank").collect()
    assert [r["feature"] for r in d] == [FEATURE_COLS[16], FEATURE_COLS[14]]
    assert d[0]["score"] == 16.0


def test_training_uses_every_row_however_many(spark, monkeypatch):
    """A table that counts as larger than any earlier bound on rows gives the model of all its rows."""
    df = _toy(spark, 900)
    whole = ml.feature_importance(ml.fit(df, NOTEBOOK, "logistic")).collect()
    counted = ml.materialize_counted
    monkeypatch.setattr(ml, "materialize_counted", lambda d, name: (counted(d, name)[0], 10**9))
    assert ml.feature_importance(ml.fit(df, NOTEBOOK, "logistic")).collect() == whole
    assert ml._training_input(df).count() == 900
