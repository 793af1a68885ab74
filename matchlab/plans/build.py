"""The three runs of the application as Spark jobs: feature build, training,
scoring. Each writes its tables once (parquet, overwrite) and reads them
back for the next step, so no plan is executed twice and a later step never
recomputes an earlier one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.operators import clean, ml, quality, snapshot
from matchlab.operators.features import match_features
from matchlab.sources import files


def feature_build(raw_results: DataFrame, former_names: DataFrame | None, out_dir: str,
                  cfg: FeatureConfig = NOTEBOOK, gate: bool = True) -> dict:
    """raw results -> matches_clean -> match_features (+ checks). Returns the
    written tables as DataFrames reading the files."""
    spark = raw_results.sparkSession
    m = clean.clean_matches(raw_results, former_names, cfg).withColumn("year", F.year("date"))
    files.write_table(m, f"{out_dir}/matches_clean", partition_by=["year"], sort_within=["date", "match_id"])
    matches = files.read_parquet(spark, f"{out_dir}/matches_clean").drop("year")
    tests = quality.column_tests(matches, "matches_clean",
                                 not_null=["match_id", "date", "home_team", "away_team", "result"],
                                 unique=["match_id"], accepted={"result": ["W", "D", "L"]})
    if gate:
        quality.gate(tests)
    mf = match_features(matches, cfg.with_(materialize_input=False))
    files.write_table(mf, f"{out_dir}/match_features")
    return {"matches_clean": matches, "match_features": files.read_parquet(spark, f"{out_dir}/match_features"),
            "tests": tests}


def train_run(mf: DataFrame, model_dir: str, cfg: FeatureConfig = NOTEBOOK, model: str = "forest") -> dict:
    """match_features -> split, impute, fit, evaluate, save."""
    train, test = ml.split(ml.training_set(mf, cfg), cfg)
    fitted = ml.fit(train, cfg, model, medians=ml.impute_values(train, cfg))
    pred = ml.predict(fitted, test)
    metrics = ml.accuracy_logloss(pred)
    m = metrics.first()
    ml.save_model(fitted, model_dir, {"n_training_samples": train.count(), "n_test_samples": int(m["n"]),
                                      "test_accuracy": float(m["accuracy"]), "model": model})
    return {"model": fitted, "metrics": metrics, "report": ml.class_report(pred),
            "confusion": ml.confusion(pred), "baseline": ml.baseline_lift(train, test, pred),
            "importance": ml.feature_importance(fitted), "scaler": ml.scaler_stats(train)}


def score_run(mf: DataFrame, fixtures: DataFrame, fitted, out_dir: str, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """latest snapshots -> fixture features -> predictions (one overwrite)."""
    spark = mf.sparkSession
    ff = snapshot.fixture_features(fixtures, snapshot.latest_form(mf), snapshot.latest_h2h(mf), cfg)
    files.write_table(ml.score(fitted, ff, cfg, keep_features=True), f"{out_dir}/predictions")
    return files.read_parquet(spark, f"{out_dir}/predictions")


def run_all(spark: SparkSession, raw_results: DataFrame, former_names, fixtures: DataFrame, out_dir: str,
            cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """ingest -> features (gate) -> train -> predict, in the original's order."""
    built = feature_build(raw_results, former_names, out_dir, cfg)
    trained = train_run(built["match_features"], f"{out_dir}/model", cfg)
    return score_run(built["match_features"], fixtures, trained["model"], out_dir, cfg)
