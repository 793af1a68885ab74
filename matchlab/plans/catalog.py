"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
built from the driver tables of ``sf_dir`` (see ``sources.adapter``).
Keys start with the inventory ID(s) they cover."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from matchlab.config import NOTEBOOK
from matchlab.operators import asof, clean, h2h, incremental, marts, ml, quality, reports, snapshot
from matchlab.operators.features import match_features, pair_features, team_features
from matchlab.operators.perspective import team_view
from matchlab.schemas import FEATURE_COLS, RESULTS
from matchlab.session import materialize, scratch_path
from matchlab.sources import adapter, files

# Minimum rows per table, as the original's table contract states.
ROW_MINIMUMS = {
    "raw_results": 40000, "raw_goalscorers": 10000, "raw_shootouts": 100,
    "raw_former_names": 10, "match_features": 20000, "fixtures": 48,
    "predictions": 48, "mart_team_form": 50, "mart_head_to_head": 100,
    "mart_predictions_input": 48,
}
RESULT_CODES = ["W", "D", "L"]
SUMMARY_COLS = FEATURE_COLS


# ------------------------------------------------------------------ inputs

def matches(spark, sf):
    return adapter.matches(spark, sf)


# What training and fixture features read of the match feature table.
MODEL_COLS = ["match_id", "date", "home_team", "away_team", "result", *FEATURE_COLS]


def features(spark, sf, reuse=True, cols=MODEL_COLS):
    """The match feature table; written once per query to the shared
    checkpoint folder when the query reads it in several branches
    (``reuse=False`` for a single consumer), then only with ``cols``, so that the
    others aren't computed (None: all)."""
    mf = match_features(matches(spark, sf), NOTEBOOK)
    return materialize(mf.select(*cols) if cols else mf, "match_features") if reuse else mf


def fixtures(spark, sf):
    return marts.stg_fixtures(adapter.fixtures_raw(spark, sf))


def raw_results(spark, sf):
    return adapter.raw_results(spark, sf)


def cleaned(spark, sf):
    return clean.clean_matches(raw_results(spark, sf), adapter.former_names(spark, sf), NOTEBOOK)


def train_test(spark, sf):
    ts = ml.training_set(features(spark, sf), NOTEBOOK)
    return ml.split(ts, NOTEBOOK)


def _as_of_mf(mf):
    """Run timestamp of the registered scoring queries: the latest match
    date of the data (a deterministic stand-in for ``current_timestamp``)."""
    return mf.select(F.max("date").cast("timestamp_ntz")).scalar()


def fixture_inputs(spark, sf, mf=None):
    mf = features(spark, sf) if mf is None else mf
    return snapshot.fixture_features(fixtures(spark, sf), snapshot.latest_form(mf), snapshot.latest_h2h(mf))


def prior_predictions(spark, sf, keep_features=False):
    mf = features(spark, sf)
    train, _ = ml.split(ml.training_set(mf, NOTEBOOK), NOTEBOOK)
    return ml.score_prior(train, fixture_inputs(spark, sf, mf), NOTEBOOK, _as_of_mf(mf), keep_features)


def fixed_predictions(spark, sf, keep_features=False):
    """Fixtures scored by the fixed linear model: all three classes and
    distinct confidences occur."""
    mf = features(spark, sf)
    return ml.score(None, ml.fixed_predict(fixture_inputs(spark, sf, mf)), NOTEBOOK, _as_of_mf(mf), keep_features)


# ----------------------------------------------------------------- sources

def s01_read_csv(spark, sf):
    path = scratch_path(spark, "raw_results_csv")
    files.write_csv(raw_results(spark, sf).drop("match_id"), path)
    return files.read_csv(spark, path, RESULTS)


def s02_read_csv_inferred(spark, sf):
    path = scratch_path(spark, "raw_results_csv")
    files.write_csv(raw_results(spark, sf).drop("match_id"), path)
    return files.read_csv(spark, path, infer=True)


def s04_read_parquet(spark, sf):
    path = scratch_path(spark, "matches")
    files.write_table(matches(spark, sf), path)
    return files.read_parquet(spark, path)


def s05_write_partitioned(spark, sf):
    path = scratch_path(spark, "matches_by_year")
    m = matches(spark, sf).withColumn("year", F.year("date"))
    files.write_table(m, path, partition_by=["year"], sort_within=["date", "match_id"])
    return files.read_parquet(spark, path)


def s09_stg_fixtures(spark, sf):
    return fixtures(spark, sf)


def s11_round_trip(spark, sf):
    return files.write_counted(matches(spark, sf), scratch_path(spark, "matches_rt"), "matches")


def s11_round_trip_partitioned(spark, sf):
    m = matches(spark, sf).withColumn("year", F.year("date"))
    return files.write_counted(m, scratch_path(spark, "matches_rt"), "matches", partition_by=["year"], sort_within=["date", "match_id"])


def s12_preview(spark, sf):
    return files.preview(matches(spark, sf), 5, ["match_id"])


# ---------------------------------------------------------------- cleaning

def p10_clean_goalscorers(spark, sf):
    return clean.clean_goalscorers(adapter.raw_goalscorers(spark, sf))


def p11_clean_shootouts(spark, sf):
    return clean.clean_shootouts(adapter.raw_shootouts(spark, sf))


def p12_clean_matches(spark, sf):
    return cleaned(spark, sf)


def j05_names_by_validity(spark, sf):
    c = clean.clean_matches(raw_results(spark, sf), None, NOTEBOOK)
    return clean.normalise_names(c, adapter.former_names(spark, sf), respect_dates=True)


# ----------------------------------------------------------------- quality

def q01_null_counts(spark, sf):
    return quality.null_counts(clean.parse_results(raw_results(spark, sf)))


def q02_date_range(spark, sf):
    return quality.date_range(matches(spark, sf))


def q03_top_home_teams(spark, sf):
    return quality.top_values(matches(spark, sf), "home_team", 15)


def q04_distinct_teams(spark, sf):
    return quality.distinct_teams(matches(spark, sf))


def q05_class_distribution(spark, sf):
    return quality.class_distribution(matches(spark, sf))


def q06_feature_summary(spark, sf):
    return quality.column_summary(features(spark, sf), SUMMARY_COLS)


def q07_cleaning_report(spark, sf):
    return quality.cleaning_report(clean.parse_results(raw_results(spark, sf)), clean.keep_predicate())


def q08_forbidden_names(spark, sf):
    return quality.forbidden_names(cleaned(spark, sf), adapter.former_names(spark, sf))


def q09_row_contract(spark, sf):
    m = materialize(matches(spark, sf), "matches")
    mf = materialize(match_features(m, NOTEBOOK.with_(materialize_input=False)), "match_features")
    fx = fixtures(spark, sf)
    tables = {
        "raw_results": raw_results(spark, sf),
        "raw_goalscorers": adapter.raw_goalscorers(spark, sf),
        "raw_shootouts": adapter.raw_shootouts(spark, sf, m),
        "raw_former_names": adapter.former_names(spark, sf),
        "match_features": mf,
        "fixtures": fx,
        "mart_team_form": marts.mart_team_form(m),
        "mart_head_to_head": marts.mart_head_to_head(m),
        "mart_predictions_input": fixture_inputs(spark, sf, mf),
        "predictions": ml.fixed_predict(fixture_inputs(spark, sf, mf)),
    }
    return quality.row_contract(tables, ROW_MINIMUMS)


def _match_tests(spark, sf):
    return quality.column_tests(matches(spark, sf), "matches",
                                not_null=["match_id", "date", "home_team", "away_team", "result"],
                                unique=["match_id"], accepted={"result": RESULT_CODES})


def q10_column_tests(spark, sf):
    return _match_tests(spark, sf)


def q11_gate(spark, sf):
    """The tests pass the gate; it returns them."""
    return quality.gate(_match_tests(spark, sf))


def q12_test_summary(spark, sf):
    return quality.test_summary(_match_tests(spark, sf))


def q13_range_checks(spark, sf):
    return quality.range_checks(features(spark, sf, cols=None))


def q14_unmatched_teams(spark, sf):
    mf = match_features(cleaned(spark, sf), NOTEBOOK)
    return snapshot.unmatched_teams(fixtures(spark, sf), snapshot.latest_form(mf))


# ------------------------------------------------------ perspective, windows

def u01_team_view(spark, sf):
    return team_view(matches(spark, sf))


def w01_w15_rolling_features(spark, sf):
    from matchlab.schemas import EXTRA_FORM_COLS, TEAM_FEATURE_COLS
    tf = team_features(matches(spark, sf), NOTEBOOK)
    return tf.select("match_id", "date", "team", "opponent", "venue", *TEAM_FEATURE_COLS, *EXTRA_FORM_COLS)


def w16_w20_h2h_features(spark, sf):
    from matchlab.schemas import H2H_COLS
    return pair_features(matches(spark, sf), NOTEBOOK).select(
        "match_id", "date", "home_team", "away_team", "team_a", "team_b", *H2H_COLS)


# the same path with more ranges than the session has shuffle partitions, so
# that most histories cross range boundaries
BUCKETED = NOTEBOOK.with_(range_partitions=64)


def w01_w15_rolling_bucketed(spark, sf):
    from matchlab.schemas import EXTRA_FORM_COLS, TEAM_FEATURE_COLS
    tf = team_features(matches(spark, sf), BUCKETED)
    return tf.select("match_id", "date", "team", "opponent", "venue", *TEAM_FEATURE_COLS, *EXTRA_FORM_COLS)


def w16_w20_h2h_bucketed(spark, sf):
    from matchlab.schemas import H2H_COLS
    return pair_features(matches(spark, sf), BUCKETED).select(
        "match_id", "date", "home_team", "away_team", "team_a", "team_b", *H2H_COLS)


def _by_batches(spark, sf):
    """A feature store filled in three batches: matches before 1998, then
    those before 2000, with a tenth of 1996's held back until the last batch."""
    path = scratch_path(spark, "feature_store")
    m = materialize(matches(spark, sf), "matches")
    late = (F.year("date") == 1996) & (F.col("match_id") % 10 == 3)
    part = F.when(late, 2).when(F.year("date") < 1998, 0).when(F.year("date") < 2000, 1).otherwise(2)
    for k in range(3):
        incremental.advance(spark, path, k, m.where(part == k), NOTEBOOK)
    return path


def w01_w15_incremental(spark, sf):
    return incremental.team_features(spark, _by_batches(spark, sf))


def w16_w20_incremental(spark, sf):
    from matchlab.schemas import H2H_COLS
    return incremental.pair_features(spark, _by_batches(spark, sf)).select(
        "match_id", "date", "home_team", "away_team", "team_a", "team_b", *H2H_COLS)


def w10_w13_rolling_dag_preset(spark, sf):
    """The scheduled-job variant: prior frame [-360, -181] days and
    ranking_change = last6m - coalesce(prev6m, 0)."""
    from matchlab.config import DAG
    from matchlab.schemas import EXTRA_FORM_COLS, TEAM_FEATURE_COLS
    tf = team_features(matches(spark, sf), DAG)
    return tf.select("match_id", "date", "team", "opponent", "venue", *TEAM_FEATURE_COLS, *EXTRA_FORM_COLS)


def j02_j04_match_features(spark, sf):
    return features(spark, sf, reuse=False)


# ------------------------------------------------------- snapshots, reports

def l01_latest_home(spark, sf):
    return snapshot.latest_role(features(spark, sf, reuse=False), "home")


def l02_latest_away(spark, sf):
    return snapshot.latest_role(features(spark, sf, reuse=False), "away")


def j06_latest_form(spark, sf):
    return snapshot.latest_form(features(spark, sf, reuse=False))


def l03_latest_h2h(spark, sf):
    return snapshot.latest_h2h(features(spark, sf, reuse=False))


def l04_last_10(spark, sf):
    return reports.last_n(matches(spark, sf), 10)


def l05_form_summary(spark, sf):
    return reports.form_summary(reports.last_n(matches(spark, sf), 10))


def l06_h2h_all_time(spark, sf):
    return h2h.h2h_all_time(matches(spark, sf))


def l07_h2h_for_fixtures(spark, sf):
    return h2h.h2h_oriented(h2h.h2h_all_time(matches(spark, sf)), fixtures(spark, sf))


def l08_latest_form_home_first(spark, sf):
    return snapshot.latest_form_home_first(features(spark, sf, reuse=False))


def m13_fixture_features(spark, sf):
    return fixture_inputs(spark, sf)


def m15_live_pair_features(spark, sf):
    """Every ordered pair that has met, scored by the live rules; the pair's
    first match id is its id."""
    m = matches(spark, sf)
    pairs = m.groupBy("home_team", "away_team").agg(F.min("match_id").alias("fixture_id")).select(
        "fixture_id", F.lit("Custom").alias("group_name"), "home_team", "away_team",
        F.lit(None).cast("date").alias("match_date"))
    return snapshot.live_pair_features(pairs, features(spark, sf), h2h.h2h_all_time(m), NOTEBOOK)


def d02_stg_rankings(spark, sf):
    return marts.stg_rankings(matches(spark, sf))


def d04_mart_team_form(spark, sf):
    return marts.mart_team_form(matches(spark, sf))


# --------------------------------------------------------------------- ML

def m01_training_set(spark, sf):
    return ml.training_set(features(spark, sf, reuse=False), NOTEBOOK)


def m03_split_counts(spark, sf):
    ts = ml.training_set(features(spark, sf, reuse=False), NOTEBOOK)
    cut = int(round(NOTEBOOK.test_ratio * 10000))
    part = F.when(ml.split_bucket() < cut, "test").otherwise("train")
    return ts.groupBy(part.alias("part"), "label").agg(F.count(F.lit(1)).alias("n"))


def m04_scaler_stats(spark, sf):
    train, _ = train_test(spark, sf)
    return ml.scaler_stats(train)


def a04_feature_medians(spark, sf):
    train, _ = train_test(spark, sf)
    return ml.feature_medians(train)


def a05_label_mode(spark, sf):
    train, _ = train_test(spark, sf)
    return ml.label_mode(train)


def _prior_test(spark, sf):
    train, test = train_test(spark, sf)
    return train, test, ml.prior_predict(train, test)


def m08_baseline_metrics(spark, sf):
    return ml.accuracy_logloss(_prior_test(spark, sf)[2])


def m09_baseline_class_report(spark, sf):
    return ml.class_report(_prior_test(spark, sf)[2])


def m10_baseline_confusion(spark, sf):
    return ml.confusion(_prior_test(spark, sf)[2])


def m11_baseline_lift(spark, sf):
    train, test, pred = _prior_test(spark, sf)
    return ml.baseline_lift(train, test, pred)


def _fixed_test(spark, sf):
    train, test = train_test(spark, sf)
    return train, test, ml.fixed_predict(test)


def m08_fixed_metrics(spark, sf):
    return ml.accuracy_logloss(_fixed_test(spark, sf)[2])


def m09_fixed_class_report(spark, sf):
    return ml.class_report(_fixed_test(spark, sf)[2])


def m10_fixed_confusion(spark, sf):
    return ml.confusion(_fixed_test(spark, sf)[2])


def m11_fixed_lift(spark, sf):
    train, test, pred = _fixed_test(spark, sf)
    return ml.baseline_lift(train, test, pred)


def m15_scored_pairs(spark, sf):
    """Every ordered pair that has met, scored."""
    m = matches(spark, sf)
    return ml.score(None, ml.fixed_predict(m15_live_pair_features(spark, sf)), NOTEBOOK, m.select(F.max("date").cast("timestamp_ntz")).scalar())


# The driver's dates lie between 1995 and 2001, so the default cuts drop no row;
# these queries cut where rows are dropped.
CUT = NOTEBOOK.with_(min_date=_dt.date(1997, 7, 1), train_from=_dt.date(1999, 1, 1))


def p09_min_date(spark, sf):
    return match_features(matches(spark, sf), CUT)


def w10_before_cut(spark, sf):
    from matchlab.config import DAG
    from matchlab.schemas import EXTRA_FORM_COLS, TEAM_FEATURE_COLS
    tf = team_features(matches(spark, sf), DAG.with_(min_date=CUT.min_date))
    return tf.select("match_id", "date", "team", "opponent", "venue", *TEAM_FEATURE_COLS, *EXTRA_FORM_COLS)


def m01_training_cut(spark, sf):
    return ml.training_set(features(spark, sf, reuse=False), CUT)


def m02_imputed(spark, sf):
    """Nulls in one feature, filled with the median of the others."""
    train, _ = train_test(spark, sf)
    gaps = train.withColumn("home_win_rate_last10", F.when(F.col("match_id") % 7 != 0, F.col("home_win_rate_last10")))
    return ml.impute(gaps, [], NOTEBOOK)[0].select("match_id", "home_win_rate_last10", "away_win_rate_last10")


def j07_j08_unknown_teams(spark, sf):
    """Fixtures of a team without any match, and so of pairs without one."""
    mf = features(spark, sf).filter("home_team != 'NATION_12' AND away_team != 'NATION_12'")
    return fixture_inputs(spark, sf, mf)


def dated_fixtures(spark, sf):
    """Every fixture three times: at its date, and on two dates among the matches."""
    f = fixtures(spark, sf)
    dates = F.array(F.date_add(F.lit(_dt.date(1996, 1, 1)), (F.col("fixture_id") % 900).cast("int")),
                    F.date_add(F.lit(_dt.date(1999, 1, 1)), (F.col("fixture_id") % 700).cast("int")), F.col("match_date"))
    return f.select("group_name", "home_team", "away_team", F.posexplode(dates).alias("_k", "match_date"), "fixture_id").select(
        (F.col("fixture_id") * 10 + F.col("_k")).alias("fixture_id"), "group_name", "home_team", "away_team", "match_date")


def j07_j08_as_of(spark, sf):
    return asof.fixture_features_as_of(dated_fixtures(spark, sf), materialize(matches(spark, sf), "matches"), NOTEBOOK)


def m03_stratified_split(spark, sf):
    """The exact stratified split of the labelled matches, by id."""
    train, test = ml.stratified_split(ml.training_set(features(spark, sf, reuse=False), NOTEBOOK).select("match_id", "label"), NOTEBOOK)
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


def s11_content_check(spark, sf):
    m = matches(spark, sf).withColumn("year", F.year("date"))
    return files.write_verified(m, scratch_path(spark, "matches_rt"), "matches", partition_by=["year"], sort_within=["date", "match_id"])


def l10_ordered_files(spark, sf):
    """Every match with its place in date order, from files that follow each other."""
    path, order = scratch_path(spark, "matches_by_date"), ["date", "match_id"]
    files.write_ordered(matches(spark, sf).select("match_id", "date", "home_team", "away_team"), path, order)
    return files.read_ordered(spark, path, order)


def a06_result_strings(spark, sf):
    """Every team's results in the order of its matches, in parts of 100."""
    tv = team_view(matches(spark, sf)).withColumn("code", F.when(F.col("win") == 1, "W").when(F.col("draw") == 1, "D").otherwise("L"))
    return reports.ordered_string_parts(tv, ["team"], ["day", "match_id"], "code", "", "results", 100)


def l15_group_line_parts(spark, sf):
    return reports.group_lines(fixed_predictions(spark, sf), 4)


def p20_fixed_clock(spark, sf):
    """Predictions with the run's clock set to one moment."""
    clock = F.lit(_dt.datetime(2002, 6, 1, 6, 30)).cast("timestamp_ntz")
    return ml.score(None, ml.fixed_predict(fixture_inputs(spark, sf)), NOTEBOOK, clock)


def m17_drivers_fixed(spark, sf):
    train, _ = train_test(spark, sf)
    scored = reports.top_k(fixed_predictions(spark, sf, keep_features=True), 10)
    return ml.drivers(scored, ml.scaler_stats(train), ml.fixed_importance(spark), 5, "z")


def m18_drivers_raw(spark, sf):
    scored = reports.top_k(fixed_predictions(spark, sf, keep_features=True), 10)
    return ml.drivers(scored, None, ml.fixed_importance(spark), 5, "raw")


def m14_prior_predictions(spark, sf):
    return prior_predictions(spark, sf)


def l09_top_confidence(spark, sf):
    return reports.top_k(fixed_predictions(spark, sf), 10)


def l11_group_predictions(spark, sf):
    return reports.filter_predictions(fixed_predictions(spark, sf), group="ASIA")


def l11_pair_predictions(spark, sf):
    """A pair that meets: the teams of the first fixture, in the other order."""
    p = fixed_predictions(spark, sf)
    first = fixtures(spark, sf).agg(F.min_by(F.struct("away_team", "home_team"), "fixture_id").alias("f"))
    return reports.filter_predictions(p, pair=tuple(first.first()["f"]))


def l16_inventory(spark, sf):
    return reports.table_inventory(spark, {"matches": matches(spark, sf), "fixtures": fixtures(spark, sf)})


def l12_display_table(spark, sf):
    return reports.display_table(fixed_predictions(spark, sf))


def l13_standings(spark, sf):
    return reports.standings(fixed_predictions(spark, sf))


def l14_prediction_summary(spark, sf):
    return reports.prediction_summary(fixed_predictions(spark, sf))


def l15_group_lines(spark, sf):
    return reports.group_lines(fixed_predictions(spark, sf))


def j09_predictions_with_features(spark, sf):
    mf = features(spark, sf)
    ff = fixture_inputs(spark, sf, mf)
    return reports.with_features(ml.score(None, ml.fixed_predict(ff), NOTEBOOK, _as_of_mf(mf)), ff)


def m19_result_text(spark, sf):
    return ml.result_label(fixed_predictions(spark, sf)).select(
        "fixture_id", "home_team", "away_team", "predicted_result", "result_text")


# ------------------------------------------ model-dependent (rows-only check)

def _forest(spark, sf):
    """Feature table (built once), imputed train/test split, fitted forest."""
    mf = features(spark, sf)
    train, test = ml.split(ml.training_set(mf, NOTEBOOK), NOTEBOOK)
    return ml.fit(train, NOTEBOOK, "forest", medians=ml.impute_values(train, NOTEBOOK)), train, test, mf


def m05_forest_test_predictions(spark, sf):
    model, _, test, _ = _forest(spark, sf)
    return ml.predict(model, test).select("match_id", "label", "prediction", "predicted_result", *ml.PROB_COLS)


def m12_feature_importance(spark, sf):
    model, _, _, _ = _forest(spark, sf)
    return ml.feature_importance(model)


def _boosted(spark, sf):
    """Three-class boosted trees, with larger steps than the default and so fewer rounds."""
    train, test = train_test(spark, sf)
    return ml.fit(train, NOTEBOOK, "gbt", num_trees=30, rate=0.3, early_stopping_rounds=5, medians=ml.impute_values(train, NOTEBOOK)), test


def m05_boosted_test_predictions(spark, sf):
    model, test = _boosted(spark, sf)
    return ml.predict(model, test).select("match_id", "label", "prediction", "predicted_result", *ml.PROB_COLS)


def m06_boosted_rounds(spark, sf):
    """The validation loss after each round that was grown, and whether the round stays."""
    model, _ = _boosted(spark, sf)
    return spark.createDataFrame([(n, x, n <= model.best_iteration) for n, x in enumerate(model.losses, 1)],
                                 "round int, validation_log_loss double, kept boolean")


def m07_fixed_trees(spark, sf):
    """Classes and probabilities by a fixed tree ensemble, for all labelled matches."""
    p = ml.predict(ml.fixed_trees(), ml.training_set(features(spark, sf, reuse=False), NOTEBOOK))
    return p.select("match_id", "prediction", "predicted_result", *[F.round(c, 9).alias(c) for c in ml.PROB_COLS])


def m12_boosted_importance(spark, sf):
    return ml.feature_importance(_boosted(spark, sf)[0])


def m14_score_fixtures(spark, sf):
    model, _, _, mf = _forest(spark, sf)
    return ml.score(model, fixture_inputs(spark, sf, mf), NOTEBOOK, _as_of_mf(mf))


def m17_drivers(spark, sf):
    model, train, _, mf = _forest(spark, sf)
    scored = ml.score(model, fixture_inputs(spark, sf, mf), NOTEBOOK, _as_of_mf(mf), keep_features=True)
    return ml.drivers(reports.top_k(scored, 10), ml.scaler_stats(train), ml.feature_importance(model), 5, "z")


QUERIES = {name: fn for name, fn in dict(globals()).items()
           if callable(fn) and name[:1] in "sjpqulwdmal" and name[1:2].isdigit()}
