"""Marts (D01-D06): the staging and mart tables the original builds with an
external SQL tool whose model files are absent; these follow the
documented purpose of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.functions.columns import parse_date
from matchlab.operators.clean import clean_matches
from matchlab.operators.h2h import h2h_all_time
from matchlab.operators.perspective import team_view
from matchlab.operators.reports import last_n
from matchlab.operators.skew import running_total
from matchlab.operators.snapshot import fixture_features


def stg_match_results(raw: DataFrame, former_names=None, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """Typed, cleaned match rows with W/D/L."""
    return clean_matches(raw, former_names, cfg)


def stg_rankings(matches: DataFrame, days: int = 365, points=(3, 1, 0)) -> DataFrame:
    """Strength over the last ``days`` days of data: points per match
    (win/draw/loss points are a parameter; the original formula is not
    available), matches, and the competition rank by points per match
    (ties share a rank; then by team for display). The rank is
    1 + number of teams with a higher score, computed over the distinct
    score values (a pre-aggregated table) rather than one window over all
    teams."""
    pw, pd_, pl = points
    tv = team_view(matches)
    last_day = tv.select(F.max("day")).scalar()  # scalar subquery, run once
    recent = tv.filter(F.col("day") > last_day - days)
    per_team = recent.groupBy("team").agg(
        F.count(F.lit(1)).alias("matches"),
        F.sum(F.col("win") * pw + F.col("draw") * pd_ + F.col("loss") * pl).alias("points"))
    per_team = per_team.withColumn("points_per_match", F.round(F.col("points") / F.col("matches"), 6))
    scores = per_team.groupBy("points_per_match").agg(F.count(F.lit(1)).alias("_k"))
    better = running_total(scores, [], "points_per_match", "_k", "_higher", descending=True,
                           inclusive=False).select("points_per_match", (F.col("_higher") + 1).alias("strength_rank"))
    return per_team.join(better, on="points_per_match").select(
        "team", "matches", "points", "points_per_match", "strength_rank")


def stg_fixtures(fixtures_raw: DataFrame) -> DataFrame:
    """D03 (S09): fixture seed renamed (match_id -> fixture_id,
    group -> group_name), trimmed, date parsed."""
    return fixtures_raw.select(
        F.col("match_id").cast("bigint").alias("fixture_id"),
        F.trim("group").alias("group_name"),
        F.trim("home_team").alias("home_team"),
        F.trim("away_team").alias("away_team"),
        parse_date("match_date").alias("match_date"))


def mart_team_form(matches: DataFrame, sizes=(10, 20)) -> DataFrame:
    """Per team, wins/draws/losses/goals over its last 10 and last 20
    matches (one limited window at the larger size, conditional sums)."""
    n = max(sizes)
    last = last_n(matches, n)
    gf = F.when(F.col("home_team") == F.col("team"), F.col("home_score")).otherwise(F.col("away_score"))
    ga = F.when(F.col("home_team") == F.col("team"), F.col("away_score")).otherwise(F.col("home_score"))
    last = last.select("*", gf.alias("_gf"), ga.alias("_ga"))
    aggs = []
    for k in sizes:
        inside = F.col("rn") <= k
        r = F.col("team_result")
        aggs += [
            F.count_if(inside).alias(f"matches_last{k}"),
            F.count_if(inside & (r == "W")).alias(f"wins_last{k}"),
            F.count_if(inside & (r == "D")).alias(f"draws_last{k}"),
            F.count_if(inside & (r == "L")).alias(f"losses_last{k}"),
            F.sum(F.when(inside, F.col("_gf"))).alias(f"goals_for_last{k}"),
            F.sum(F.when(inside, F.col("_ga"))).alias(f"goals_against_last{k}"),
        ]
    return last.groupBy("team").agg(*aggs)


def mart_head_to_head(matches: DataFrame) -> DataFrame:
    """All-time record per alphabetical pair."""
    return h2h_all_time(matches)


def mart_predictions_input(fixtures: DataFrame, form: DataFrame, h2h: DataFrame,
                           cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """One row per fixture with every model input."""
    return fixture_features(fixtures, form, h2h, cfg)
