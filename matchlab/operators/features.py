"""Master feature table (J02-J04, P13, P14): one row per match with the
home team's and the away team's form before the match and the pair's
head-to-head record before the match.

Keys are ``match_id`` everywhere, so a team playing twice on one day
does not fan out (row count out = match rows in).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.operators.h2h import h2h_features
from matchlab.operators.perspective import team_view
from matchlab.operators.rolling import rolling_features
from matchlab.session import materialize
from matchlab.schemas import EXTRA_FORM_COLS, H2H_COLS, TEAM_FEATURE_COLS

BASE_COLS = ["match_id", "date", "home_team", "away_team", "home_score", "away_score",
             "goal_diff", "result", "tournament", "neutral"]
SIDE_COLS = TEAM_FEATURE_COLS + EXTRA_FORM_COLS


def side_columns(prefix: str):
    return [f"{prefix}_{c}" for c in SIDE_COLS]


def feature_columns():
    return side_columns("home") + side_columns("away") + ["team_a", "team_b"] + H2H_COLS


def prepare_input(matches: DataFrame, cfg: FeatureConfig = NOTEBOOK):
    """The match input of a feature build and the config to build with:
    the "before" date cut applied, and the table written once to the shared
    checkpoint folder (it feeds several branches)."""
    m = matches.select(*BASE_COLS)
    if cfg.min_date is not None and cfg.min_date_applied == "before":
        m = m.filter(F.col("date") >= F.lit(cfg.min_date))
    if cfg.materialize_input:
        m, cfg = materialize(m, "matches"), cfg.with_(materialize_input=False)
    return m, cfg


def team_features(matches: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """Team view + rolling features (one row per match and side)."""
    m, cfg = prepare_input(matches, cfg)
    return rolling_features(team_view(m), cfg)


def pair_features(matches: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """Head-to-head before every match (one row per match)."""
    m, cfg = prepare_input(matches, cfg)
    return h2h_features(m, cfg)


def sides_to_match(tf: DataFrame) -> DataFrame:
    """J02+J03 as one aggregation: the two team rows of a match become the
    home_* and away_* columns (one shuffle by match_id instead of two
    joins)."""
    v = F.col("venue")
    aggs = [F.max(F.when(v == side, F.col(c))).alias(f"{side}_{c}")
            for side in ("home", "away") for c in SIDE_COLS]
    return tf.groupBy("match_id").agg(*aggs)


def match_features(matches: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """Columns: BASE_COLS, home_*, away_* (14 form columns + win_rate_prev10
    each), team_a, team_b, five h2h columns."""
    m, cfg = prepare_input(matches, cfg)
    sides = sides_to_match(rolling_features(team_view(m), cfg))
    h2h = h2h_features(m, cfg)
    out = h2h.join(sides, on="match_id", how="left")
    num = [c for c in side_columns("home") + side_columns("away")]
    out = out.fillna(cfg.fill, subset=num)
    if cfg.min_date is not None and cfg.min_date_applied == "after":
        out = out.filter(F.col("date") >= F.lit(cfg.min_date))
    return out.select(*BASE_COLS, *feature_columns())
