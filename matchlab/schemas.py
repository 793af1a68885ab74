"""Fixed schemas, feature lists and label codes."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw CSV schemas (column order is the file order); every field is read as
# the type the cleaning step expects to parse from.
RESULTS = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("home_team", T.StringType()),
    T.StructField("away_team", T.StringType()),
    T.StructField("home_score", T.IntegerType()),
    T.StructField("away_score", T.IntegerType()),
    T.StructField("tournament", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("neutral", T.StringType()),
])

GOALSCORERS = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("home_team", T.StringType()),
    T.StructField("away_team", T.StringType()),
    T.StructField("team", T.StringType()),
    T.StructField("scorer", T.StringType()),
    T.StructField("minute", T.DoubleType()),
    T.StructField("own_goal", T.StringType()),
    T.StructField("penalty", T.StringType()),
])

SHOOTOUTS = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("home_team", T.StringType()),
    T.StructField("away_team", T.StringType()),
    T.StructField("winner", T.StringType()),
    T.StructField("first_shooter", T.StringType()),
])

FORMER_NAMES = T.StructType([
    T.StructField("current", T.StringType()),
    T.StructField("former", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()),
])

FIXTURES = T.StructType([
    T.StructField("match_id", T.IntegerType()),
    T.StructField("home_team", T.StringType()),
    T.StructField("away_team", T.StringType()),
    T.StructField("group", T.StringType()),
    T.StructField("match_date", T.StringType()),
])

# The per-team form columns, in the original order.
FORM_COLS = [
    "win_rate_last10", "draw_rate_last10", "loss_rate_last10",
    "avg_goals_scored_last20", "avg_goals_conceded_last20",
    "avg_gd_last5", "avg_gd_prev5", "goal_diff_trend",
    "avg_goal_diff_last10", "form_last6m", "form_prev6m",
    "ranking_proxy", "ranking_change",
]
# declared but unused frame of the original (matches 11-20 ago), exposed
EXTRA_FORM_COLS = ["win_rate_prev10"]
TEAM_FEATURE_COLS = FORM_COLS + ["matches_available"]

# The eight snapshot stems, in the original order.
SNAPSHOT_STEMS = [
    "win_rate_last10", "draw_rate_last10",
    "avg_goals_scored_last20", "avg_goals_conceded_last20",
    "avg_goal_diff_last10", "goal_diff_trend",
    "ranking_proxy", "ranking_change",
]

# Model input order = home_/away_ per stem, then the h2h pair.
FEATURE_COLS = [f"{side}_{stem}" for stem in SNAPSHOT_STEMS for side in ("home", "away")] + [
    "h2h_team_a_win_rate", "h2h_total",
]

H2H_COLS = ["h2h_team_a_wins", "h2h_team_b_wins", "h2h_draws", "h2h_total", "h2h_team_a_win_rate"]

# Label codes (home perspective).
LABEL_MAP = {"W": 0, "D": 1, "L": 2}
