"""Match -> team perspective (U01, U02) and the small melt/union helpers
of the reports (U03, U04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matchlab.functions.columns import day_number


def _side(team, opp, gf, ga, win_code, loss_code, venue):
    r = F.col("result")
    return F.struct(
        F.col(team).alias("team"),
        F.col(opp).alias("opponent"),
        F.col(gf).alias("goals_for"),
        F.col(ga).alias("goals_against"),
        F.when(r == win_code, 1).otherwise(0).alias("win"),
        F.when(r == "D", 1).otherwise(0).alias("draw"),
        F.when(r == loss_code, 1).otherwise(0).alias("loss"),
        F.lit(venue).alias("venue"),
    )


def team_view(matches: DataFrame) -> DataFrame:
    """U01+U02: two rows per match (home view, away view) from ONE scan via
    ``inline(array(struct, struct))`` (a Generate node, no Union of two
    scans). Adds ``day`` (days since epoch) and ``gd``.

    Columns: match_id, date, day, team, opponent, goals_for,
    goals_against, win, draw, loss, venue, neutral, tournament, gd.
    """
    home = _side("home_team", "away_team", "home_score", "away_score", "W", "L", "home")
    away = _side("away_team", "home_team", "away_score", "home_score", "L", "W", "away")
    tv = matches.select("match_id", "date", "neutral", "tournament",
                        F.inline(F.array(home, away)))
    return tv.select(
        "match_id", "date", day_number("date").alias("day"),
        "team", "opponent", "goals_for", "goals_against", "win", "draw", "loss",
        "venue", "neutral", "tournament",
        (F.col("goals_for") - F.col("goals_against")).alias("gd"),
    )


def predicted_wins(predictions: DataFrame) -> DataFrame:
    """Predicted home wins (W) and away wins (L) per team, summed.
    One pass: each prediction emits at most one (team, 1) row."""
    r = F.col("predicted_result")
    winner = F.when(r == "W", F.col("home_team")).when(r == "L", F.col("away_team"))
    return (predictions.select(winner.alias("team")).filter(F.col("team").isNotNull())
            .groupBy("team").agg(F.count(F.lit(1)).alias("predicted_wins")))


def group_members(predictions: DataFrame) -> DataFrame:
    """Melt (home_team, away_team) -> (group_name, team), distinct."""
    return (predictions.select("group_name", "home_team", "away_team")
            .unpivot("group_name", ["home_team", "away_team"], "side", "team")
            .select("group_name", "team").distinct())
