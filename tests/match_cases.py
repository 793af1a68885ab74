"""Helpers of the match engine's tests."""

SF001 = "/root/testdata/sf0.001"


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]


def make_matches(spark, data):
    """data: (match_id, 'yyyy-mm-dd', home, away, home_score, away_score)."""
    import datetime as dt
    from matchlab.functions.columns import goal_diff, result_code
    recs = [(mid, dt.date.fromisoformat(d), h, a, hs, as_, "T", False) for mid, d, h, a, hs, as_ in data]
    df = spark.createDataFrame(recs, "match_id bigint, date date, home_team string, away_team string, "
                                     "home_score bigint, away_score bigint, tournament string, neutral boolean")
    return df.select("*", goal_diff("home_score", "away_score").alias("goal_diff"),
                     result_code("home_score", "away_score").alias("result"))
