"""Snapshots, fixture assembly, reports."""

import datetime as dt

from match_cases import make_matches, rows
from matchlab.config import NOTEBOOK
from matchlab.operators import reports, snapshot
from matchlab.operators.features import match_features
from matchlab.operators.h2h import h2h_all_time, h2h_oriented
from matchlab.schemas import FEATURE_COLS

CFG = NOTEBOOK.with_(materialize_input=False, min_date=None)


def _fixtures(spark, pairs):
    recs = [(i + 1, "G", h, a, dt.date(2026, 6, 11)) for i, (h, a) in enumerate(pairs)]
    return spark.createDataFrame(recs, "fixture_id bigint, group_name string, home_team string, "
                                       "away_team string, match_date date")


def test_one_sided_snapshot_and_unknown_team(spark):
    # H only ever plays at home, W only away; U never plays
    data = [(1, "2000-01-01", "H", "W", 2, 0), (2, "2000-02-01", "H", "W", 0, 0),
            (3, "2000-03-01", "H", "W", 1, 2)]
    mf = match_features(make_matches(spark, data), CFG)
    form = snapshot.latest_form(mf)
    got = {r["team"]: r for r in form.collect()}
    assert set(got) == {"H", "W"}
    # latest home row of H is match 3: form before it = 1 win, 1 draw of 2
    assert got["H"]["win_rate_last10"] == 0.5
    fx = _fixtures(spark, [("U", "H")])
    ff = snapshot.fixture_features(fx, form, snapshot.latest_h2h(mf), CFG).first()
    assert ff["home_win_rate_last10"] == 0.33 and ff["home_draw_rate_last10"] == 0.33
    assert ff["home_avg_goals_scored_last20"] == 0.0 and ff["home_ranking_proxy"] == 0.0
    assert ff["h2h_team_a_win_rate"] == 0.33 and ff["h2h_total"] == 0
    assert rows(snapshot.unmatched_teams(fx, form)) == [("U",)]


def test_pair_flip_and_clamp(spark):
    form = spark.createDataFrame([], "team string, " + ", ".join(
        f"{s} double" for s in ["win_rate_last10", "draw_rate_last10", "avg_goals_scored_last20",
                                 "avg_goals_conceded_last20", "avg_goal_diff_last10", "goal_diff_trend",
                                 "ranking_proxy", "ranking_change"]))
    h2h = spark.createDataFrame([("A", "B", 0.9, 10), ("C", "D", 0.2, 5)],
                                "team_a string, team_b string, h2h_team_a_win_rate double, h2h_total bigint")
    fx = _fixtures(spark, [("A", "B"), ("B", "A"), ("C", "D"), ("D", "C")])
    got = {r["fixture_id"]: r["h2h_team_a_win_rate"]
           for r in snapshot.fixture_features(fx, form, h2h, CFG).collect()}
    assert got[1] == 0.9
    assert got[2] == 0.0                       # 1 - 0.9 - 0.25 < 0 -> clamped
    assert got[3] == 0.2
    assert abs(got[4] - 0.55) < 1e-12
    unclamped = {r["fixture_id"]: r["h2h_team_a_win_rate"] for r in snapshot.fixture_features(
        fx, form, h2h, CFG.with_(h2h_flip_clamp=False)).collect()}
    assert abs(unclamped[2] - (-0.15)) < 1e-12
    assert snapshot.fixture_features(fx, form, h2h, CFG).columns[5:] == FEATURE_COLS


def test_last_n_and_form_string(spark):
    data = [(i, f"2000-01-{i:02d}", "A", "B", i % 3, 1) for i in range(1, 13)]
    last = reports.last_n(make_matches(spark, data), 10)
    a = last.filter("team = 'A'").orderBy("rn").collect()
    assert [r["match_id"] for r in a] == list(range(12, 2, -1))
    s = {r["team"]: r for r in reports.form_summary(last).collect()}
    assert s["A"]["n"] == 10 and s["A"]["form"][0] == "L"   # match 12: 0-1 -> L for A
    assert s["B"]["form"][0] == "W"                         # flipped for the away side


def test_h2h_all_time_oriented(spark):
    data = [(1, "2000-01-01", "B", "A", 2, 0), (2, "2000-02-01", "A", "B", 1, 1), (3, "2000-03-01", "A", "B", 3, 0)]
    rec = h2h_all_time(make_matches(spark, data))
    assert rows(rec, "team_a", "team_b", "team_a_wins", "team_b_wins", "draws", "total") == [("A", "B", 1, 1, 1, 3)]
    pairs = spark.createDataFrame([("B", "A"), ("X", "Y")], "home_team string, away_team string")
    o = {r["home_team"]: r for r in h2h_oriented(rec, pairs).collect()}
    assert (o["B"]["home_wins"], o["B"]["away_wins"], o["B"]["total"]) == (1, 1, 3)
    assert o["X"]["total"] == 0


def test_standings(spark):
    preds = spark.createDataFrame(
        [(1, "A", "T1", "T2", "W"), (2, "A", "T3", "T1", "L"), (3, "A", "T2", "T3", "D"),
         (4, "B", "T4", "T5", "D"), (5, "B", "T6", "T4", "D"), (6, "B", "T5", "T6", "D")],
        "fixture_id bigint, group_name string, home_team string, away_team string, predicted_result string")
    got = rows(reports.standings(preds))
    assert got == [("A", "T1", 2), ("A", "T2", 0), ("A", "T3", 0),
                   ("B", "T4", 0), ("B", "T5", 0), ("B", "T6", 0)]


def test_latest_by_role_matches_per_role(spark):
    from matchlab.sources import adapter
    from match_cases import SF001
    mf = match_features(adapter.matches(spark, SF001), CFG)
    both = snapshot.latest_by_role(mf)
    for role in ("home", "away"):
        a = sorted(rows(both.filter(both.role == role).drop("role")))
        b = sorted(rows(snapshot.latest_role(mf, role)))
        assert a == b and len(a) == 25
