"""Latest-per-key snapshots and fixture feature assembly
(L01-L03, L08, J06-J08, M13).

"Latest" is the row with the greatest (date, match_id); ties on the date
are broken by match_id. Each snapshot is one ``max_by`` aggregate, so the
shuffle carries one partial row per key and map task (a hot team costs
nothing extra).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.functions.columns import neutral_default, pair_a, pair_b
from matchlab.schemas import FEATURE_COLS, SNAPSHOT_STEMS



def _order():
    return F.struct(F.col("date"), F.col("match_id"))


def _role_rows(mf: DataFrame) -> DataFrame:
    """match_features -> one row per (match, role) with the role's stems."""
    def side(role):
        return F.struct(F.col(f"{role}_team").alias("team"), F.lit(role).alias("role"),
                        *[F.col(f"{role}_{s}").alias(s) for s in SNAPSHOT_STEMS])
    return mf.select("date", "match_id", F.inline(F.array(side("home"), side("away"))))


def latest_by_role(mf: DataFrame) -> DataFrame:
    """L01+L02 in one aggregate: team, role, and the 8 stems of the team's
    latest row in that role."""
    r = _role_rows(mf)
    vals = F.struct(*[F.col(s) for s in SNAPSHOT_STEMS])
    return (r.groupBy("team", "role").agg(F.max_by(vals, _order()).alias("_v"))
            .select("team", "role", *[F.col("_v")[s].alias(s) for s in SNAPSHOT_STEMS]))


def latest_role(mf: DataFrame, role: str) -> DataFrame:
    """L01 (role='home') / L02 (role='away'): team + 8 stems."""
    t = F.col(f"{role}_team")
    vals = F.struct(*[F.col(f"{role}_{s}").alias(s) for s in SNAPSHOT_STEMS])
    return (mf.filter(t.isNotNull()).groupBy(t.alias("team"))
            .agg(F.max_by(vals, _order()).alias("_v"))
            .select("team", *[F.col("_v")[s].alias(s) for s in SNAPSHOT_STEMS]))


def latest_form(mf: DataFrame) -> DataFrame:
    """Per team, the mean of its latest home-role and latest
    away-role snapshots (one side alone when only one exists).
    Single aggregate over both roles; no outer join needed."""
    r = _role_rows(mf)
    vals = F.struct(*[F.col(s) for s in SNAPSHOT_STEMS])
    home = F.max_by(F.when(F.col("role") == "home", vals), F.when(F.col("role") == "home", _order()))
    away = F.max_by(F.when(F.col("role") == "away", vals), F.when(F.col("role") == "away", _order()))
    g = r.groupBy("team").agg(home.alias("_h"), away.alias("_a"))

    def mean(s):
        h, a = F.col("_h")[s], F.col("_a")[s]
        return F.coalesce((h + a) / 2.0, h, a).alias(s)
    return g.select("team", *[mean(s) for s in SNAPSHOT_STEMS])


def latest_form_home_first(mf: DataFrame) -> DataFrame:
    """Per team, the latest home-role snapshot, else the latest
    away-role one (the live scorer's rule)."""
    r = _role_rows(mf)
    vals = F.struct(*[F.col(s) for s in SNAPSHOT_STEMS])
    home = F.max_by(F.when(F.col("role") == "home", vals), F.when(F.col("role") == "home", _order()))
    away = F.max_by(F.when(F.col("role") == "away", vals), F.when(F.col("role") == "away", _order()))
    g = r.groupBy("team").agg(home.alias("_h"), away.alias("_a"))
    return g.select("team", *[F.coalesce(F.col("_h")[s], F.col("_a")[s]).alias(s)
                              for s in SNAPSHOT_STEMS])


def latest_h2h(mf: DataFrame) -> DataFrame:
    """Per canonical pair, h2h_team_a_win_rate and h2h_total of the
    pair's latest match (the record before that match)."""
    ta = pair_a("home_team", "away_team")
    tb = pair_b("home_team", "away_team")
    vals = F.struct("h2h_team_a_win_rate", "h2h_total")
    return (mf.groupBy(ta.alias("team_a"), tb.alias("team_b"))
            .agg(F.max_by(vals, _order()).alias("_v"))
            .select("team_a", "team_b", F.col("_v.h2h_team_a_win_rate").alias("h2h_team_a_win_rate"),
                    F.col("_v.h2h_total").alias("h2h_total")))


def fixture_features(fixtures: DataFrame, form: DataFrame, h2h: DataFrame,
                     cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """J07+J08 (M13): one row per fixture with the 18 model inputs.

    ``fixtures``: fixture_id, group_name, home_team, away_team, match_date.
    ``form``: team + 8 stems (``latest_form``). ``h2h``: team_a, team_b,
    h2h_team_a_win_rate, h2h_total (``latest_h2h``).
    A team without form gets the neutral defaults; a pair without h2h gets
    rate ``h2h_default`` and total 0; when the home side is team_b the
    rate is flipped to 1 - r - flip_constant (clamped at 0 when enabled).
    """
    def side(prefix):
        return form.select(F.col("team").alias(f"{prefix}_team"),
                           *[F.col(s).alias(f"_{prefix}_{s}") for s in SNAPSHOT_STEMS])

    f = (fixtures.join(side("home"), on="home_team", how="left")
         .join(side("away"), on="away_team", how="left"))
    h, a = F.col("home_team"), F.col("away_team")
    f = f.withColumn("_ta", pair_a(h, a)).withColumn("_tb", pair_b(h, a))
    hh = h2h.select(F.col("team_a").alias("_ta"), F.col("team_b").alias("_tb"),
                    F.col("h2h_team_a_win_rate").alias("_r"), F.col("h2h_total").alias("_n"))
    return assemble(f.join(hh, on=["_ta", "_tb"], how="left"), cfg)


def assemble(f: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """The 18 model inputs of fixtures with ``_home_*`` and ``_away_*`` stems,
    ``_ta`` (the pair's first team), ``_r`` and ``_n`` (its rate and total)."""
    h = F.col("home_team")
    flipped = 1.0 - F.col("_r") - cfg.h2h_flip_constant
    if cfg.h2h_flip_clamp:
        flipped = F.greatest(F.lit(0.0), flipped)
    rate = (F.when(F.col("_r").isNull(), F.lit(cfg.h2h_default))
            .when(h == F.col("_ta"), F.col("_r")).otherwise(flipped))
    feats = {}
    for s in SNAPSHOT_STEMS:
        for p in ("home", "away"):
            feats[f"{p}_{s}"] = F.coalesce(F.col(f"_{p}_{s}"),
                                           neutral_default(s, cfg.unknown_rate, cfg.unknown_other))
    feats["h2h_team_a_win_rate"] = rate
    feats["h2h_total"] = F.coalesce(F.col("_n"), F.lit(0).cast("bigint"))
    return f.select("fixture_id", "group_name", "home_team", "away_team", "match_date",
                    *[feats[c].alias(c) for c in FEATURE_COLS])


def unmatched_teams(fixtures: DataFrame, form: DataFrame) -> DataFrame:
    """Q14: fixture teams with no form snapshot (left anti join)."""
    teams = (fixtures.select(F.col("home_team").alias("team"))
             .union(fixtures.select(F.col("away_team").alias("team"))).distinct())
    return teams.join(form.select("team"), on="team", how="left_anti")


def all_time_rate(record: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """The live scorer's h2h input: all meetings of a pair (``h2h_all_time``)
    as team_a, team_b, h2h_team_a_win_rate (``h2h_default`` without a
    meeting), h2h_total."""
    t = F.col("total")
    return record.select("team_a", "team_b",
                         F.when(t > 0, F.col("team_a_wins") / t).otherwise(F.lit(cfg.h2h_default))
                         .alias("h2h_team_a_win_rate"),
                         t.alias("h2h_total"))


def live_pair_features(pairs: DataFrame, mf: DataFrame, record: DataFrame,
                       cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """Model inputs for any table of pairs (fixture_id, group_name,
    home_team, away_team, match_date) by the live rules: latest home-role
    form else away-role form (L08), h2h over all meetings (L06), flipped
    and clamped for the away-listed team."""
    return fixture_features(pairs, latest_form_home_first(mf), all_time_rate(record, cfg), cfg)
