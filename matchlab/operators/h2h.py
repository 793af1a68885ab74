"""Head-to-head: cumulative record of a pair before each match (W16-W20),
all-time record per pair (L06) and its orientation to a home side (L07).

The cumulative sums are additive, so the ranged strategy (see ``rolling``)
needs no row history: running sums within (pair, range) plus the sums of
the pair's earlier ranges (a window over one row per pair and range).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.functions.columns import day_number, flip_result, pair_a, pair_b
from matchlab.operators.skew import ranged

PAIR = ["team_a", "team_b"]
_COUNTS = [("a_won", "h2h_team_a_wins"), ("b_won", "h2h_team_b_wins"), ("is_draw", "h2h_draws")]


def pair_outcomes(matches: DataFrame) -> DataFrame:
    """Canonical pair (P15) and per-match outcome flags from team_a's side."""
    h, a, r = F.col("home_team"), F.col("away_team"), F.col("result")
    ta, tb = pair_a(h, a), pair_b(h, a)
    from_a = F.when(h == ta, r).otherwise(flip_result(r))      # the result as team_a sees it
    flag = lambda code: F.when(from_a == code, 1).otherwise(0)
    return matches.select("*", ta.alias("team_a"), tb.alias("team_b"), flag("W").alias("a_won"),
                          flag("L").alias("b_won"), flag("D").alias("is_draw"))


def _rate(cfg: FeatureConfig):
    t = F.col("h2h_total")
    return F.when(t > 0, F.col("h2h_team_a_wins") / t).otherwise(F.lit(cfg.h2h_default))


def _h2h_plain(base: DataFrame) -> DataFrame:
    w = Window.partitionBy(*PAIR).orderBy("_day", "match_id").rowsBetween(
        Window.unboundedPreceding, -1)
    return base.select(
        "*",
        *[F.coalesce(F.sum(c).over(w), F.lit(0)).cast("bigint").alias(n) for c, n in _COUNTS],
        F.count(F.lit(1)).over(w).alias("h2h_total"),
    )


def _h2h_ranged(base: DataFrame, cfg: FeatureConfig, start: DataFrame | None = None) -> DataFrame:
    """``start``: totals of pairs before the rows of ``base`` (the flag columns and ``n``)."""
    part = PAIR + ["_range"]
    r = ranged(base, PAIR + ["_day", "match_id"], cfg.range_partitions)
    w = Window.partitionBy(*part).orderBy("_day", "match_id").rowsBetween(Window.unboundedPreceding, -1)
    a = r.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_i_{c}") for c, _ in _COUNTS],
                 F.count(F.lit(1)).over(w).alias("_i_n"))
    # sums of ranges from the input (partial aggregation)
    sums = r.groupBy(*part).agg(*[F.sum(c).alias(f"_b_{c}") for c, _ in _COUNTS], F.count(F.lit(1)).alias("_b_n"))
    flags = [c for c, _ in _COUNTS] + ["n"]
    if start is not None:       # as a range before all others
        sums = sums.unionByName(start.select(*PAIR, F.lit(-1).alias("_range"), *[F.col(c).alias(f"_b_{c}") for c in flags]))
    wa = Window.partitionBy(*PAIR).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*part, *[F.coalesce(F.sum(f"_b_{c}").over(wa), F.lit(0)).alias(f"_p_{c}") for c in flags])
    return a.join(before, on=part, how="inner").select(
        *base.columns,
        *[(F.col(f"_p_{c}") + F.col(f"_i_{c}")).cast("bigint").alias(n) for c, n in _COUNTS],
        (F.col("_p_n") + F.col("_i_n")).cast("bigint").alias("h2h_total"),
    )


def running_record(base: DataFrame, start: DataFrame | None, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """``h2h_features`` of rows with pair, outcome flags and ``_day``, counted on
    from the totals in ``start``."""
    return _h2h_ranged(base, cfg, start).withColumn("h2h_team_a_win_rate", _rate(cfg)).drop("a_won", "b_won", "is_draw", "_day")


def h2h_features(matches: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """Adds team_a, team_b, h2h_team_a_wins, h2h_team_b_wins, h2h_draws,
    h2h_total (bigint, 0 before the first meeting) and
    h2h_team_a_win_rate (``cfg.h2h_default`` before the first meeting) to
    every match row, counting only earlier meetings (day, match_id).
    Strategies as in ``rolling``."""
    base = pair_outcomes(matches).withColumn("_day", day_number("date"))
    if cfg.strategy == "window":
        out = _h2h_plain(base)
    elif cfg.strategy == "ranged":
        out = _h2h_ranged(base, cfg)
    else:
        raise ValueError(f"unknown strategy {cfg.strategy!r}")
    return out.withColumn("h2h_team_a_win_rate", _rate(cfg)).drop("a_won", "b_won", "is_draw", "_day")


def h2h_all_time(matches: DataFrame) -> DataFrame:
    """All meetings per canonical pair: team_a, team_b, team_a_wins,
    team_b_wins, draws, total. Partial aggregation before the shuffle, so
    a hot pair costs one row per map task."""
    p = pair_outcomes(matches)
    return p.groupBy(*PAIR).agg(
        F.sum("a_won").cast("bigint").alias("team_a_wins"),
        F.sum("b_won").cast("bigint").alias("team_b_wins"),
        F.sum("is_draw").cast("bigint").alias("draws"),
        F.count(F.lit(1)).alias("total"),
    )


def h2h_oriented(record: DataFrame, pairs: DataFrame) -> DataFrame:
    """The all-time record seen from a requested home side.
    ``pairs`` has home_team, away_team; output adds home_wins, away_wins,
    draws, total (0 when the pair never met)."""
    h, a = F.col("home_team"), F.col("away_team")
    keyed = pairs.select("*", pair_a(h, a).alias("_ta"), pair_b(h, a).alias("_tb"))
    r = record.select(F.col("team_a").alias("_ta"), F.col("team_b").alias("_tb"),
                      "team_a_wins", "team_b_wins", "draws", "total")
    j = keyed.join(r, on=["_ta", "_tb"], how="left")
    home_is_a = h == F.col("_ta")
    return j.select(
        *pairs.columns,
        F.coalesce(F.when(home_is_a, F.col("team_a_wins")).otherwise(F.col("team_b_wins")), F.lit(0)).alias("home_wins"),
        F.coalesce(F.when(home_is_a, F.col("team_b_wins")).otherwise(F.col("team_a_wins")), F.lit(0)).alias("away_wins"),
        F.coalesce(F.col("draws"), F.lit(0)).alias("draws"),
        F.coalesce(F.col("total"), F.lit(0)).alias("total"),
    )
