"""Leakage-free trailing team features.

Every frame ends before the current row. Row frames order a team's
matches by (day, match_id); calendar frames order by day and exclude
the current day entirely.

Two strategies give identical results, nulls included:

``ranged`` (default, at every size)
    Rows are range-partitioned on (team, day, match_id) and written once
    with their range's number (``skew.ranged``), so a team's history is
    spread over as many ranges as its size needs, whatever its ids and
    dates look like. A team's last 20 rows before a range are copied into it
    as border rows; then plain window aggregates over (team, range) give the
    row frames, and the border rows are dropped. Calendar frames come from
    a table with one row per (team, day), joined to the result.
    Second-level tables have at most teams + ranges, and team-days, rows.

``window``
    One ``Window.partitionBy(team)``: one shuffle by team, and each team's
    whole history in one task. For callers who know that no team is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.functions.frames import last_n
from matchlab.operators.skew import ranged
from matchlab.schemas import EXTRA_FORM_COLS, FORM_COLS

# Fixed values: (output column, input column, first offset, last offset).
ROW_FRAMES = [
    ("win_rate_last10", "win", -10, -1),
    ("draw_rate_last10", "draw", -10, -1),
    ("loss_rate_last10", "loss", -10, -1),
    ("avg_goals_scored_last20", "goals_for", -20, -1),
    ("avg_goals_conceded_last20", "goals_against", -20, -1),
    ("avg_gd_last5", "gd", -5, -1),
    ("avg_gd_prev5", "gd", -10, -6),
    ("avg_goal_diff_last10", "gd", -10, -1),
    ("win_rate_prev10", "win", -20, -11),
]
COUNT_FRAMES = [("matches_available", "win", -20, -1)]


def range_frames(cfg: FeatureConfig):
    """Calendar frames in days: (output, input, first day offset, last)."""
    return [
        ("form_last6m", "win", -cfg.recent_days, -1),
        ("form_prev6m", "win", -cfg.prior_days, -(cfg.recent_days + 1)),
    ]


def _depth():
    return max(-lo for _, _, lo, _ in ROW_FRAMES + COUNT_FRAMES)


def _plain(tv: DataFrame, cfg: FeatureConfig, key: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy("day", "match_id")
    wd = Window.partitionBy(key).orderBy("day")
    cols = [F.avg(c).over(w.rowsBetween(lo, hi)).alias(n) for n, c, lo, hi in ROW_FRAMES]
    cols += [F.count(c).over(w.rowsBetween(lo, hi)).alias(n) for n, c, lo, hi in COUNT_FRAMES]
    cols += [F.avg(c).over(wd.rangeBetween(lo, hi)).alias(n) for n, c, lo, hi in range_frames(cfg)]
    return tv.select("*", *cols)


def day_sums(tv: DataFrame, cfg: FeatureConfig, key: str) -> DataFrame:
    """Sums and counts of a team's days, the input of calendar frames."""
    inputs = sorted({c for _, c, _, _ in range_frames(cfg)})
    return tv.groupBy(key, "day").agg(*[F.sum(c).alias(f"_s_{c}") for c in inputs], *[F.count(c).alias(f"_c_{c}") for c in inputs])


def _calendar(days: DataFrame, cfg: FeatureConfig, key: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy("day")
    return days.select(key, "day", *[
        (F.sum(f"_s_{c}").over(w.rangeBetween(lo, hi)) / F.sum(f"_c_{c}").over(w.rangeBetween(lo, hi))).alias(n)
        for n, c, lo, hi in range_frames(cfg)])


def _borders(r: DataFrame, key: str, inputs: list[str], depth: int) -> DataFrame:
    """For each (team, range) the team's last ``depth`` rows before that range.
    A range's end is crossed by one team at most, so only rows of teams that
    go on into another range are looked at, and at most ``depth`` rows a
    range come out."""
    part = [key, "_range"]
    spans = r.select(*part).distinct()
    by_range = Window.partitionBy(key).orderBy("_range")
    on = spans.withColumn("_next", F.lead("_range").over(by_range)).where("_next IS NOT NULL").select(*part)
    back = Window.partitionBy(*part).orderBy(F.desc("day"), F.desc("match_id"))
    # row_number <= depth is planned as a WindowGroupLimit that filters before its shuffle
    last = r.select(*part, "day", "match_id", *inputs).join(on, part, "left_semi").withColumn("_rk", F.row_number().over(back)).where(F.col("_rk") <= depth)
    tails = last.groupBy(*part).agg(F.array_sort(F.collect_list(F.struct("day", "match_id", *inputs))).alias("_t"))
    before = spans.join(tails, part, "left").select(*part, last_n(F.flatten(F.collect_list("_t").over(by_range.rowsBetween(-depth, -1))), depth).alias("_b"))
    return before.select(*part, F.inline("_b"))


def _row_frames(tv: DataFrame, cfg: FeatureConfig, key: str, shift: int = 0) -> tuple[DataFrame, DataFrame]:
    """``tv`` in written ranges, and its rows with the row frames, which begin
    and end ``shift`` rows later."""
    depth = _depth()
    inputs = sorted({c for _, c, _, _ in ROW_FRAMES + COUNT_FRAMES})
    r = ranged(tv, [key, "day", "match_id"], cfg.range_partitions)
    borders = _borders(r, key, inputs, depth).withColumn("_border", F.lit(True))
    both = r.withColumn("_border", F.lit(False)).unionByName(borders, allowMissingColumns=True)
    w = Window.partitionBy(key, "_range").orderBy("day", "match_id")
    rows = both.select("*", *[F.avg(c).over(w.rowsBetween(lo + shift, hi + shift)).alias(n) for n, c, lo, hi in ROW_FRAMES],
                       *[F.count(c).over(w.rowsBetween(lo + shift, hi + shift)).alias(n) for n, c, lo, hi in COUNT_FRAMES]).where("NOT _border")
    return r, rows.select(*tv.columns, *[n for n, _, _, _ in ROW_FRAMES + COUNT_FRAMES])


def _ranged(tv: DataFrame, cfg: FeatureConfig, key: str, days: DataFrame | None = None) -> DataFrame:
    r, rows = _row_frames(tv, cfg, key)
    calendar = _calendar(day_sums(r, cfg, key) if days is None else days, cfg, key)
    return rows.join(calendar, [key, "day"], "left").select(*rows.columns, *[n for n, _, _, _ in range_frames(cfg)])


def after_matches(tv: DataFrame, cfg: FeatureConfig = NOTEBOOK, key: str = "team") -> DataFrame:
    """Row frames that end with the row itself: a team's form once the match is played."""
    return _row_frames(tv, cfg, key, 1)[1]


def rolling_features(tv: DataFrame, cfg: FeatureConfig = NOTEBOOK, key: str = "team", days: DataFrame | None = None) -> DataFrame:
    """W01-W15 on a team view (see ``perspective.team_view``): adds the 13
    form columns, ``win_rate_prev10`` and ``matches_available``; nulls of
    the form columns are filled with ``cfg.fill``. ``days`` (ranged strategy):
    the ``day_sums`` to take calendar frames from, where ``tv`` doesn't hold all
    days' rows."""
    if cfg.strategy == "window":
        f = _plain(tv, cfg, key)
    elif cfg.strategy == "ranged":
        f = _ranged(tv, cfg, key, days)
    else:
        raise ValueError(f"unknown strategy {cfg.strategy!r}")
    last, prev = F.col("form_last6m"), F.col("form_prev6m")
    if cfg.prior_missing == "zero_change":
        change = F.when(prev.isNotNull(), last - prev).otherwise(F.lit(0.0))
    elif cfg.prior_missing == "zero_prior":
        change = last - F.coalesce(prev, F.lit(0.0))
    else:
        raise ValueError(f"unknown prior_missing {cfg.prior_missing!r}")
    f = f.select(
        "*",
        (F.col("avg_gd_last5") - F.col("avg_gd_prev5")).alias("goal_diff_trend"),
        last.alias("ranking_proxy"),
        change.alias("ranking_change"),
    )
    return f.fillna(cfg.fill, subset=FORM_COLS + EXTRA_FORM_COLS)
