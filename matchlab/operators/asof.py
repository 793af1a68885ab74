"""As-of join, and fixture features as of the fixture's date.

The snapshots of the latest feature row (``snapshot``) lag one match: a feature
row tells what was known before its match. Here a fixture sees every match
before its date, the latest one included, and nothing later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.functions.columns import day_number, pair_a, pair_b
from matchlab.operators import h2h, rolling
from matchlab.operators.perspective import team_view
from matchlab.operators.skew import ranged
from matchlab.operators.snapshot import assemble
from matchlab.schemas import SNAPSHOT_STEMS
from matchlab.session import materialize


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, inclusive: bool = False, partitions: int | None = None) -> DataFrame:
    """Every row of ``left`` with the columns of the last row of ``right`` with
    the same keys and an earlier ``time`` (with ``inclusive``: not a later one);
    nulls where there is none. ``right`` has one row a key and time.

    Both sides are sorted into common ranges by (keys, time), hot keys and hot
    times over as many as they need. The last right row so far comes from a
    window inside (key, range); for the start of a range it is carried over
    from a table with one row per key and range."""
    values = [c for c in right.columns if c not in (*keys, time)]
    kind = f"struct<{', '.join(f'`{c}`: {t}' for c, t in right.dtypes if c in values)}>"
    own = f"struct<{', '.join(f'`{c}`: {t}' for c, t in left.dtypes)}>"
    first, second = (0, 1) if inclusive else (1, 0)        # places of right and left at equal times
    at = [*keys, F.col(time).alias("_t")]
    both = left.select(*at, F.lit(second).alias("_side"), F.xxhash64(*left.columns).alias("_tie"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(kind).alias("_v")).unionByName(
        right.dropna(subset=keys).select(*at, F.lit(first).alias("_side"), F.lit(0).cast("bigint").alias("_tie"), F.lit(None).cast(own).alias("_l"), F.struct(*values).alias("_v")))
    r = ranged(both, [*keys, "_t", "_side", "_tie"], partitions, "as_of")
    part = [*keys, "_range"]
    so_far = Window.partitionBy(*part).orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    ends = r.where("_v IS NOT NULL").groupBy(*part).agg(F.max_by("_v", F.struct("_t", "_side")).alias("_e"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = r.select(*part).distinct().join(ends, part, "left").select(*part, F.last("_e", ignorenulls=True).over(earlier).alias("_b"))
    found = r.withColumn("_i", F.last("_v", ignorenulls=True).over(so_far)).where("_l IS NOT NULL").join(before, part, "left")
    return found.select("_l.*", F.coalesce("_i", "_b").alias("_v")).select(*left.columns, *[F.col("_v")[c].alias(c) for c in values])


def team_days(matches: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """One row per team and day with a match: the row-frame form after the day's
    last match, and running sums of wins and matches (``_w``, ``_n``) up to the day."""
    tv = team_view(matches)
    names = [n for n, _, _, _ in rolling.ROW_FRAMES]
    last = rolling.after_matches(tv, cfg).groupBy("team", "day").agg(
        F.max_by(F.struct(*names), "match_id").alias("_f"), F.sum("win").alias("_dw"), F.count("win").alias("_dn"))
    upto = Window.partitionBy("team").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)      # one row a day
    return last.select("team", "day", "_f.*", F.sum("_dw").over(upto).alias("_w"), F.sum("_dn").over(upto).alias("_n"))


def pair_days(matches: DataFrame) -> DataFrame:
    """One row per pair and day with a meeting: the record up to that day."""
    flags = [c for c, _ in h2h._COUNTS]
    per = h2h.pair_outcomes(matches).groupBy(*h2h.PAIR, day_number("date").alias("day")).agg(*[F.sum(c).alias(c) for c in flags], F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*h2h.PAIR).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return per.select(*h2h.PAIR, "day", F.sum("a_won").over(upto).alias("_wins"), F.sum("n").over(upto).alias("_n"))


def fixture_features_as_of(fixtures: DataFrame, matches: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """J07 + J08: like ``snapshot.fixture_features``, from all matches before each
    fixture's ``match_date`` (unique ``fixture_id``; a null date sees none). Row
    frames count back from the last of them, calendar frames from the date."""
    f = materialize(fixtures.select("fixture_id", "group_name", "home_team", "away_team", "match_date"), "fixtures")
    day = day_number("match_date")
    spans = (("now", 0), ("recent", cfg.recent_days), ("prior", cfg.prior_days))
    probes = f.select("fixture_id", F.inline(F.array(*[
        F.struct(F.col(f"{side}_team").alias("team"), (day - back).alias("day"), F.lit(f"{side}_{name}").alias("what"))
        for side in ("home", "away") for name, back in spans])))
    known = as_of(probes, team_days(matches, cfg), ["team"], "day", partitions=cfg.range_partitions)
    names = [n for n, _, _, _ in rolling.ROW_FRAMES]
    pick = lambda what, c: F.max(F.when(F.col("what") == what, F.col(c)))
    form = known.groupBy("fixture_id").agg(
        *[pick(f"{side}_now", c).alias(f"{side}.{c}") for side in ("home", "away") for c in names],
        *[pick(f"{side}_{name}", c).alias(f"{side}.{name}{c}") for side in ("home", "away") for name, _ in spans for c in ("_w", "_n")])

    def stems(side):
        col = lambda c: F.col(f"`{side}.{c}`")
        sums = {n: (F.coalesce(col(f"{n}_w"), F.lit(0)), F.coalesce(col(f"{n}_n"), F.lit(0))) for n, _ in spans}

        def share(a, b):        # wins in the days from b's on, before a's
            n = sums[a][1] - sums[b][1]
            return F.when(n > 0, (sums[a][0] - sums[b][0]) / n)
        last, prev = share("now", "recent"), share("recent", "prior")
        change = F.when(prev.isNotNull(), last - prev).otherwise(0.0) if cfg.prior_missing == "zero_change" else last - F.coalesce(prev, F.lit(0.0))
        made = {"goal_diff_trend": col("avg_gd_last5") - col("avg_gd_prev5"), "ranking_proxy": last, "ranking_change": change}
        seen = col("now_n").isNotNull()
        return [F.when(seen, F.coalesce(made[s] if s in made else col(s), F.lit(cfg.fill))).alias(f"_{side}_{s}") for s in SNAPSHOT_STEMS]

    pairs = as_of(f.select("fixture_id", pair_a("home_team", "away_team").alias("team_a"), pair_b("home_team", "away_team").alias("team_b"), day.alias("day")),
                  pair_days(matches), h2h.PAIR, "day", partitions=cfg.range_partitions)
    pairs = pairs.select("fixture_id", F.col("team_a").alias("_ta"), (F.col("_wins") / F.col("_n")).alias("_r"), F.col("_n").cast("bigint").alias("_n"))
    return assemble(f.join(form.select("fixture_id", *stems("home"), *stems("away")), "fixture_id", "left").join(pairs, "fixture_id", "left"), cfg)
