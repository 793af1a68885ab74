"""Cleaning (P04, P05, P08, P10-P12) and team-name normalisation.

ANSI mode is on in Spark 4, so every parse is a ``try_`` form: a bad
token becomes null instead of failing the job, and the null rules then
decide whether the row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.functions.columns import goal_diff, parse_bool, parse_date, result_code, to_int
from matchlab.operators.intervals import latest_period
from matchlab.operators.skew import ranged
from matchlab.session import materialize

def name_lookup(former_names: DataFrame, with_dates: bool = False) -> DataFrame:
    """One current name per former name (the latest validity wins when a
    former name repeats). With ``with_dates`` the validity rows are kept
    (J05) with parsed dates."""
    fn = former_names.select(
        F.trim("former").alias("former"), F.trim("current").alias("current"),
        parse_date("start_date").alias("start_date"), parse_date("end_date").alias("end_date"),
    ).filter(F.col("former").isNotNull() & F.col("current").isNotNull())
    if with_dates:
        return fn
    return fn.groupBy("former").agg(
        F.max_by("current", F.struct(F.coalesce("end_date", F.lit("9999-12-31").cast("date")),
                                     F.col("current"))).alias("current"))


def normalise_names(df: DataFrame, former_names: DataFrame, cols=("home_team", "away_team"),
                    respect_dates: bool = False) -> DataFrame:
    """Replace former team names by current ones, keep unmatched names.
    With ``respect_dates`` (J05) a former name is replaced only on dates
    inside its validity range (open ends allowed). Where validity ranges of
    one former name overlap, the one that began last counts (then the name
    that sorts last); no row is multiplied."""
    out = df
    if not respect_dates:
        lk = name_lookup(former_names)
        for c in cols:
            m = lk.select(F.col("former").alias(c), F.col("current").alias(f"_{c}_new"))
            out = (out.join(m, on=c, how="left")
                   .withColumn(c, F.coalesce(F.col(f"_{c}_new"), F.col(c))).drop(f"_{c}_new"))
        return out.select(*df.columns)
    lk = name_lookup(former_names, with_dates=True)
    for c in cols:
        names = lk.select(F.col("former").alias(c), F.col("start_date").alias("_s"), F.col("end_date").alias("_e"), F.col("current").alias("_new"))
        found = latest_period(out.select(c, "date"), names, [c], "date", "_s", "_e", "_new")
        out = out.join(found, [c, "date"], "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return out.select(*df.columns)


def with_match_id(df: DataFrame) -> DataFrame:
    """A bigint key for rows read from a file without one: unique over the
    whole table, whatever its size.

    Rows are sorted into ranges by all their columns (``skew.ranged``) and
    numbered within them: id = range * 2^40 + number. So ids follow the
    rows' content, and the tie order of two same-day matches doesn't depend
    on the file layout. Exact copies are kept apart by the input split they
    were read in and a number within it (bounded by the split), so a group of
    copies holding a third of the input is spread over ranges, too; which
    copy gets which id changes no result."""
    if "match_id" in df.columns:
        return df
    cols = list(df.columns)
    # written once, so every branch below sees the same split ids
    d = materialize(df.select("*", F.spark_partition_id().alias("_pid")), "rows_with_split_ids")
    d = d.withColumn("_k", F.row_number().over(Window.partitionBy("_pid", *cols).orderBy("_pid")))
    order = [*(["date"] if "date" in cols else []), *(c for c in cols if c != "date"), "_pid", "_k"]
    n = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged(d, order).withColumn("match_id", F.col("_range").cast("bigint") * (1 << 40) + n).select(*cols, "match_id")


def keep_predicate() -> F.Column:
    """The row filter of P04+P05 as one column (used by the cleaning report)."""
    return (F.col("date").isNotNull() & F.col("home_team").isNotNull() & F.col("away_team").isNotNull()
            & F.col("home_score").isNotNull() & F.col("away_score").isNotNull()
            & (F.col("home_score") >= 0) & (F.col("away_score") >= 0))


def parse_results(raw: DataFrame) -> DataFrame:
    """P01, P02, P08 on the raw results shape (no rows dropped)."""
    cols = ["match_id"] if "match_id" in raw.columns else []
    return raw.select(
        *cols,
        parse_date("date").alias("date"),
        F.trim("home_team").alias("home_team"),
        F.trim("away_team").alias("away_team"),
        to_int("home_score").alias("home_score"),
        to_int("away_score").alias("away_score"),
        "tournament", "city", "country",
        parse_bool("neutral").alias("neutral"),
    )


def clean_matches(raw: DataFrame, former_names: DataFrame | None = None,
                  cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """Parse, trim (before the name map, unlike the original), drop rows
    with a null key or score (P04), keep non-negative scores (P05), add
    result (P06) and goal_diff (P07), map former names (J01)."""
    df = parse_results(raw).filter(keep_predicate())
    if former_names is not None and cfg.normalise_names:
        df = normalise_names(df, former_names)
    df = with_match_id(df)
    return df.select(
        "match_id", "date", "home_team", "away_team", "home_score", "away_score",
        "tournament", "city", "country", "neutral",
        result_code("home_score", "away_score").alias("result"),
        goal_diff("home_score", "away_score").alias("goal_diff"),
    )


def clean_goalscorers(raw: DataFrame) -> DataFrame:
    """P10: typed goal rows; rows without date or team dropped."""
    return raw.select(
        parse_date("date").alias("date"),
        F.trim("home_team").alias("home_team"),
        F.trim("away_team").alias("away_team"),
        F.trim("team").alias("team"),
        "scorer",
        to_int("minute").alias("minute"),
        parse_bool("own_goal").alias("own_goal"),
        parse_bool("penalty").alias("penalty"),
    ).dropna(subset=["date", "team"])


def clean_shootouts(raw: DataFrame) -> DataFrame:
    """Typed, trimmed shootouts; rows without date or winner dropped."""
    return raw.select(
        parse_date("date").alias("date"),
        F.trim("home_team").alias("home_team"),
        F.trim("away_team").alias("away_team"),
        F.trim("winner").alias("winner"),
        "first_shooter",
    ).dropna(subset=["date", "winner"])
