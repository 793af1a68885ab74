"""Reports over matches and predictions (L04, L05, L09-L16, A05, A06, J09,
J10). Per-key limits use ``row_number() <= n``, which Spark plans as a
WindowGroupLimit on both sides of the shuffle, so a hot team ships at
most n rows per map task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from matchlab.functions.columns import day_month, flip_result, pair_a, pair_b, pct_text, result_text
from matchlab.operators.perspective import group_members, predicted_wins
from matchlab.operators.skew import positions


def last_n(matches: DataFrame, n: int = 10) -> DataFrame:
    """The last n matches of every team, newest first, with the
    result from that team's side. Columns: team, rn, match_id, date,
    home_team, away_team, home_score, away_score, result, tournament,
    team_result."""
    side = lambda t: F.struct(F.col(t).alias("team"), F.lit(t == "home_team").alias("_is_home"))
    tv = matches.select("match_id", "date", "home_team", "away_team", "home_score", "away_score",
                        "result", "tournament", F.inline(F.array(side("home_team"), side("away_team"))))
    w = Window.partitionBy("team").orderBy(F.desc("date"), F.desc("match_id"))
    return (tv.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)
            .select("team", "rn", "match_id", "date", "home_team", "away_team", "home_score",
                    "away_score", "result", "tournament",
                    F.when(F.col("_is_home"), F.col("result")).otherwise(flip_result("result"))
                    .alias("team_result")))


def ordered_string(df: DataFrame, keys, order_col: str, text_col: str, sep: str, out: str) -> DataFrame:
    """Per group, ``text_col`` joined by ``sep`` in ``order_col`` order."""
    s = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(text_col).alias("t"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(s, lambda x: x["t"]), sep).alias(out))


def ordered_string_parts(df: DataFrame, keys: list[str], order: list[str], text_col: str, sep: str, out: str, rows_per_part: int = 10_000) -> DataFrame:
    """A06 for groups of any size: per group and part (from 0), ``text_col`` of
    ``rows_per_part`` rows joined by ``sep``; a group's parts joined by ``sep`` in
    their order are its whole string. Rows get their place from sorted ranges
    (``order`` tells a group's rows apart), so no task or row holds a group."""
    placed = positions(df.select(*keys, *order, F.col(text_col).alias("_t")), keys, order, "_place")
    placed = placed.withColumn("part", F.floor((F.col("_place") - 1) / rows_per_part))
    return ordered_string(placed, [*keys, "part"], "_place", "_t", sep, out)


def form_summary(last: DataFrame) -> DataFrame:
    """Per team over its last-n rows: wins, draws, losses, n,
    win_rate, form (results newest first, e.g. 'WDLWW'). The group is
    bounded by n, so collecting it per team is safe."""
    r = F.col("team_result")
    g = last.groupBy("team").agg(
        F.count_if(r == "W").alias("wins"), F.count_if(r == "D").alias("draws"),
        F.count_if(r == "L").alias("losses"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "team_result"))),
                                 lambda x: x["team_result"]), "").alias("form"))
    return g.select("team", "wins", "draws", "losses", "n",
                    F.round(F.col("wins") / F.col("n"), 4).alias("win_rate"), "form")


def top_k(predictions: DataFrame, k: int = 10, by: str = "confidence") -> DataFrame:
    """K rows with the highest ``by`` (ties by fixture_id)."""
    return predictions.orderBy(F.desc(by), F.asc("fixture_id")).limit(k)


def filter_predictions(predictions: DataFrame, group: str | None = None,
                       pair: tuple[str, str] | None = None) -> DataFrame:
    """One group, or one pair in either orientation; ordered by
    match_date, group_name, fixture_id."""
    p = predictions
    if group is not None:
        p = p.filter(F.col("group_name") == group)
    if pair is not None:
        p = p.filter((pair_a("home_team", "away_team") == min(pair)) & (pair_b("home_team", "away_team") == max(pair)))
    return p.orderBy("match_date", "group_name", "fixture_id")


def display_table(predictions: DataFrame) -> DataFrame:
    """Date as 'dd MMM', fixture text, result text, percents."""
    return predictions.select(
        "fixture_id", day_month("match_date").alias("date"), "group_name",
        F.concat_ws(" vs ", "home_team", "away_team").alias("fixture"),
        result_text("predicted_result", "home_team", "away_team").alias("prediction"),
        pct_text("win_prob").alias("win"), pct_text("draw_prob").alias("draw"),
        pct_text("loss_prob").alias("loss"), pct_text("confidence").alias("confidence"))


def standings(predictions: DataFrame) -> DataFrame:
    """L13 (U03+U04+J10): predicted wins per group member, 0 when none,
    ordered by group, wins descending, team."""
    members = group_members(predictions)
    wins = predicted_wins(predictions)
    return (members.join(wins, on="team", how="left")
            .select("group_name", "team",
                    F.coalesce(F.col("predicted_wins"), F.lit(0).cast("bigint")).alias("predicted_wins"))
            .orderBy("group_name", F.desc("predicted_wins"), "team"))


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """N, mean confidence, last run, and the W/D/L counts — one pass."""
    r = F.col("predicted_result")
    return predictions.agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.round(F.avg("confidence"), 4).alias("mean_confidence"),
        F.max("predicted_at").alias("last_run"),
        F.count_if(r == "W").alias("n_home_wins"), F.count_if(r == "D").alias("n_draws"),
        F.count_if(r == "L").alias("n_away_wins"))


def group_lines(predictions: DataFrame, rows_per_part: int | None = None) -> DataFrame:
    """One text line per group, e.g. 'Mex-Sou: W | Kor-Cze: D', ordered
    by match date then fixture id; with ``rows_per_part`` in numbered parts
    of so many fixtures, for groups too large for one row."""
    t = F.concat(F.substring("home_team", 1, 3), F.lit("-"), F.substring("away_team", 1, 3),
                 F.lit(": "), F.col("predicted_result"))
    p = predictions.select("group_name", F.struct("match_date", "fixture_id").alias("_o"), t.alias("_t"))
    if rows_per_part:
        q = p.select("group_name", "_o.*", "_t")
        return ordered_string_parts(q, ["group_name"], ["match_date", "fixture_id"], "_t", " | ", "results", rows_per_part)
    return ordered_string(p, ["group_name"], "_o", "_t", " | ", "results")


def table_inventory(spark: SparkSession, tables: dict | None = None) -> DataFrame:
    """table_name, n_rows for the given tables (default: every table
    and view of the current catalog), plus a TOTAL row."""
    if tables is None:
        tables = {t.name: spark.table(t.name) for t in spark.catalog.listTables()}
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n, df in tables.items()]
    if not parts:
        return spark.createDataFrame([("TOTAL", 0)], "table_name string, n_rows bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    total = out.agg(F.sum("n_rows").alias("n_rows")).select(F.lit("TOTAL").alias("table_name"), "n_rows")
    return out.unionByName(total)


def with_features(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Predictions joined with their fixture features (fixture_id)."""
    f = features.drop(*[c for c in ("group_name", "home_team", "away_team", "match_date")
                        if c in features.columns])
    return predictions.join(f, on="fixture_id", how="inner")
