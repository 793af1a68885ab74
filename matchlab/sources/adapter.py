"""Derive the application's tables from the driver's TPC-H-like tables.

The driver has no match table, so one is built from ``orders``:
consecutive order keys 2k (home side) and 2k+1 (away side) form match k.
A side's team is the nation of the order's customer, its score is
``floor(o_totalprice) % 5``, the match date is the home order's date and
the tournament is the home order's priority. Matches whose two sides
belong to the same nation are dropped. Everything here is a Spark plan
over the given tables, so its size grows with them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchlab.functions.columns import goal_diff, result_code

# Fixed values of the derived former-name and fixture tables.
FORMER_VALID_FROM = "1996-01-01"
FORMER_VALID_TO = "1998-12-31"
FIXTURE_FIRST_DAY = _dt.date(2002, 6, 11)
FIXTURE_DAY_SPAN = 14


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: match_id, side (0 home, 1 away), team, score,
    date, priority. Join strategies are left to the planner's size check:
    ``nation`` (25 rows) and, at small scale, ``customer`` fall under the
    broadcast threshold; beyond it Spark uses sort-merge joins (and AQE can
    still switch by runtime size)."""
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.expr("o_orderkey div 2").alias("match_id"),
            (F.col("o_orderkey") % 2).cast("int").alias("side"),
            F.col("n_name").alias("team"),
            (F.floor("o_totalprice").cast("bigint") % 5).alias("score"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_orderpriority").alias("priority"),
        )
    )


def _pivot_sides(sides: DataFrame) -> DataFrame:
    """Both sides of a match on one row: one shuffle by match_id, with
    map-side partial aggregation (no self-join, one scan of orders)."""
    def home(c):
        return F.max(F.when(F.col("side") == 0, F.col(c)))

    def away(c):
        return F.max(F.when(F.col("side") == 1, F.col(c)))

    return sides.groupBy("match_id").agg(
        home("date").alias("date"),
        home("team").alias("home_team"),
        away("team").alias("away_team"),
        home("score").alias("home_score"),
        away("score").alias("away_score"),
        home("priority").alias("tournament"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean match table: match_id, date, home_team, away_team,
    home_score, away_score, tournament, neutral, goal_diff, result."""
    m = _pivot_sides(order_sides(spark, sf_dir))
    return (
        m.filter(F.col("home_team").isNotNull() & F.col("away_team").isNotNull()
                 & (F.col("home_team") != F.col("away_team")))
        .select(
            "match_id", "date", "home_team", "away_team", "home_score", "away_score",
            "tournament",
            (F.col("match_id") % 4 == 0).alias("neutral"),
            goal_diff("home_score", "away_score").alias("goal_diff"),
            result_code("home_score", "away_score").alias("result"),
        )
    )


def raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match table in the raw CSV shape (strings for date and neutral,
    int scores) plus ``match_id``, with deterministic dirt derived from the
    key so that every cleaning rule has work: padded names, a null score,
    a negative score, an unparsable date and an unparsable boolean."""
    m = _pivot_sides(order_sides(spark, sf_dir)).filter(
        F.col("home_team").isNotNull() & F.col("away_team").isNotNull()
        & (F.col("home_team") != F.col("away_team")))
    k = F.col("match_id")
    return m.select(
        "match_id",
        F.when(k % 101 == 9, F.lit("n/a"))
        .otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        F.when(k % 10 == 3, F.concat(F.lit(" "), F.col("home_team")))
        .otherwise(F.col("home_team")).alias("home_team"),
        F.when(k % 10 == 7, F.concat(F.col("away_team"), F.lit("  ")))
        .otherwise(F.col("away_team")).alias("away_team"),
        F.when(k % 97 == 5, F.lit(None)).otherwise(F.col("home_score"))
        .cast("int").alias("home_score"),
        F.when(k % 89 == 7, F.lit(-1)).otherwise(F.col("away_score"))
        .cast("int").alias("away_score"),
        F.col("tournament"),
        F.col("home_team").alias("city"),
        F.col("home_team").alias("country"),
        F.when(k % 103 == 11, F.lit("maybe"))
        .when(k % 4 == 0, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("neutral"),
    )


def former_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Former-name map from ``nation``: an odd nation key >= 20 is the
    former name of the nation one key below (2 rows in TPC-H)."""
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cur = n.select(F.col("n_nationkey").alias("_k"), F.col("n_name").alias("current"))
    old = n.filter((F.col("n_nationkey") % 2 == 1) & (F.col("n_nationkey") >= 20))
    return (
        old.join(cur, F.col("n_nationkey") - 1 == F.col("_k"))
        .select("current", F.col("n_name").alias("former"),
                F.lit(FORMER_VALID_FROM).alias("start_date"),
                F.lit(FORMER_VALID_TO).alias("end_date"))
    )


def fixtures_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture seed in its file shape (match_id, home_team, away_team,
    group, match_date as text): every unordered pair of nations of one
    region once, lower key at home, region name as group."""
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    h = n.select(F.col("n_nationkey").alias("hk"), F.col("n_name").alias("home_team"),
                 F.col("n_regionkey").alias("rk"))
    a = n.select(F.col("n_nationkey").alias("ak"), F.col("n_name").alias("away_team"),
                 F.col("n_regionkey").alias("ark"))
    pairs = h.join(a, (F.col("rk") == F.col("ark")) & (F.col("hk") < F.col("ak")))
    return (
        pairs.join(r, F.col("rk") == F.col("r_regionkey"))
        .select(
            (F.col("hk") * 100 + F.col("ak")).cast("int").alias("match_id"),
            "home_team", "away_team",
            F.col("r_name").alias("group"),
            F.date_format(
                F.date_add(F.lit(FIXTURE_FIRST_DAY), ((F.col("hk") + F.col("ak")) % FIXTURE_DAY_SPAN).cast("int")),
                "yyyy-MM-dd").alias("match_date"),
        )
    )


def raw_goalscorers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goal rows in the raw CSV shape, one per ``lineitem`` row of a match's
    order: the side's team scored; scorer from the part key, minute from
    the line number (half minutes included, as in the original data),
    own goal for returned lines, penalty for the first line of a finished
    order. Some team names are padded and some dates unparsable."""
    m = _pivot_sides(order_sides(spark, sf_dir)).filter(
        F.col("home_team").isNotNull() & F.col("away_team").isNotNull()
        & (F.col("home_team") != F.col("away_team")))
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    j = li.join(m, F.expr("l_orderkey div 2") == F.col("match_id"))
    team = F.when(F.col("l_orderkey") % 2 == 0, F.col("home_team")).otherwise(F.col("away_team"))
    k = F.col("l_partkey")
    return j.select(
        F.when(k % 211 == 3, F.lit("bad-date")).otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        "home_team", "away_team",
        F.when(k % 50 == 1, F.concat(F.lit(" "), team)).when(k % 199 == 2, F.lit(None)).otherwise(team).alias("team"),
        F.concat(F.lit("Player "), k.cast("string")).alias("scorer"),
        ((F.col("l_linenumber") * 13) % 90 + 0.5).cast("double").alias("minute"),
        F.when(F.col("l_returnflag") == "R", "TRUE").otherwise("FALSE").alias("own_goal"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 1), "TRUE")
        .otherwise("FALSE").alias("penalty"),
    )


def raw_shootouts(spark: SparkSession, sf_dir: str, match_table: DataFrame | None = None) -> DataFrame:
    """Shootout rows in the raw CSV shape: one per drawn match; the winner
    is the home side for even match ids, else the away side; some winners
    padded or missing, some first shooters empty."""
    m = (matches(spark, sf_dir) if match_table is None else match_table).filter(F.col("result") == "D")
    k = F.col("match_id")
    winner = F.when(k % 2 == 0, F.col("home_team")).otherwise(F.col("away_team"))
    return m.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.when(k % 9 == 4, F.concat(F.col("home_team"), F.lit(" "))).otherwise(F.col("home_team")).alias("home_team"),
        "away_team",
        F.when(k % 37 == 5, F.lit(None)).when(k % 7 == 1, F.concat(F.lit(" "), winner))
        .otherwise(winner).alias("winner"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(winner).alias("first_shooter"),
    )
