"""Profiling and data-quality checks (Q01-Q13). Each check is one or two
aggregates over the table (never one job per column) and returns a
DataFrame; only ``gate`` collects, and what it collects is the failed
rows of a test table (one row per declared test)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from matchlab.operators.selection import exact_ranks
from matchlab.operators.skew import ranged
from matchlab.session import materialize


def _unpivot_counts(df: DataFrame, exprs: dict, name: str, value: str) -> DataFrame:
    row = df.agg(*[e.alias(k) for k, e in exprs.items()])
    return row.unpivot([], list(exprs), name, value)


def null_counts(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """Q01: column_name, null_count — one pass for all columns."""
    exprs = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    out = _unpivot_counts(df, exprs, "column_name", "null_count")
    return out.filter(F.col("null_count") > 0) if only_with_nulls else out


def date_range(df: DataFrame, col: str = "date") -> DataFrame:
    """Q02: earliest, latest, row count."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"),
                  F.count(F.lit(1)).alias("n_rows"))


def top_values(df: DataFrame, col: str, k: int = 15) -> DataFrame:
    """Q03: the k most frequent values (ties by value)."""
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("value")).limit(k))


def distinct_teams(df: DataFrame) -> DataFrame:
    """Q04: distinct team names over home and away (one pass)."""
    return df.select(F.explode(F.array("home_team", "away_team")).alias("team")).distinct()


def class_distribution(df: DataFrame, col: str = "result") -> DataFrame:
    """Q05: count and percent (2 digits) per class. The total is a scalar
    subquery, so a column of many values stays distributed."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = g.select(F.sum("n")).scalar()
    return g.select(col, "n", F.round(F.col("n") * 100.0 / total, 2).alias("pct"))


def exact_quantiles(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """column_name and one column ``p{100*prob}`` per probability: exact
    quantiles with linear interpolation between the two nearest ranks (the
    pandas / ``quantile_cont`` rule), by exact selection: a few scans of the
    columns, no shuffle of rows. Columns without values are left out."""
    def at(n, p):
        return (n - 1) * float(p)

    found = exact_ranks(df, cols, lambda n: sorted({int(f(at(n, p))) + 1 for p in probs for f in (math.floor, math.ceil)}))
    rows = []
    for c, (n, v) in found.items():
        if n:
            ends = [(v[math.floor(at(n, p)) + 1], v[math.ceil(at(n, p)) + 1], at(n, p) - math.floor(at(n, p))) for p in probs]
            rows.append((c, *[lo + (hi - lo) * part for lo, hi, part in ends]))
    return df.sparkSession.createDataFrame(rows, "column_name string, " + ", ".join(f"p{int(round(p * 100))} double" for p in probs))


def column_summary(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Q06: column_name, n, mean, stddev (sample), min, quartiles (p25, p50,
    p75), max — one aggregate for the moments, the distributed exact
    quantiles for the quartiles; mean, stddev and quartiles rounded to
    ``digits``."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(x).alias("n"),
                             F.round(F.avg(x), digits).alias("mean"),
                             F.round(F.stddev_samp(x), digits).alias("stddev"),
                             F.min(x).alias("min"), F.max(x).alias("max")).alias(c))
    moments = df.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in cols])))
    q = exact_quantiles(df, cols).select(
        "column_name", *[F.round(c, digits).alias(c) for c in ("p25", "p50", "p75")])
    return moments.join(q, on="column_name", how="left")


def cleaning_report(parsed: DataFrame, keep: F.Column) -> DataFrame:
    """Q07: original, clean, dropped, percent dropped — one pass."""
    g = parsed.agg(F.count(F.lit(1)).alias("original_rows"), F.count_if(keep).alias("clean_rows"))
    return g.select("original_rows", "clean_rows",
                    (F.col("original_rows") - F.col("clean_rows")).alias("dropped_rows"),
                    F.round(F.try_divide((F.col("original_rows") - F.col("clean_rows")) * 100.0,
                                         F.col("original_rows")), 2).alias("pct_dropped"))


def forbidden_names(df: DataFrame, former_names: DataFrame) -> DataFrame:
    """Q08: teams that still carry a former name (should be none):
    former_names_left, status."""
    teams = distinct_teams(df)
    left = teams.join(former_names.select(F.trim("former").alias("team")), on="team", how="left_semi")
    return left.agg(F.count(F.lit(1)).alias("former_names_left")).select(
        "former_names_left",
        F.when(F.col("former_names_left") == 0, "PASS").otherwise("FAIL").alias("status"))


def row_contract(tables: dict, minimums: dict) -> DataFrame:
    """Q09: table_name, min_rows, actual_rows, status (PASS / LOW / MISSING).
    ``tables`` maps a name to a DataFrame (absent -> MISSING)."""
    if not tables:
        raise ValueError("row_contract needs at least one table")
    spark = next(iter(tables.values())).sparkSession
    counts = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("actual_rows")).select(F.lit(name).alias("table_name"), "actual_rows")
        counts = c if counts is None else counts.unionByName(c)
    contract = spark.createDataFrame([(k, int(v)) for k, v in minimums.items()],
                                     "table_name string, min_rows bigint")
    j = contract.join(counts, on="table_name", how="left")
    return j.select("table_name", "min_rows", "actual_rows",
                    F.when(F.col("actual_rows").isNull(), "MISSING")
                    .when(F.col("actual_rows") >= F.col("min_rows"), "PASS").otherwise("LOW").alias("status"))


def column_tests(df: DataFrame, table: str, not_null=(), unique=(), accepted=None) -> DataFrame:
    """Q10: test_name, table_name, column_name, failures, status.
    not_null and accepted_values share one aggregate; each unique test is
    a groupBy on its column (partial aggregation before the shuffle). With
    unique tests the input is written once, as it is read several times."""
    accepted = accepted or {}
    if unique:
        df = materialize(df.select(*dict.fromkeys([*not_null, *unique, *accepted])), "column_tests")
    exprs = {}
    for c in not_null:
        exprs[f"not_null|{c}"] = F.count_if(F.col(c).isNull())
    for c, vals in accepted.items():
        exprs[f"accepted_values|{c}"] = F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(vals)))
    parts = []
    if exprs:
        parts.append(_unpivot_counts(df, exprs, "_t", "failures"))
    for c in unique:
        dup = (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
               .filter(F.col("_n") > 1).agg(F.count(F.lit(1)).alias("failures")))
        parts.append(dup.select(F.lit(f"unique|{c}").alias("_t"), "failures"))
    if not parts:
        raise ValueError("column_tests needs at least one test")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    t = F.split(F.col("_t"), r"\|")
    return out.select(t[0].alias("test_name"), F.lit(table).alias("table_name"),
                      t[1].alias("column_name"), F.col("failures").cast("bigint").alias("failures"),
                      F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"))


class QualityGateError(RuntimeError):
    pass


def gate(tests: DataFrame) -> DataFrame:
    """Q11: raise when any test failed, else return the test table.
    Collects only the failed test rows (one row per declared test)."""
    failed = tests.filter(F.col("status") != "PASS").collect()
    if failed:
        lines = ", ".join(f"{r['test_name']}({r['table_name']}.{r['column_name']})={r['failures']}"
                          for r in failed)
        raise QualityGateError(f"{len(failed)} failing checks: {lines}")
    return tests


def test_summary(tests: DataFrame) -> DataFrame:
    """Q12: status, n_tests."""
    return tests.groupBy("status").agg(F.count(F.lit(1)).alias("n_tests"))


RATE_COLS = ["win_rate_last10", "draw_rate_last10", "loss_rate_last10", "form_last6m",
             "form_prev6m", "ranking_proxy", "win_rate_prev10"]
GOAL_COLS = ["avg_goals_scored_last20", "avg_goals_conceded_last20"]


def range_checks(mf: DataFrame, partitions: int | None = None) -> DataFrame:
    """Q13: check_name, failures. Rates in [0,1], goal means in [0,5] for
    both sides, and h2h_total non-decreasing along each pair's matches.
    The monotone check runs on sorted ranges (``skew.ranged``), so a hot pair
    never lands in one task: within (pair, range) by lag, across ranges by
    comparing a range's first value with the one before's last (one row per
    pair and range)."""
    exprs = {}
    for side in ("home", "away"):
        for c in RATE_COLS:
            exprs[f"rate_in_0_1|{side}_{c}"] = F.count_if(~F.col(f"{side}_{c}").between(0.0, 1.0))
        for c in GOAL_COLS:
            exprs[f"goals_in_0_5|{side}_{c}"] = F.count_if(~F.col(f"{side}_{c}").between(0.0, 5.0))
    exprs["rate_in_0_1|h2h_team_a_win_rate"] = F.count_if(~F.col("h2h_team_a_win_rate").between(0.0, 1.0))
    ranges = _unpivot_counts(mf, exprs, "check_name", "failures")

    part = ["team_a", "team_b", "_range"]
    r = ranged(mf.select("team_a", "team_b", "date", "match_id", "h2h_total"), ["team_a", "team_b", "date", "match_id"], partitions)
    falls = lambda before, now: F.col(before) > F.col(now)
    within = (r.select("h2h_total", F.lag("h2h_total").over(Window.partitionBy(*part).orderBy("date", "match_id")).alias("_prev"))
              .filter(falls("_prev", "h2h_total")).agg(F.count(F.lit(1)).alias("n")))
    place = F.struct("date", "match_id")
    ends = r.groupBy(*part).agg(F.min_by("h2h_total", place).alias("_first"), F.max_by("h2h_total", place).alias("_last"))
    across = (ends.select("_first", F.lag("_last").over(Window.partitionBy("team_a", "team_b").orderBy("_range")).alias("_prev"))
              .filter(falls("_prev", "_first")).agg(F.count(F.lit(1)).alias("n")))
    mono = within.unionByName(across).agg(
        F.sum("n").cast("bigint").alias("failures"))
    mono = mono.select(F.lit("h2h_total_non_decreasing").alias("check_name"), "failures")
    return ranges.unionByName(mono)
