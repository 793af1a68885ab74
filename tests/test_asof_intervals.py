"""As-of join, lookup in periods, exact stratified split, content check."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from match_cases import make_matches, rows
from matchlab.config import NOTEBOOK
from matchlab.operators import asof, clean, ml
from matchlab.operators.intervals import latest_period
from matchlab.session import scratch_path
from matchlab.sources import files


@pytest.mark.parametrize("inclusive", [False, True])
def test_as_of_equals_brute_force(spark, inclusive):
    """Random times, a hot key, repeated rows, keys on one side only, nulls; many ranges."""
    rnd = random.Random(1)
    right = {(rnd.choice("hhhhabc"), rnd.randint(0, 400)): i for i in range(300)}
    right |= {(None, 5): 999}
    left = [(i, rnd.choice(["h", "h", "h", "a", "b", "c", "x", None]), rnd.choice([None, *range(-5, 420)])) for i in range(900)] + [(7, "h", 33)] * 3
    r = spark.createDataFrame([(k, t, v, f"v{v}") for (k, t), v in right.items()], "key string, t int, value int, name string")
    lf = spark.createDataFrame(left, "i int, key string, t int")
    got = asof.as_of(lf, r, ["key"], "t", inclusive=inclusive, partitions=9)
    assert got.columns == ["i", "key", "t", "value", "name"]
    want = []
    for i, k, t in left:
        ok = [s for kk, s in right if kk == k and k is not None and t is not None and (s <= t if inclusive else s < t)]
        v = right[k, max(ok)] if ok else None
        want.append((i, k, t, v, None if v is None else f"v{v}"))
    assert sorted(map(str, rows(got))) == sorted(map(str, want))
    assert rows(asof.as_of(lf, r.limit(0), ["key"], "t"), "value") == [(None,)] * len(left)


def test_fixtures_see_the_last_match(spark):
    """The latest result counts, results on the day or later don't."""
    data = [(1, "2000-01-01", "A", "B", 1, 0), (2, "2000-02-01", "B", "A", 2, 0), (3, "2000-03-01", "A", "B", 0, 0)]
    fx = spark.createDataFrame([(10, "g", "A", "B", dt.date(2000, 2, 1)), (11, "g", "A", "B", dt.date(2000, 2, 2)), (12, "g", "B", "A", dt.date(2000, 12, 1)),
                                (13, "g", "A", "C", dt.date(2000, 12, 1)), (14, "g", "A", "B", None)],
                               "fixture_id bigint, group_name string, home_team string, away_team string, match_date date")
    got = {r["fixture_id"]: r for r in asof.fixture_features_as_of(fx, make_matches(spark, data), NOTEBOOK.with_(range_partitions=4)).collect()}
    assert got[10]["home_win_rate_last10"] == 1.0 and got[10]["h2h_total"] == 1 and got[10]["h2h_team_a_win_rate"] == 1.0
    assert got[11]["home_win_rate_last10"] == 0.5 and got[11]["h2h_total"] == 2
    assert got[12]["away_win_rate_last10"] == 1 / 3 and got[12]["home_draw_rate_last10"] == 1 / 3
    # by December the first half-year is outside the recent frame, and B's wins lie in the prior one
    assert got[12]["home_ranking_proxy"] == 0.0 and got[12]["home_ranking_change"] == 0.0
    assert got[13]["away_win_rate_last10"] == NOTEBOOK.unknown_rate and got[13]["h2h_total"] == 0
    assert got[14]["home_win_rate_last10"] == NOTEBOOK.unknown_rate and got[14]["h2h_team_a_win_rate"] == NOTEBOOK.h2h_default


def test_hot_team_is_spread(spark):
    """One team in most matches: its rows lie in many ranges, with the same result."""
    rnd = random.Random(4)
    data = [(i, str(dt.date(1990, 1, 1) + dt.timedelta(i // 3)), "H", rnd.choice("ABC"), rnd.randint(0, 3), rnd.randint(0, 3)) for i in range(600)]
    fx = spark.createDataFrame([(i, "g", "H", "A", dt.date(1990, 1, 1) + dt.timedelta(i * 5)) for i in range(45)],
                               "fixture_id bigint, group_name string, home_team string, away_team string, match_date date")
    m = make_matches(spark, data)
    a, b = (sorted(map(str, rows(asof.fixture_features_as_of(fx, m, NOTEBOOK.with_(range_partitions=n))))) for n in (1, 12))
    assert a == b and len(a) == 45
    h = [x for x in data if x[1] < "1990-05-01"][-10:]
    got = asof.fixture_features_as_of(fx, m, NOTEBOOK).where("match_date = '1990-05-01'").first()
    assert got["home_win_rate_last10"] == sum(x[4] > x[5] for x in h) / 10


def test_latest_period_equals_brute_force(spark):
    rnd = random.Random(2)
    day = lambda n: dt.date(1900, 1, 1) + dt.timedelta(n)
    periods = [(rnd.choice("abc"), rnd.choice([None, day(rnd.randint(0, 300))]), rnd.choice([None, day(rnd.randint(0, 400))]), rnd.choice("xyz")) for _ in range(60)]
    periods += [("a", dt.date(1, 1, 1), dt.date(9999, 12, 31), "all"), (None, None, None, "n"), ("d", day(5), day(5), "one")]
    points = [(rnd.choice(["a", "b", "c", "d", "e", None]), rnd.choice([None, dt.date(1, 1, 1), dt.date(9999, 12, 31), *map(day, range(-3, 420))])) for _ in range(800)]
    p = spark.createDataFrame(periods, "key string, s date, e date, v string")
    got = latest_period(spark.createDataFrame(points, "key string, date date"), p, ["key"], "date", "s", "e", "v")
    want = set()
    for k, d in points:
        if k is not None and d is not None:
            ok = [(s or dt.date(1, 1, 1), v) for kk, s, e, v in periods if kk == k and (s is None or s <= d) and (e is None or d <= e)]
            if ok:
                want.add((k, d, max(ok)[1]))
    assert sorted(rows(got, "key", "date", "v")) == sorted(want)


def test_a_name_with_very_many_periods(spark):
    """A period for every day of 2,000 years, twice: each date finds its own."""
    n = 730_000
    p = spark.range(2 * n).select(F.lit("Old").alias("former"), F.concat(F.lit("New"), F.col("id") % n).alias("current"),
                                  F.date_format(F.date_add(F.expr("DATE '0001-01-01'"), (F.col("id") % n).cast("int")), "yyyy-MM-dd").alias("start_date"),
                                  F.date_format(F.date_add(F.expr("DATE '0001-01-01'"), (F.col("id") % n + 400).cast("int")), "yyyy-MM-dd").alias("end_date"))
    days = [0, 5, 1000, 365_000, n - 1, n + 300, n + 401]
    m = spark.createDataFrame([(i, dt.date(1, 1, 1) + dt.timedelta(d), "Old", "Other") for i, d in enumerate(days)], "match_id int, date date, home_team string, away_team string")
    got = {r["match_id"]: r["home_team"] for r in clean.normalise_names(m, p, respect_dates=True).collect()}
    assert got == {i: f"New{min(d, n - 1)}" if d < n + 400 else "Old" for i, d in enumerate(days)}


def test_stratified_split_is_exact(spark):
    df = spark.range(1013).select(F.col("id").alias("match_id"), F.when(F.col("id") % 3 == 0, 0.0).when(F.col("id") % 50 == 1, 1.0).otherwise(2.0).alias("label"))
    sizes = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    parts = [ml.stratified_split(d, NOTEBOOK) for d in (df, df.repartition(7, "label"), df.coalesce(1))]
    for train, test in parts:
        assert {r["label"]: r["count"] for r in test.groupBy("label").count().collect()} == {k: int(n * .2 + .5) for k, n in sizes.items()}
        assert train.count() + test.count() == 1013 and train.columns == ["match_id", "label"]
    ids = [sorted(rows(test, "match_id")) for _, test in parts]
    assert ids[0] == ids[1] == ids[2]
    assert [x.count() for x in ml.stratified_split(df.limit(0), NOTEBOOK)] == [0, 0]


def test_content_check(spark):
    """One changed value, or nulls in other places, is told although the counts agree."""
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.0), (2, None, 2.0), (3, "c", 0.5)], "id int, name string, x double")
    path = scratch_path(spark, "content")
    ok = files.write_verified(df.repartition(3), path, "t").first()
    assert tuple(ok) == ("t", 4, 4, True, "PASS")
    sums = df.agg(*files.content_sums(df)).first().asDict()
    assert tuple(files.compare_content(spark, path, "t", sums, df.columns).first())[3:] == (True, "PASS")
    for changed in (df.withColumn("x", F.when(F.col("id") == 3, 0.25).otherwise(F.col("x"))),
                    df.withColumn("name", F.when(F.col("id") == 1, None).when(F.col("id") == 2, "a").otherwise(F.col("name"))),
                    df.where("id < 3").union(df.where("id = 1"))):
        other = scratch_path(spark, "content")
        changed.write.parquet(other)
        r = files.compare_content(spark, other, "t", sums, df.columns).first()
        assert (r["rows_read"], r["same_content"], r["status"]) == (4, False, "FAIL")
    assert files.write_verified(df.limit(0), scratch_path(spark, "content"), "t").first()["status"] == "PASS"
