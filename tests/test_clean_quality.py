"""Cleaning, name maps, quality checks."""

import pytest
from match_cases import rows
from matchlab.operators import clean, quality
from matchlab.schemas import RESULTS


def _raw(spark, data):
    return spark.createDataFrame(data, RESULTS)


def test_null_scores_and_bad_tokens(spark):
    raw = _raw(spark, [
        ("2000-01-01", "A", "B", None, 1, "T", "c", "k", "FALSE"),     # null home
        ("2000-01-02", "A", "B", 1, None, "T", "c", "k", "FALSE"),     # null away
        ("2000-01-03", "A", "B", None, None, "T", "c", "k", "FALSE"),  # both
        ("not-a-date", "A", "B", 1, 0, "T", "c", "k", "TRUE"),         # bad date
        ("2000-01-04", "A", "B", 2, 1, "T", "c", "k", "maybe"),        # bad boolean
        ("2000-01-05", "A", "B", -1, 0, "T", "c", "k", "TRUE"),        # negative
        ("2000-01-06", "A", "B", 0, 0, "T", "c", "k", "true"),
    ])
    c = clean.clean_matches(raw)
    got = sorted(rows(c, "date", "result", "neutral"), key=str)
    assert [str(d) for d, _, _ in got] == ["2000-01-04", "2000-01-06"]
    assert {r for _, r, _ in got} == {"W", "D"}                       # never 'L' from nulls
    assert [n for _, _, n in got] == [None, True]
    rep = quality.cleaning_report(clean.parse_results(raw), clean.keep_predicate()).first()
    assert (rep["original_rows"], rep["clean_rows"], rep["dropped_rows"]) == (7, 2, 5)


def test_padded_names_and_former_dates(spark):
    fn = spark.createDataFrame([("Current", "Old", "1990-01-01", "1995-12-31")],
                               "current string, former string, start_date string, end_date string")
    raw = _raw(spark, [
        ("1992-05-05", " Old", "X  ", 1, 0, "T", "c", "k", "FALSE"),
        ("1999-05-05", "Old", "X", 1, 0, "T", "c", "k", "FALSE"),
        ("1989-05-05", "X", "Old ", 0, 0, "T", "c", "k", "FALSE"),
    ])
    c = clean.clean_matches(raw, fn)                    # trim first, then map (all dates)
    assert sorted(rows(c, "home_team", "away_team")) == [("Current", "X"), ("Current", "X"), ("X", "Current")]
    dated = clean.normalise_names(clean.clean_matches(raw), fn, respect_dates=True)
    got = sorted(rows(dated, "date", "home_team", "away_team"), key=lambda r: str(r[0]))
    assert [(h, a) for _, h, a in got] == [("X", "Old"), ("Current", "X"), ("Old", "X")]
    assert quality.forbidden_names(c, fn).first()["former_names_left"] == 0


def test_match_id_derived_when_absent(spark):
    raw = _raw(spark, [("2000-01-01", "A", "B", 1, 0, "T", "c", "k", "FALSE"),
                       ("2000-01-01", "A", "B", 1, 0, "T", "c", "k", "FALSE"),
                       ("2000-01-01", "A", "B", 2, 0, "T", "c", "k", "FALSE")])
    ids = [r["match_id"] for r in clean.clean_matches(raw).collect()]
    assert len(set(ids)) == 3


def test_column_tests_gate_and_summary(spark):
    df = spark.createDataFrame([(1, "W"), (1, "X"), (None, "D")], "match_id bigint, result string")
    t = quality.column_tests(df, "m", not_null=["match_id"], unique=["match_id"],
                             accepted={"result": ["W", "D", "L"]})
    got = {(r["test_name"], r["column_name"]): (r["failures"], r["status"]) for r in t.collect()}
    assert got == {("not_null", "match_id"): (1, "FAIL"), ("unique", "match_id"): (1, "FAIL"),
                   ("accepted_values", "result"): (1, "FAIL")}
    with pytest.raises(quality.QualityGateError):
        quality.gate(t)
    assert rows(quality.test_summary(t)) == [("FAIL", 3)]


def test_null_counts_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert sorted(rows(quality.null_counts(df))) == [("a", 1), ("b", 2)]
    plan = quality.null_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1


def test_row_contract(spark):
    a = spark.range(5)
    got = {r["table_name"]: r["status"] for r in quality.row_contract(
        {"a": a, "b": a.limit(1)}, {"a": 3, "b": 3, "c": 1}).collect()}
    assert got == {"a": "PASS", "b": "LOW", "c": "MISSING"}


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    x = np.concatenate([np.full(2000, 1.0), rng.normal(0, 3, 3001)])
    df = spark.createDataFrame([(float(v), float(v) * 2) for v in x], "a double, b double").repartition(8)
    got = {r["column_name"]: r for r in quality.exact_quantiles(df, ["a", "b"]).collect()}
    for c, arr in (("a", x), ("b", x * 2)):
        for p in (25, 50, 75):
            assert abs(got[c][f"p{p}"] - float(np.percentile(arr, p))) < 1e-9


def test_ids_are_unique_for_copies(spark):
    from matchlab.operators.clean import with_match_id
    df = spark.createDataFrame([("2000-01-01", "A", i % 3) for i in range(300)] + [("2000-01-02", "B", None)] * 5, "date string, home_team string, x int").repartition(7)
    out = with_match_id(df)
    assert out.count() == 305 == out.select("match_id").distinct().count()
    order = [r["date"] for r in out.orderBy("match_id").collect()]
    assert order == sorted(order)


def test_overlapping_validity_does_not_multiply_rows(spark):
    from pyspark.sql import functions as F

    from matchlab.operators.clean import normalise_names
    df = spark.createDataFrame([("2000-06-01", "Old", "X"), ("1990-01-01", "Old", "X"), ("2010-01-01", "Old", "Old")], "date string, home_team string, away_team string").withColumn("date", F.col("date").cast("date"))
    names = spark.createDataFrame([("New", "Old", "1999-01-01", "2005-01-01"), ("Newer", "Old", "2000-01-01", "2003-01-01")], "current string, former string, start_date string, end_date string")
    got = sorted((str(r["date"]), r["home_team"], r["away_team"]) for r in normalise_names(df, names, respect_dates=True).collect())
    assert got == [("1990-01-01", "Old", "X"), ("2000-06-01", "Newer", "X"), ("2010-01-01", "Old", "Old")]
