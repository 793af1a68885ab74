"""Exact selection, places in ranges, ordered files, strings in parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from match_cases import rows
from matchlab.operators import ml, quality, reports
from matchlab.operators.selection import exact_ranks, keys_of, value_of
from matchlab.operators.skew import positions
from matchlab.session import scratch_path
from matchlab.sources import files


def test_keys_keep_the_order():
    x = np.array([-np.inf, -1e300, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, np.nextafter(1, 2), 1e300, np.inf, np.nan])
    k = keys_of(x)
    assert k[4] == k[5] and (np.diff(k)[[i for i in range(11) if i != 4]] > 0).all()
    back = [value_of(int(v)) for v in k]
    assert np.array_equal(back, np.where(x == 0, 0.0, x), equal_nan=True)


def test_ranks_equal_sorting(spark, monkeypatch):
    rnd = random.Random(3)
    a = [rnd.choice([0.1, 0.2, 0.5, None]) for _ in range(1000)]
    b = [rnd.gauss(0, 10.0 ** rnd.randint(-200, 200)) for _ in range(1000)]
    c = [rnd.choice([float("inf"), float("-inf"), float("nan"), -0.0, 0.0, 1.0]) for _ in range(1000)]
    df = spark.createDataFrame([(*x, None) for x in zip(a, b, c)], "a double, b double, c double, d double").repartition(5)
    from matchlab.operators import selection
    passes, real = [], selection._pass
    monkeypatch.setattr(selection, "_pass", lambda *x: passes.append(1) or real(*x))
    got = exact_ranks(df, ["a", "b", "c", "d"], lambda n: [1, 2, n // 3, n // 2, n])
    for c_, v in (("a", [x for x in a if x is not None]), ("b", b), ("c", c)):
        order = sorted(v, key=lambda x: (x != x, x))
        n, at = got[c_]
        assert n == len(v) and np.array_equal([at[r] for r in sorted(at)], [order[r - 1] for r in sorted(at)], equal_nan=True)
    assert got["d"] == (0, {}) and len(passes) <= 7
    assert exact_ranks(df.limit(0), ["a"], lambda n: [1]) == {"a": (0, {})}


def test_quantiles_and_medians(spark):
    v = [3.0, 1.0, 2.0, 10.0, 7.0, 7.0, 0.5]
    df = spark.createDataFrame([(x, None) for x in v] + [(None, None)], "x double, y double")
    r = quality.exact_quantiles(df, ["x", "y"], (0.1, 0.25, 0.5, 0.75)).collect()
    assert len(r) == 1 and np.allclose(list(r[0])[1:], np.quantile(v, [.1, .25, .5, .75]))
    assert rows(ml.feature_medians(df, ["x", "y"])) == [("x", 3.0)]


def test_positions(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["h", "h", "h", "a", None]), i * 37 % 1009) for i in range(900)]
    got = positions(spark.createDataFrame(data, "g string, i int"), ["g"], ["i"], "k", "n", partitions=7).collect()
    for g in ("h", "a", None):
        own = sorted(i for x, i in data if x == g)
        assert sorted((r["k"], r["i"]) for r in got if r["g"] == g) == list(enumerate(own, 1))
        assert {r["n"] for r in got if r["g"] == g} == {len(own)}


def test_ordered_files(spark):
    """Files follow each other, also on a hot date, and give the whole order back."""
    df = spark.range(2000).select(F.expr("date_add(DATE '2000-01-01', IF(id % 3 = 0, 50, CAST(id * 7919 % 300 AS INT)))").alias("date"), F.col("id").alias("match_id"))
    path, order = scratch_path(spark, "ordered"), ["date", "match_id"]
    table = files.write_ordered(df.repartition(5), path, order, 8).collect()
    assert len(table) > 3 and all(r["follows"] for r in table) and sum(r["n_rows"] for r in table) == 2000
    hot = [r for r in table if str(r["first"]["date"]) <= "2000-02-20" <= str(r["last"]["date"])]
    assert len(hot) > 1
    got = files.read_ordered(spark, path, order).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 2001))
    assert [(r["date"], r["match_id"]) for r in got] == sorted((r["date"], r["match_id"]) for r in df.collect())
    assert spark.read.parquet(path).count() == 2000
    # a file written behind the others' backs
    broken = scratch_path(spark, "ordered")
    files.write_ordered(df, broken, order, 4)
    t = spark.read.parquet(f"{broken}/_files").withColumn("follows", F.col("file") != 1)
    t.cache().count()
    t.write.mode("overwrite").parquet(f"{broken}/_files")
    with pytest.raises(ValueError, match="follow"):
        files.read_ordered(spark, broken, order)


def test_strings_in_parts(spark):
    df = spark.range(1003).select(F.when(F.col("id") % 4 == 0, "few").otherwise("hot").alias("g"), F.col("id"), (F.col("id") % 10).cast("string").alias("t"))
    got = reports.ordered_string_parts(df, ["g"], ["id"], "t", ",", "s", 50).collect()
    assert max(len(r["s"].split(",")) for r in got) == 50
    for g in ("few", "hot"):
        own = ",".join(r["s"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["part"]))
        assert own == ",".join(str(i % 10) for i in range(1003) if (i % 4 == 0) == (g == "few"))
