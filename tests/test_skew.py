"""Bounded-task helpers: running totals over sorted ranges."""

import numpy as np
import pytest

from matchlab.operators.skew import running_total


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_total_matches_brute_force(spark, descending, inclusive):
    rng = np.random.default_rng(5)
    # group "big" holds most rows; values repeat (ties)
    recs = [("big" if i % 5 else "small", int(rng.integers(0, 300)), int(rng.integers(1, 4)))
            for i in range(3000)]
    df = spark.createDataFrame(recs, "g string, v int, a int").repartition(8)
    got = {(r["g"], r["v"]): r["c"] for r in
           running_total(df, ["g"], "v", "a", "c", descending=descending, inclusive=inclusive).collect()}
    for (g, v), c in got.items():
        rows_g = [(vv, aa) for gg, vv, aa in recs if gg == g]
        if descending:
            before = sum(aa for vv, aa in rows_g if vv > v)
        else:
            before = sum(aa for vv, aa in rows_g if vv < v)
        ties = sum(aa for vv, aa in rows_g if vv == v)
        assert c == before + (ties if inclusive else 0)


def test_running_total_with_many_ranges(spark):
    recs = [("g", v % 50, 1) for v in range(1000)]
    df = spark.createDataFrame(recs, "g string, v int, a int")
    got = {r["v"]: r["c"] for r in running_total(df, ["g"], "v", "a", "c", partitions=33).collect()}
    assert got == {v: 20 * (v + 1) for v in range(50)}


def test_running_total_without_group(spark):
    recs = [(v % 37, 1 + v % 3) for v in range(2000)]
    df = spark.createDataFrame(recs, "v int, a int").repartition(8)
    got = {r["v"]: r["c"] for r in running_total(df, [], "v", "a", "c", descending=True,
                                                  inclusive=False).collect()}
    for v, c in got.items():
        assert c == sum(a for vv, a in recs if vv > v)
