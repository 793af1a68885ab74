import math
import random

import numpy as np
import pytest

from matchlab.llm.pivots import Block, distances, far_apart, inner, matrix, top_k

SCHEMA = "vec_id bigint, embedding array<float>, rank string, score string, block string, q string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None) for i, v in rows], SCHEMA).repartition(5)


def brute(rows, k=5, every=50):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = 1
    out = []
    for i, q in whole:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in whole if j != i)[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(rnd, n, dim, centres=6):
    mid = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    return [[x + rnd.gauss(0, .1) for x in rnd.choice(mid)] for _ in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, small):
    rnd = random.Random(5)
    rows = list(enumerate(vectors(rnd, 700, 8)))
    rows += [(1000 + i, rows[3][1]) for i in range(300)]            # a hot vector
    rows += [(2000 + i, [0.0] * 8) for i in range(60)] + [(-50, rows[7][1]), (-7, rows[8][1])]
    more = dict(pivots=3, sample=20, block_rows=40, query_rows=4) if small else {}
    df = top_k(table(spark, rows), **more)
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and [t for _, t in df.dtypes] == ["bigint", "int", "bigint", "bigint"]
    assert result(df) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0]), (1, None), (2, [nan, 1.0]), (3, [1.0, None]), (4, [inf, 0.0]), (5, []), (6, [-1.0, 5.0, 7.0]),
            (None, [9.0, 9.0]), (50, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [0.0039, -0.0039]), (100, None)]
    assert result(top_k(table(spark, rows))) == brute(rows)
    assert result(top_k(table(spark, rows[:2]))) == []          # no candidate but the query's own row
    assert result(top_k(table(spark, [(1, [1.0])]))) == [] and result(top_k(table(spark, []))) == []
    assert result(top_k(table(spark, [(0, []), (1, []), (2, [1.0])]))) == [(0, 1, 1, 0), (0, 2, 2, 0)]


def test_huge_components(spark):
    rows = [(0, [1e20, 1.0]), (1, [1e20, 2.0]), (2, [-1e20, 3.0]), (3, [1e-3, 1e12]), (4, [3e38, 3e38])]
    got = {(r.query_id, r.vec_id): r.score for r in top_k(table(spark, rows)).collect()}
    assert got == {(0, 1): 2**63 - 1, (0, 4): 2**63 - 1, (0, 2): -2**63, (0, 3): math.floor(256 * float(np.float32(1e12))) * 256}


def test_blocks_pass_over_candidates():
    """Most candidates are never evaluated, and results stay exact."""
    rnd = np.random.default_rng(1)
    rows = np.floor(256 * (rnd.normal(size=(12, 16))[rnd.integers(0, 12, 6000)] + .02 * rnd.normal(size=(6000, 16))))
    pivots = far_apart(rows[:500], 12)
    dist = distances(rows, pivots)
    block = Block(list(range(6000)), [r.tobytes() for r in rows], [d.tobytes() for d in dist])
    seen = 0
    for i in range(0, 6000, 300):
        best, n = block.search(i, rows[i], dist[i], 5, -np.inf)
        seen += n
        scores = rows @ rows[i]
        assert best == sorted((-int(s), j) for j, s in enumerate(scores) if j != i)[:5]
        floor = -best[-1][0]
        assert block.search(i, rows[i], dist[i], 5, floor)[0] == best
    assert seen < 20 * 6000 / 3
    assert inner(matrix([np.array([2.0**60, 1]).tobytes()]), np.array([4.0, 3.0])) == [2**62 + 3]


def test_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from matchlab.llm.queries import QUERIES, SQL
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.01/embeddings.parquet')")
    cur = con.execute(SQL["op13_pivot_top_k"])
    names = [d[0] for d in cur.description]
    want = sorted(str(sorted(zip(names, r))) for r in cur.fetchall())
    got = sorted(str(sorted(r.asDict().items())) for r in QUERIES["op13_pivot_top_k"](spark, "/root/testdata/sf0.01").collect())
    assert got == want and len(got) == 50
