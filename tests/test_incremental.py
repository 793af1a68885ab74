"""W01-W20 batch by batch against a full build."""

import random

import pytest
from pyspark.sql import functions as F

from match_cases import make_matches
from matchlab.config import DAG, NOTEBOOK
from matchlab.operators import incremental
from matchlab.operators.features import match_features
from matchlab.operators.incremental import Store, advance
from matchlab.session import scratch_path


def season(n=700, seed=1, teams="ABCDE"):
    """Matches over six years; A plays in a third more of them; several a day."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        h, a = rnd.sample(teams, 2)
        if rnd.random() < .5 and "A" not in (h, a):
            h = "A"
        day = 11000 + i * 3 + rnd.randint(0, 9)
        date = str((__import__("datetime").date(1970, 1, 1) + __import__("datetime").timedelta(day)))
        out.append((i * 7919 % 100003, date, h, a, rnd.randint(0, 3), rnd.randint(0, 3)))
    return out


def same(spark, path, rows, cfg):
    got = incremental.match_features(spark, path, cfg)
    want = match_features(make_matches(spark, rows), cfg.with_(strategy="window"))
    assert got.columns == want.columns
    rounded = lambda df: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())
    assert rounded(got) == rounded(want)


@pytest.mark.parametrize("cfg", [NOTEBOOK.with_(range_partitions=5), DAG])
def test_batches_equal_a_full_build(spark, cfg):
    rows = season()
    path = scratch_path(spark, "store")
    late = [r for r in rows[100:300] if r[0] % 23 == 0]
    assert len(late) > 3
    on = [r for r in rows if r not in late]
    batches = [on[:300], late[:2] + on[300:500], late[2:], on[500:]]
    for k, part in enumerate(batches):
        advance(spark, path, k, make_matches(spark, part), cfg)
        if k == 1:      # a batch that runs again leaves the same rows
            advance(spark, path, k, make_matches(spark, part), cfg)
            same(spark, path, sum(batches[:k + 1], []), cfg)
    same(spark, path, rows, cfg)
    with pytest.raises(ValueError, match="later ones"):
        advance(spark, path, 1, make_matches(spark, batches[1]), cfg)


def test_unfinished_batch_is_not_read(spark):
    rows = season(60)
    path = scratch_path(spark, "store")
    advance(spark, path, 0, make_matches(spark, rows[:40]))
    store = Store(spark, path)
    store.write(store.read("pair_features", [0]).drop("batch"), "pair_features", 1)
    assert store.done() == [0] and incremental.pair_features(spark, path).count() == 40
    advance(spark, path, 1, make_matches(spark, rows[40:]))
    same(spark, path, rows, NOTEBOOK)


def test_empty_batch_and_new_teams(spark):
    rows = season(50)
    path = scratch_path(spark, "store")
    advance(spark, path, 0, make_matches(spark, rows).limit(0))
    advance(spark, path, 1, make_matches(spark, rows))
    advance(spark, path, 2, make_matches(spark, rows).limit(0))
    more = [(200000, "2005-01-01", "X", "A", 1, 0), (200001, "2005-01-01", "X", "Y", 1, 0), (200002, "2005-01-01", "Y", "X", 2, 2)]
    advance(spark, path, 3, make_matches(spark, more))
    same(spark, path, rows + more, NOTEBOOK)


def test_a_batch_reads_its_rows_and_the_state(spark, monkeypatch):
    """Without late rows the history isn't read, and the state doesn't grow with it."""
    rows = season(400)
    path = scratch_path(spark, "store")
    read, seen = Store.read, []
    monkeypatch.setattr(Store, "read", lambda self, name, batches, schema=None: seen.append((name, tuple(batches))) or read(self, name, batches, schema))
    for k in range(2):
        seen.clear()
        part = sorted(rows, key=lambda r: (r[1], r[0]))[k * 200:(k + 1) * 200]
        advance(spark, path, k, make_matches(spark, part))
        assert {b for _, b in seen} <= {(k,), (k - 1,)}
        assert {n for n, b in seen if b == (k - 1,)} <= {"tail_rows", "tail_days", "pairs"}
        assert spark.read.parquet(f"{path}/tail_rows/batch={k}").groupBy("team").count().agg(F.max("count")).first()[0] == 20
        days = spark.read.parquet(f"{path}/tail_days/batch={k}").groupBy("team").agg((F.max("day") - F.min("day")).alias("d"))
        assert days.agg(F.max("d")).first()[0] <= 365
