"""CSV/parquet round trips, the streaming refresh, the end-to-end runs."""

import os

from pyspark.sql import functions as F

from match_cases import SF001, rows
from matchlab.config import NOTEBOOK
from matchlab.operators import marts
from matchlab.plans import build
from matchlab.schemas import RESULTS
from matchlab.session import scratch_path
from matchlab.sources import adapter, files


def test_csv_round_trip_keeps_padding(spark):
    raw = adapter.raw_results(spark, SF001).drop("match_id")
    path = scratch_path(spark, "csv")
    files.write_csv(raw, path)
    back = files.read_csv(spark, path, RESULTS)
    assert sorted(rows(back), key=str) == sorted(rows(raw), key=str)
    assert back.filter(F.col("home_team").startswith(" ")).count() > 0


def test_write_counted(spark):
    r = files.write_counted(adapter.matches(spark, SF001), scratch_path(spark, "rt"), "m").first()
    assert r["rows_written"] == r["rows_read"] == 716 and r["status"] == "PASS"


def test_write_counted_partitioned_and_sorted(spark):
    m = adapter.matches(spark, SF001).withColumn("year", F.year("date"))
    path = scratch_path(spark, "rt")
    r = files.write_counted(m, path, "m", partition_by=["year"], sort_within=["date", "match_id"]).first()
    assert r["rows_written"] == r["rows_read"] == 716 and r["status"] == "PASS"
    # the order inside each file
    got = spark.read.parquet(path).select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("k"), "date", "match_id").collect()
    by = {}
    for x in sorted(got, key=lambda x: x.k):
        by.setdefault(x.f, []).append((x.date, x.match_id))
    assert all(v == sorted(v) for v in by.values()) and len(by) > 1


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    import pytest

    from matchlab import session

    class Conf:
        def get(self, k, d=None):
            return d

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_discard(spark):
    from matchlab.session import discard, materialize
    df = materialize(spark.range(5), "gone")
    assert df.count() == 5 and os.path.isdir(df._scratch.replace("file:", ""))
    discard(df)
    assert not os.path.isdir(df._scratch.replace("file:", ""))


def test_streaming_refresh(spark):
    from matchlab.streaming.refresh import latest, start_refresh
    base = scratch_path(spark, "refresh")
    inbox = os.path.join(base, "inbox")
    raw = adapter.raw_results(spark, SF001).drop("match_id")

    def run(checkpoint):
        q = start_refresh(spark, inbox, f"{base}/raw", f"{base}/matches", f"{base}/features", f"{base}/{checkpoint}", cfg=NOTEBOOK.with_(min_date=None))
        q.awaitTermination(300)
        assert q.exception() is None
        return latest(spark, f"{base}/matches"), latest(spark, f"{base}/features")

    files.write_csv(raw, inbox)
    m, f = run("ckpt")
    n = m.count()
    assert f.count() == n > 0
    # the same rows in a second file: twice as many matches, ids still unique
    files.write_csv(raw.coalesce(1), inbox, mode="append")
    m, f = run("ckpt")
    assert m.count() == f.count() == 2 * n == m.select("match_id").distinct().count()
    # a batch that runs again (a new checkpoint replays everything as epoch 0) adds nothing
    m, _ = run("replayed")
    assert spark.read.parquet(f"{base}/matches/build=0").count() == 2 * n


def test_incremental_refresh(spark):
    """Two files, one after the other, give what one full build of both gives."""
    from matchlab.operators import clean, incremental
    from matchlab.operators.features import match_features
    from matchlab.streaming.refresh import start_incremental
    base = scratch_path(spark, "refresh")
    raw = adapter.raw_results(spark, SF001).drop("match_id")
    for part, mode in ((raw.where("date < '1998-06-01'"), "overwrite"), (raw.where("NOT date < '1998-06-01'"), "append")):
        files.write_csv(part, f"{base}/inbox", mode=mode)
        q = start_incremental(spark, f"{base}/inbox", f"{base}/store", f"{base}/ckpt")
        q.awaitTermination(300)
        assert q.exception() is None
    built = spark.read.parquet(f"{base}/store/matches").drop("batch")
    assert built.count() == clean.clean_matches(raw, None).count() == built.select("match_id").distinct().count()
    assert built.where(F.col("match_id") >= 1 << 40).count() > 100
    want = match_features(built, NOTEBOOK)
    got = incremental.match_features(spark, f"{base}/store")
    cols = [c for c in got.columns if dict(got.dtypes)[c] != "double"]
    sums = [F.round(F.sum(c), 5).alias(c) for c in got.columns if c not in cols]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0 and got.agg(*sums).first() == want.agg(*sums).first()


def test_run_all(spark):
    base = scratch_path(spark, "run")
    raw = adapter.raw_results(spark, SF001)
    fixtures = marts.stg_fixtures(adapter.fixtures_raw(spark, SF001))
    preds = build.run_all(spark, raw, adapter.former_names(spark, SF001), fixtures, base, NOTEBOOK)
    assert preds.count() == 50
    s = preds.select((F.col("win_prob") + F.col("draw_prob") + F.col("loss_prob")).alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-3 for r in s)
