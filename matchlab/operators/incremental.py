"""W01-W20 kept up to date batch by batch.

``advance`` adds a batch of matches and computes features of its matches
only. State that it reads, whatever the history's length:

* each team's last 20 rows and its sums of the days that calendar frames can
  still reach (at most ``prior_days`` + 1 a team);
* each pair's totals and its latest meeting.

A row that comes late (before the latest match of its team or pair) changes
the features of what follows it. Then those rows, and no earlier ones, are
computed again, from the history's buckets of these teams and pairs; a batch
without late rows doesn't read the history.

Below ``path`` every batch writes its own folders (``batch=<id>``): ``matches``,
``team_rows`` and ``pair_rows`` (the history, by bucket of team and pair),
``tail_rows``, ``tail_days``, ``pairs`` (the state after it), ``team_features``
and ``pair_features`` (new and redone rows), and last ``done``. A batch that
runs again overwrites what it wrote and starts from the same state, so
it leaves the same rows; readers take batches that are done, and of a row
done twice the later one. Match ids have to be unique over all batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StructType

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.functions.columns import day_number
from matchlab.operators import h2h, rolling
from matchlab.operators.features import BASE_COLS, feature_columns, side_columns, sides_to_match
from matchlab.operators.perspective import team_view
from matchlab.schemas import EXTRA_FORM_COLS, H2H_COLS, TEAM_FEATURE_COLS

BUCKETS = 64
_TEAM_OUT = ["match_id", "date", "team", "opponent", "venue", *TEAM_FEATURE_COLS, *EXTRA_FORM_COLS]
_PAIR_OUT = [*BASE_COLS, "team_a", "team_b", *H2H_COLS]


def _at():
    return F.struct("day", "match_id")


class Store:
    """The folders of one feature store."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def done(self) -> list[int]:
        """Ids of the batches that are complete, in order."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/done")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [str(x.getPath().getName()) for x in fs.listStatus(folder)]
        whole = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(folder, f"{n}/_SUCCESS"))]
        return sorted(int(n.split("=")[1]) for n in whole)

    def write(self, df: DataFrame, name: str, batch: int, by: str | None = None) -> DataFrame:
        w = df.write.mode("overwrite")
        (w.partitionBy(by) if by else w).parquet(f"{self.path}/{name}/batch={batch}")
        return self.read(name, [batch], df.schema)

    def read(self, name: str, batches: list[int], schema=None) -> DataFrame:
        """Rows of these batches, with ``batch``. (A folder by bucket of a batch
        without rows has no file to take the ``schema`` from.)"""
        reader = self.spark.read.option("basePath", f"{self.path}/{name}")
        if schema is not None:
            reader = reader.schema(StructType([f for f in schema.fields if f.name != "batch"]).add("batch", IntegerType()))
        return reader.parquet(*[f"{self.path}/{name}/batch={b}" for b in batches])


def _bucket(*cols: str):
    return F.pmod(F.xxhash64(*cols), F.lit(BUCKETS)).cast("int")


def _history(store: Store, name: str, batches: list[int], rows: DataFrame, late: DataFrame, keys: list[str]) -> DataFrame:
    """The history's rows of the keys in ``late``; only their buckets (at most ``BUCKETS``) are read."""
    buckets = [r[0] for r in late.select(_bucket(*keys)).distinct().collect()]
    schema = StructType(list(rows.schema.fields)).add("bucket", IntegerType())
    return store.read(name, batches, schema).where(F.col("bucket").isin(buckets)).drop("bucket", "batch").join(late, keys)


def _latest(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(_at()).alias("_last"))


def _first_late(rows: DataFrame, last: DataFrame, keys: list[str]) -> DataFrame:
    """``_from``: the first row of the batch that comes before its key's latest one so far."""
    return rows.join(last, keys).where(_at() < F.col("_last")).groupBy(*keys).agg(F.min(_at()).alias("_from"))


def _teams(store: Store, batch: int, before: list[int], tv: DataFrame, cfg: FeatureConfig) -> None:
    """Features of the batch's team rows and of those that late rows change; the next state."""
    depth, reach = rolling._depth(), cfg.prior_days
    fresh = rolling.day_sums(tv, cfg, "team")
    if before:
        tail, days = (store.read(n, before[-1:]).drop("batch") for n in ("tail_rows", "tail_days"))
        rows, sums = tail.unionByName(tv), days.unionByName(fresh)
    else:
        rows, sums = tv, fresh
    values = [c for c in fresh.columns if c not in ("team", "day")]
    sums = sums.groupBy("team", "day").agg(*[F.sum(c).alias(c) for c in values])

    # what the next batch needs
    back = Window.partitionBy("team").orderBy(F.desc("day"), F.desc("match_id"))
    store.write(rows.withColumn("_rk", F.row_number().over(back)).where(F.col("_rk") <= depth).drop("_rk"), "tail_rows", batch)
    newest = sums.groupBy("team").agg(F.max("day").alias("_newest"))
    store.write(sums.join(newest, "team").where(F.col("day") >= F.col("_newest") - reach).drop("_newest"), "tail_days", batch)

    here = tv.select("team").distinct()
    late = store.write(_first_late(tv, _latest(tail, ["team"]), ["team"]), "late_teams", batch).drop("batch") if before else None
    if late is None or late.isEmpty():
        known = rows.join(here, "team", "left_semi")
        todo = tv.select("match_id", "team")
        known_days = sums.join(here, "team", "left_semi")
        out = rolling.rolling_features(known, cfg, days=known_days).join(todo, ["match_id", "team"], "left_semi")
    else:
        # late teams: their rows from the first late one on, with what their frames reach before it
        past = _history(store, "team_rows", before, tv, late, ["team"]).unionByName(tv.join(late, "team"))
        earlier = Window.partitionBy("team").orderBy(F.desc("day"), F.desc("match_id"))
        near = past.where(_at() < F.col("_from")).withColumn("_rk", F.row_number().over(earlier)).where(F.col("_rk") <= depth).drop("_rk")
        after = past.where(_at() >= F.col("_from"))
        redo = near.unionByName(after).drop("_from")
        redo_days = rolling.day_sums(past.where(F.col("day") >= F.col("_from.day") - reach), cfg, "team")
        on_time = here.join(late, "team", "left_anti")
        known = rows.join(on_time, "team", "left_semi").unionByName(redo)
        known_days = sums.join(on_time, "team", "left_semi").unionByName(redo_days)
        todo = tv.select("match_id", "team").union(after.select("match_id", "team")).distinct()
        out = rolling.rolling_features(known, cfg, days=known_days).join(todo, ["match_id", "team"], "left_semi")
    store.write(out.select(*_TEAM_OUT), "team_features", batch)


def _pairs(store: Store, batch: int, before: list[int], base: DataFrame, cfg: FeatureConfig) -> None:
    """The head-to-head of the batch's meetings and of those that late ones change; the next state."""
    keys, counts = h2h.PAIR, [c for c, _ in h2h._COUNTS]
    own = base.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts], F.count(F.lit(1)).alias("n"), F.max(_at()).alias("_last"))
    old = store.read("pairs", before[-1:]).drop("batch") if before else None
    every = own if old is None else old.unionByName(own).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in [*counts, "n"]], F.max("_last").alias("_last"))
    store.write(every, "pairs", batch)

    late = store.write(_first_late(base, old.select(*keys, "_last"), keys), "late_pairs", batch).drop("batch") if before else None
    todo, start = base, old
    if late is not None and not late.isEmpty():
        past = _history(store, "pair_rows", before, base, late, keys).unionByName(base.join(late, keys))
        todo = base.join(late, keys, "left_anti").unionByName(past.where(_at() >= F.col("_from")).drop("_from"))
        gone = past.where(_at() < F.col("_from")).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts], F.count(F.lit(1)).alias("n"))
        start = old.drop("_last").join(late, keys, "left_anti").unionByName(gone)
    out = h2h.running_record(todo.withColumnRenamed("day", "_day"), None if start is None else start.drop("_last"), cfg)
    store.write(out.select(*_PAIR_OUT), "pair_features", batch)


def advance(spark: SparkSession, path: str, batch: int, matches: DataFrame, cfg: FeatureConfig = NOTEBOOK) -> None:
    """Adds a batch of matches (``features.BASE_COLS``) to the store at ``path``."""
    store = Store(spark, path)
    done = store.done()
    if any(b > batch for b in done):
        raise ValueError(f"batch {batch} can't run again: later ones are done")
    before = [b for b in done if b < batch]
    cfg = cfg.with_(strategy="ranged")
    m = matches.select(*BASE_COLS)
    if cfg.min_date is not None and cfg.min_date_applied == "before":
        m = m.where(F.col("date") >= F.lit(cfg.min_date))
    m = store.write(m, "matches", batch).drop("batch")
    tv = store.write(team_view(m).withColumn("bucket", _bucket("team")), "team_rows", batch, "bucket").drop("bucket", "batch")
    base = h2h.pair_outcomes(m).withColumn("day", day_number("date"))
    base = store.write(base.withColumn("bucket", _bucket(*h2h.PAIR)), "pair_rows", batch, "bucket").drop("bucket", "batch")
    _teams(store, batch, before, tv, cfg)
    _pairs(store, batch, before, base, cfg)
    store.write(spark.range(1), "done", batch)


def _current(store: Store, name: str, keys: list[str]) -> DataFrame:
    """The rows of all batches; of a row that was done again, the last one."""
    rows = store.read(name, store.done())
    newest = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "batch")


def team_features(spark: SparkSession, path: str) -> DataFrame:
    """W01-W15 of all matches added so far."""
    return _current(Store(spark, path), "team_features", ["match_id", "team"])


def pair_features(spark: SparkSession, path: str) -> DataFrame:
    """W16-W20 of all matches added so far."""
    return _current(Store(spark, path), "pair_features", ["match_id"])


def match_features(spark: SparkSession, path: str, cfg: FeatureConfig = NOTEBOOK) -> DataFrame:
    """What ``features.match_features`` gives for all matches added so far."""
    out = pair_features(spark, path).join(sides_to_match(team_features(spark, path)), "match_id", "left")
    out = out.fillna(cfg.fill, subset=side_columns("home") + side_columns("away"))
    if cfg.min_date is not None and cfg.min_date_applied == "after":
        out = out.where(F.col("date") >= F.lit(cfg.min_date))
    return out.select(*BASE_COLS, *feature_columns())
