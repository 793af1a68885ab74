"""Refresh: new raw result files arrive in a folder.

``start_incremental`` cleans each batch and adds it to a feature store
(``operators.incremental``): features of its own matches, and of those that
late rows change, are computed from the store's state. Ids are epoch * 2^40 +
the id within the batch, so a batch that runs again gives the same ones.

``start_refresh`` adds the rows to a table of raw rows and rebuilds the match
and the feature table from all of them, with ids of the whole table: for a
changed configuration or former-name table.

``trigger(availableNow=True)`` processes what has arrived and stops — the
streaming form of the original's daily batch run. ``foreachBatch`` runs at
least once: a batch's rows overwrite the folder of its epoch, so a batch that
runs again leaves the same rows; a build is a folder of its own, and readers
take the last complete one (``latest``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchlab.config import FeatureConfig, NOTEBOOK
from matchlab.operators import clean, incremental
from matchlab.operators.features import match_features
from matchlab.schemas import RESULTS
from matchlab.sources import files


def _arrivals(spark: SparkSession, inbox: str) -> DataFrame:
    return (spark.readStream.schema(RESULTS).option("header", "true")
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
            .csv(inbox))


def start_incremental(spark: SparkSession, inbox: str, store: str, checkpoint: str, former_names: DataFrame | None = None,
                      cfg: FeatureConfig = NOTEBOOK, available_now: bool = True):
    def _batch(batch: DataFrame, epoch_id: int) -> None:
        m = clean.clean_matches(batch, former_names, cfg)
        m = m.withColumn("match_id", F.col("match_id") + F.lit(epoch_id * (1 << 40)))
        incremental.advance(spark, store, epoch_id, m, cfg)

    w = _arrivals(spark, inbox).writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 day")).start()


def start_refresh(spark: SparkSession, inbox: str, raw_path: str, matches_path: str, features_path: str,
                  checkpoint: str, former_names: DataFrame | None = None,
                  cfg: FeatureConfig = NOTEBOOK, available_now: bool = True):
    def _batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{raw_path}/epoch={epoch_id}")
        every = spark.read.schema(RESULTS).parquet(*[f"{raw_path}/epoch={e}" for e in range(epoch_id + 1)])
        built = f"{matches_path}/build={epoch_id}"
        clean.clean_matches(every, former_names, cfg).write.mode("overwrite").parquet(built)
        files.write_table(match_features(files.read_parquet(spark, built), cfg.with_(materialize_input=False)),
                          f"{features_path}/build={epoch_id}")

    w = _arrivals(spark, inbox).writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 day")
    return w.start()


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last complete build below ``path``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    builds = [str(x.getPath()) for x in fs.listStatus(folder)]
    done = [b for b in builds if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{b}/_SUCCESS"))]
    return files.read_parquet(spark, max(done, key=lambda b: int(b.rsplit("=", 1)[1])))
