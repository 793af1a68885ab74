"""Session helpers: a local session for tests and the bench, and a
scratch folder under the cluster's shared ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "matchlab",
                  driver_memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or in
    ``setCheckpointDir``). Only a session on one machine may go without: it
    gets a folder of its own; anything else raises, as each executor would
    write to its own disk."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="matchlab-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def importable(spark: SparkSession) -> None:
    """Python workers on this machine find the package where the driver found
    it; on other machines it is sent along with the application (--py-files)."""
    environment = spark.sparkContext.environment
    top = str(Path(__file__).resolve().parents[1])
    if top not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [top, environment.get("PYTHONPATH")]))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/matchlab-scratch/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Cut the lineage of ``df``: write it as parquet to a fresh folder under
    the shared checkpoint dir and return a DataFrame that scans it. Plans
    that use one input in several branches then read a columnar table
    instead of recomputing it per branch, and a lost executor re-reads
    files instead of recomputing the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def materialize_counted(df, name: str):
    """``materialize`` that also returns the row count, taken on the write
    path with ``observe`` (no extra job)."""
    from pyspark.sql import Observation, functions as F
    obs = Observation(f"rows_{name}")
    out = materialize(df.observe(obs, F.count(F.lit(1)).alias("n")), name)
    return out, int(obs.get["n"])


def discard(df) -> None:
    """Deletes the folder of a DataFrame that ``materialize`` returned, when
    nothing reads it any more."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
