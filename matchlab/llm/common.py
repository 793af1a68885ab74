"""Helpers shared by the corpus operators: table access, the id/text view
every operator works on, held-out splits and bounded batches for Arrow tasks."""

from __future__ import annotations

import gc
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchlab import session

#: Characters of text that an Arrow task works on at once.
SLICE_CHARS = 1 << 21


def importable(spark: SparkSession) -> None:
    """Python workers on this machine find the package where the driver found
    it; on other machines it is sent along with the application (--py-files)."""
    environment = spark.sparkContext.environment
    top = str(Path(__file__).resolve().parents[2])
    if top not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [top, environment.get("PYTHONPATH")]))


_KEPT: list[DataFrame] = []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back. What the plan so far
    has shuffled isn't needed any more: Spark deletes it when the JVM collects
    the plan, which is asked for here, for plans of many steps."""
    out = session.materialize(df, name)
    _KEPT.append(out)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def sweep(spark: SparkSession) -> None:
    """Asks for what plans that nothing refers to any more have shuffled to be deleted."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def kept() -> int:
    """How many tables ``materialize`` has written so far."""
    return len(_KEPT)


def release(since: int) -> None:
    """Deletes what ``materialize`` has written after ``kept()`` was ``since``: for
    a caller that has stored all results that read it, and that nothing else
    used the library meanwhile."""
    while len(_KEPT) > since:
        session.discard(_KEPT.pop())


def load(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(df: DataFrame, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``more``; further columns of the
    input, whatever their names, don't travel with it."""
    return df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"), *more)


def held_out(id_col: Column, mod: int, rest: int) -> Column:
    """crc32 of the id as text, mod ``mod``, is ``rest``; a null id is never held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % mod == rest, F.lit(False))


def slices(batches, column: str = "text", most: int = SLICE_CHARS):
    """Consecutive parts of the record batches with about ``most`` bytes of
    ``column`` each (a single longer text makes a part of its own)."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def column(batch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def partitions_for(df: DataFrame, each_mb: int, least: int = 8) -> int:
    """Partitions of about ``each_mb`` MB, from the optimizer's size of the
    plan's input files; at least ``least`` and the session's shuffle setting."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    plain = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size > 1 << 60:      # unknown
        return max(plain, least)
    return max(least, plain, -(-size // (each_mb << 20)))
