"""The corpus pipeline: language ID, line dedup, near-dedup, substring dedup,
packing. Each stage gets its predecessor's rows, read again from Parquet, and
works on all of them. All but the last return the columns of documents;
``n_chars`` follows the text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlab.llm.common import importable, kept, load, release
from matchlab.llm.langid import keep_identified
from matchlab.llm.linededup import drop_repeated_lines
from matchlab.llm.minhash import drop_near_duplicates
from matchlab.llm.packing import pack
from matchlab.llm.queries import TOKENIZER
from matchlab.llm.suffixdedup import drop_repeats
from matchlab.session import discard, materialize

#: Bytes of an Arrow batch. Rows travel with all their columns in and out of
#: Python, and a worker holds both sides of a batch.
BATCH_BYTES = 8 << 20


def ready(spark: SparkSession) -> None:
    """Workers find the package, and Arrow batches are bounded by bytes, not only by rows."""
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told with probability 0.5 or more, and
    whose n-grams are as likely in it as those of other texts."""
    ready(spark)
    return keep_identified(docs, 0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of two or more lines, and of lines of 200 or more
    characters, deleted; documents with nothing left go."""
    ready(spark)
    return drop_repeated_lines(docs, run=2)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of documents whose sets of five-word
    shingles have a similarity of 0.8 or more."""
    ready(spark)
    return drop_near_duplicates(docs, percent=80, size=5)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in strings of 200 bytes that occur elsewhere removed; documents with nothing left go."""
    ready(spark)
    return drop_repeats(docs, length=200)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, cut and packed into sequences of 1024 ids."""
    ready(spark)
    return pack(docs, TOKENIZER)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("packing", packing)]

#: Classifiers, suffix arrays and tokenization aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = load(spark, sf_dir), None
    for name, stage in STAGES:
        since = kept()
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(since)      # what the stage wrote for itself; its result is stored
        if before is not None:
            discard(before)
        before = docs
    return docs
