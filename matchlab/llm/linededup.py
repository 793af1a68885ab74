"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that aren't blank, as 128-bit hashes.
In every window of ``run`` lines the rightmost smallest hash is selected: a
fingerprint. Two equal windows select the same line, so every run of ``run``
or more lines that occurs twice has a fingerprint in common. A line of
``alone`` or more characters is a run by itself: a window of one line, which
is its own fingerprint. Fingerprints that occur once are dropped by a count
(aggregated before the shuffle). From each position of the others matches
extend both ways, by the windows that selected it; the first position of
every window (by 128 bits), in the order of id and line, is found by a
grouped minimum, and a window that isn't the first has its lines marked.
Overlapping marks are the maximal later runs; their lines are deleted.
Matches are judged on the input, not on what is left. No step lists pairs: a
fingerprint of a third of all documents is one group of a count and of
minima, and a skewed join that AQE may split.

Defined results: a null text is an empty one; blank lines (ASCII white space
only) are neither compared nor deleted; fewer lines than ``run`` stay, unless
they are long enough alone; a null id comes last, after it the text's hash decides; rows equal in id and
text are one document (both get its result); an empty table gives an empty
one; further columns travel along unread.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from matchlab.llm.common import column, materialize, slices

ALONE = 200     # characters of a line that is a run by itself

_INK = re.compile("[^ \t-\r]")


def solid(lines: list[str]) -> list[int]:
    """Places of the lines that aren't blank."""
    return [i for i, x in enumerate(lines) if _INK.search(x)]


def select(hashes: np.ndarray, run: int) -> np.ndarray:
    """For each window of ``run`` hashes the place of its rightmost minimum."""
    windows = np.lib.stride_tricks.sliding_window_view(hashes, run)
    return np.arange(len(windows)) + run - 1 - windows[:, ::-1].argmin(axis=1)


def line_hashes(lines: list[str]) -> np.ndarray:
    """128-bit hashes, as rows of two 64-bit numbers."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.encode()) for x in lines), np.uint64).reshape(-1, 2)


def window_hashes(hashes: np.ndarray, run: int) -> np.ndarray:
    h = np.full((len(hashes) - run + 1, 2), run, np.uint64)
    for k in range(run):
        h = (h ^ hashes[k:len(hashes) - run + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def fingerprints(docs: DataFrame, run: int, alone: int) -> DataFrame:
    """``fp, doc_id, uid, wins`` for each selected line: the windows (their
    first line's number, their size, the halves of their hash) that selected it."""

    def work(batches):
        for part in slices(batches):
            place, fps, wins, starts, lengths, sizes = [], [], [], [], [], []

            def add(row, fp, start, win, length, counts):
                place.append(np.full(len(fp), row))
                fps.append(fp)
                starts.append(start)
                wins.append(win)
                lengths.append(np.full(len(win), length))
                sizes.append(counts)

            for row, text in enumerate(column(part, "text").to_pylist()):
                lines = text.split("\n")
                keep = solid(lines)
                long = [k for k, i in enumerate(keep) if len(lines[i]) >= alone] if run > 1 else []
                if len(keep) < run and not long:
                    continue
                h = line_hashes([lines[i] for i in keep])
                if len(keep) >= run:
                    at = select(h[:, 0], run)
                    first = np.flatnonzero(np.diff(at, prepend=-1))      # windows of one fingerprint follow each other
                    add(row, h[at[first], 0], np.arange(len(at)), window_hashes(h, run), run, np.diff(first, append=len(at)))
                if long:
                    win = window_hashes(h[long], 1)
                    add(row, win[:, 0], np.array(long), win, 1, np.ones(len(long), np.int64))
            if not place:
                continue
            rows, halves = np.concatenate(place), np.concatenate(wins).view(np.int64)
            items = pa.StructArray.from_arrays([pa.array(np.concatenate(starts), pa.int32()), pa.array(np.concatenate(lengths), pa.int32()),
                                                *(pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1))], ["start", "size", "win", "win2"])
            ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(fps).view(np.int64)), column(part, "doc_id").take(pa.array(rows)),
                column(part, "uid").take(pa.array(rows)), pa.ListArray.from_arrays(ends, items)], ["fp", "doc_id", "uid", "wins"])

    return docs.mapInArrow(work, f"fp bigint, doc_id {dict(docs.dtypes)['doc_id']}, uid bigint, wins array<struct<start:int,size:int,win:bigint,win2:bigint>>")


def later_windows(marks: DataFrame) -> DataFrame:
    """``doc_id, uid, later`` (start, size) of the windows that occur earlier too."""
    # tables of their own: the lines are hashed once, and AQE can split the rows of a hot line or window in the joins
    marks = materialize(marks, "marks")
    again = materialize(marks.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("fp"), "marks-again")
    wins = materialize(marks.join(again, "fp").select("doc_id", "uid", F.inline("wins")), "windows")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid", "start")
    first = materialize(wins.groupBy("win", "win2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").select("win", "win2", "first"), "windows-first")
    return wins.join(first, ["win", "win2"]).where(place > F.col("first")).groupBy("doc_id", "uid").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("later"))


def dedup_lines(df: DataFrame, run: int = 2, alone: int = ALONE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the kept text in ``text_col`` and three more columns:
    ``n_lines`` of the input, ``n_removed``, ``n_runs`` (maximal removed runs)."""
    more = ["n_lines", "n_removed", "n_runs"]
    df = df.drop(*more).withColumn(text_col, F.coalesce(text_col, F.lit("")))
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("uid"))
    later = later_windows(fingerprints(docs, run, alone)).select(F.col("doc_id").alias("_ld_id"), F.col("uid").alias("_ld_uid"), F.col("later").alias("_ld_later"))
    joined = df.join(later, df[id_col].eqNullSafe(F.col("_ld_id")) & (F.xxhash64(df[text_col]) == F.col("_ld_uid")), "left").select(df["*"], "_ld_later")
    schema = StructType([*(StructField(f.name, StringType() if f.name == text_col else f.dataType) for f in df.schema.fields), *(StructField(c, LongType(), False) for c in more)])

    def work(batches):
        for part in slices(batches, text_col):
            texts, counts = [], np.zeros((3, part.num_rows), np.int64)
            for row, (text, later) in enumerate(zip(column(part, text_col).to_pylist(), column(part, "_ld_later").to_pylist())):
                counts[0, row] = text.count("\n") + 1
                if later:
                    lines = text.split("\n")
                    keep = solid(lines)
                    gone = np.zeros(len(keep) + 1, bool)
                    for win in later:
                        gone[win["start"]:win["start"] + win["size"]] = True
                    counts[1, row], counts[2, row] = gone.sum(), (gone[1:] < gone[:-1]).sum()
                    out = {keep[k] for k in np.flatnonzero(gone)}
                    text = "\n".join(x for i, x in enumerate(lines) if i not in out)
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if name == text_col else c for name, c in zip(part.schema.names, part.columns) if name != "_ld_later"]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, counts)], schema.names)

    return joined.mapInArrow(work, schema)


def drop_repeated_lines(df: DataFrame, run: int = 2, alone: int = ALONE, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``df`` with kept texts (and their lengths in ``chars_col``, if there),
    without the documents of which nothing but blank lines is left. Columns of
    the input that have the counts' names keep their values."""
    own = {c: f"_own_{c}" for c in ("n_lines", "n_removed", "n_runs") if c in df.columns}
    out = dedup_lines(df.withColumnsRenamed(own), run, alone, id_col, text_col).where((F.col("n_removed") == 0) | F.col(text_col).rlike("[^ \t-\r]"))
    if chars_col in df.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(df.schema[chars_col].dataType))
    return out.drop(*own).withColumnsRenamed({v: k for k, v in own.items()}).select(*df.columns)
