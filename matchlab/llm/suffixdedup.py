"""Removal of repeated byte strings with suffix arrays.

Every byte that lies in a string of ``length`` bytes which begins anywhere
else too, in this document or another, is removed. A suffix array of the
whole corpus would be sorted by one machine; here Spark first brings the
places that can match together:

1. In every window of k-grams that fits into ``length`` bytes the smallest
   hashes are selected. Equal strings of ``length`` bytes select the same
   k-grams, anchors, so an anchor that occurs once takes part in no repeat,
   and drops out after a count.
2. An anchor's context is what lies in reach of a string around it. Contexts
   that occur twice as a whole are covered as a whole; so copies, whatever
   their number, are settled by a grouped count.
3. The strings around an anchor, by where they begin, are dealt into
   ``PARTS`` groups; those of a group have a core of bytes in common. Only
   contexts that share a core with another context of their anchor can hold a
   repeat, and only in that core's strings; one place of each is taken. The
   anchor's hash is the shard; in a shard the places of one
   document are joined to pieces, so no place is in it twice. The suffixes of
   a shard are sorted externally (see ``induced``), and neighbours with
   ``length`` bytes in common are repeats.
4. An anchor with more than ``HOT`` such contexts (a phrase of many
   documents) goes to no shard. The strings of ``length`` bytes around it are
   counted by their 128-bit hashes, after those that share no longer part
   with another context have dropped out by a count of such parts.

Spans from 2 to 4 are united by document and cut out. Matches are judged on
the input.

Defined results: a null text is an empty one; texts shorter than ``length``
stay whole; a repeated row is a copy like any other, so nothing is left of
either; a null id works like any id; an empty table gives an empty one;
further columns travel along unread. Kept bytes
that aren't UTF-8 (a cut through a character) are hashed as they are; as a
text, what is left of a cut character is left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from matchlab.llm.common import column, materialize, partitions_for, slices
from matchlab.llm.induced import repeats
from matchlab.session import discard

GRAM = 40
SHARD_MB = 4
#: Groups of the strings around a place.
PARTS = 4
#: Contexts of an anchor that one shard takes; strings whose common part is counted at first.
HOT, WIDTH = 2048, 20

_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all k-grams, by doubling."""
    base = np.uint64(0x9E3779B97F4A7C15)
    power, size, h = base, 1, data.astype(np.uint64) + np.uint64(1)
    out, done = None, 0
    while True:
        if k & size:
            if out is None:
                out, done = h, size
            else:       # the k-gram is the part so far and the next ``size`` bytes
                n = len(data) - done - size + 1
                out, done = out[:n] * power + h[done:done + n], done + size
        if done == k:
            break
        n = len(h) - size
        h = h[:n] * power + h[size:]
        power, size = power * power, 2 * size
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0xC2B2AE3D27D4EB4F)
    return out ^ (out >> np.uint64(29))


def anchors(data: bytes, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the selected k-grams."""
    at, h = selected(data, length, k)
    return at, h[at]


def selected(data: bytes, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the selected k-grams, and the hashes of all."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        h = gram_hashes(np.frombuffer(data, np.uint8), k)
    w = length - k + 1
    low = _sliding(h, w, np.minimum)            # smallest hash of each window
    # a place is selected if its hash is the smallest of a window around it,
    # that is, the largest among the windows' smallest
    edge = np.zeros(w - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), w, np.maximum) == h), h


def part_bounds(length: int, k: int) -> list[int]:
    """Strings of part j begin [j] to [j + 1] bytes before a place."""
    return [(length - k) * j // PARTS for j in range(PARTS + 1)]


def core_hashes(at: np.ndarray, h: np.ndarray, length: int, k: int) -> np.ndarray:
    """64 / ``PARTS`` bits for each part of the contexts of the places ``at`` (0: it has
    no string within the text): a hash of what the part's strings have in common;
    ``h``: the hashes of all k-grams."""
    bounds, wide = part_bounds(length, k), 64 // PARTS
    first, last = -np.array(bounds[:-1]), length - k - np.array(bounds[1:])
    steps = np.arange(-(-int((last - first).max()) // k) + 1)
    cover = np.minimum(first[:, None] + k * steps, last[:, None])       # k-grams that cover the core
    x = h[np.clip(at[:, None, None] + cover, 0, len(h) - 1)] * (_FACTORS[0] * (2 * steps.astype(np.uint64) + np.uint64(1)))
    x = x.sum(axis=2, dtype=np.uint64) * _FACTORS[1]
    x = (x >> np.uint64(32)) % np.uint64((1 << wide) - 1) + np.uint64(1)
    x[(at[:, None] + first < 0) | (at[:, None] + last >= len(h))] = 0
    return (x << (np.uint64(wide) * np.arange(PARTS, dtype=np.uint64))).sum(axis=1, dtype=np.uint64).view(np.int64)


def _sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` over each window of ``w``, by doubling."""
    size, out = 1, x
    while 2 * size <= w:
        out = pick(out[:len(out) - size], out[size:])
        size *= 2
    n = len(x) - w + 1
    return pick(out[:n], out[w - size:w - size + n])


def find_anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """``row, doc_id, uid, fps, ctxs, cores, places`` of each text with anchors; row: a
    number of its own, ctxs, cores: hashes of the contexts and of their parts' cores. To be
    written before use."""

    def work(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33
        for part in slices(batches):
            rows, fps, ctxs, cores, places, sizes = [], [], [], [], [], []
            for row, text in enumerate(column(part, "text").to_pylist()):
                data = text.encode()
                at, h = selected(data, length, k)
                if not len(at):
                    continue
                rows.append(row)
                fps.append(h[at])
                cores.append(core_hashes(at, h, length, k))
                places.append(at)
                sizes.append(len(at))
                reach = length - k
                ctxs += [xxhash.xxh3_64_intdigest(data[max(p - reach, 0):p + length], seed=min(p, reach)) for p in at.tolist()]
            if rows:
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                take = pa.array(rows, pa.int64())
                number += len(rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(number - len(rows), number)), column(part, "doc_id").take(take), column(part, "uid").take(take),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(fps).view(np.int64))),
                    pa.ListArray.from_arrays(ends, pa.array(np.array(ctxs, np.uint64).view(np.int64))),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(cores))),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(places), pa.int32()))], ["row", "doc_id", "uid", "fps", "ctxs", "cores", "places"])

    return docs.mapInArrow(work, f"row bigint, doc_id {dict(docs.dtypes)['doc_id']}, uid bigint, fps array<bigint>, ctxs array<bigint>, cores array<bigint>, places array<int>")


def cut_pieces(wanted: DataFrame, length: int, k: int) -> DataFrame:
    """``shard, row, start, piece``: the joined strings of each shard; ``wanted``: row and
    text with spots (shard, place, lo, hi): strings that begin ``lo`` to ``hi`` bytes before a place."""

    def work(batches):
        for part in slices(batches):
            out = []
            for at, (text, spots) in enumerate(zip(column(part, "text").to_pylist(), column(part, "spots").to_pylist())):
                data, by = text.encode(), {}
                for s in spots:
                    by.setdefault(s["shard"], []).append((max(s["place"] - s["hi"], 0), min(s["place"] - s["lo"] + length, len(data))))
                for shard, spans in by.items():
                    spans.sort()
                    start, end = spans[0]
                    for a, b in spans:
                        if a > end:
                            out.append((at, shard, start, data[start:end]))
                            start = a
                        end = max(end, b)
                    out.append((at, shard, start, data[start:end]))
            if out:
                rows, shards, starts, pieces = zip(*out)
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), column(part, "row").take(take),
                                                  pa.array(starts, pa.int64()), pa.array(pieces, pa.binary())], ["shard", "row", "start", "piece"])

    return wanted.mapInArrow(work, "shard int, row bigint, start bigint, piece binary")


def shard_repeats(pieces: DataFrame, length: int) -> DataFrame:
    """``row, a, b``: the repeated spans that the suffixes of each shard
    show; ``pieces``: all of a shard in one partition, shard by shard."""
    def work(batches):
        held, now = [], None
        for batch in batches:
            shards = column(batch, "shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    if held and shards[a] != now:
                        yield from settle(held)
                        held = []
                    now = shards[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield from settle(held)

    def settle(held):
        t = pa.Table.from_batches(held)
        spans = repeats(t["piece"].to_pylist(), length)
        n = [len(s) for s in spans]
        if sum(n):
            take = pa.array(np.repeat(np.arange(len(n)), n))
            both = np.concatenate(spans) + np.repeat(t["start"].to_numpy(), n)[:, None]
            yield from pa.Table.from_arrays([t["row"].take(take), pa.array(both[:, 0]), pa.array(both[:, 1])], ["row", "a", "b"]).combine_chunks().to_batches()

    return pieces.mapInArrow(work, "row bigint, a bigint, b bigint")


def common_parts(wanted: DataFrame, length: int, k: int, width: int) -> DataFrame:
    """``h1, h2, row, place, lo, hi``: hashes of what the strings have in common
    that begin ``lo`` to ``hi`` bytes before a place, ``width`` strings at a time;
    ``wanted``: row and text with spots (place, lo, hi)."""

    def work(batches):
        for part in slices(batches):
            for one in (part.slice(i, 256) for i in range(0, part.num_rows, 256)):
                rows, digests = [], []
                for at, (text, spots) in enumerate(zip(column(one, "text").to_pylist(), column(one, "spots").to_pylist())):
                    data = text.encode()
                    for s in spots:
                        p = s["place"]
                        for lo in range(s["lo"], s["hi"] + 1, width):
                            hi = min(lo + width - 1, s["hi"])
                            if max(lo, p + length - len(data)) <= min(hi, p):       # a string within the text
                                rows.append((at, p, lo, hi))
                                digests.append(xxhash.xxh3_128_digest(data[p - lo:p + length - hi]))
                if rows:
                    h, r = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2), np.array(rows, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), column(one, "row").take(pa.array(r[:, 0])),
                                                      *(pa.array(r[:, c], pa.int32()) for c in (1, 2, 3))], ["h1", "h2", "row", "place", "lo", "hi"])

    return wanted.mapInArrow(work, "h1 bigint, h2 bigint, row bigint, place int, lo int, hi int")


def counted_repeats(spots: DataFrame, texts_of, length: int, k: int) -> DataFrame:
    """``row, a, b``: the repeated strings that begin ``lo`` to ``hi`` bytes before
    places (``row, place, lo, hi``), by counts only."""
    now = spots.groupBy("row", "place").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    for width in (WIDTH, 1):
        wanted = texts_of(now.groupBy("row").agg(F.collect_list(F.struct("place", "lo", "hi")).alias("spots")))
        found = materialize(common_parts(wanted, length, k, width), "parts")
        begin = F.struct("row", F.col("place") - F.col("lo"))       # two anchors may show the same string
        again = materialize(found.groupBy("h1", "h2").agg(F.min(begin).alias("x"), F.max(begin).alias("y")).where("x != y").select("h1", "h2"), "parts-again")
        now = found.join(again, ["h1", "h2"])
    start = (F.col("place") - F.col("lo")).cast("bigint")
    return now.select("row", start.alias("a"), (start + length).alias("b")).distinct()


def repeated_spans(docs: DataFrame, length: int = 200, k: int = GRAM) -> DataFrame:
    """``doc_id, uid, spans`` (from, to; they may overlap) of the documents with repeats; ``docs``: doc_id, uid, text."""
    docs = docs.where(F.octet_length("text") >= length)
    found = materialize(find_anchors(docs, length, k), "anchors")
    # a table of its own, so that AQE can split a hot anchor's rows in the join
    again = materialize(found.select(F.explode("fps").alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("fp"), "anchors-again")
    every = found.select("row", F.inline(F.arrays_zip("fps", "ctxs", "cores", "places"))).toDF("row", "fp", "ctx", "cores", "place")
    hits = materialize(every.join(again, "fp"), "anchors-met")
    names = materialize(found.select("row", "doc_id", "uid"), "anchored")
    discard(found)
    kinds = materialize(hits.groupBy("fp", "ctx").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("row", "place", "cores")).alias("rep")), "contexts")
    # contexts that occur twice as a whole
    whole = hits.join(kinds.where("c > 1").select("fp", "ctx"), ["fp", "ctx"]).groupBy("row").agg(F.collect_list("place").alias("places"))
    whole = materialize(whole, "contexts-again")
    discard(hits)
    # one place of each context that shares a core with another one of its anchor, and the strings of such parts
    wide, bounds = 64 // PARTS, F.array(*map(F.lit, part_bounds(length, k)))
    cores = F.array(*[F.shiftrightunsigned("rep.cores", wide * j).bitwiseAND((1 << wide) - 1) for j in range(PARTS)])
    parts = kinds.select("fp", "rep.row", "rep.place", F.posexplode(cores).alias("part", "core")).where("core != 0")
    shared = materialize(parts.groupBy("fp", "part", "core").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("fp", "part", "core"), "cores-again")
    several = parts.join(shared, ["fp", "part", "core"]).groupBy("fp", "row", "place").agg(
        F.get(bounds, F.min("part")).alias("lo"), F.get(bounds, F.max("part") + 1).alias("hi"))
    several = materialize(several, "contexts-several")
    counts = materialize(several.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds")), "anchors-several")
    shards = partitions_for(docs, SHARD_MB)

    def texts_of(spots: DataFrame) -> DataFrame:
        a, b = docs.alias("a"), spots.join(names, "row").alias("b")
        return a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.uid") == F.col("b.uid"))).select("b.row", "a.text", "b.spots")

    spots = several.join(counts.where(f"kinds <= {HOT}").select("fp"), "fp").select(
        "row", F.struct(F.pmod(F.hash("fp"), F.lit(shards)).alias("shard"), "place", "lo", "hi").alias("spot"))
    wanted = texts_of(spots.groupBy("row").agg(F.collect_list("spot").alias("spots")))
    pieces = materialize(cut_pieces(wanted, length, k), "pieces").repartition(shards, "shard").sortWithinPartitions("shard")
    partial = shard_repeats(pieces, length)
    hot = counts.where(f"kinds > {HOT}").select("fp")
    if not hot.isEmpty():
        partial = partial.union(counted_repeats(several.join(hot, "fp"), texts_of, length, k))
    partial = partial.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    return materialize(whole.join(partial, "row", "full").join(names, "row").dropDuplicates(["doc_id", "uid"]).select("doc_id", "uid", "places", "spans"), "spans")


def union_spans(places, spans, size: int, length: int, k: int) -> np.ndarray:
    """Disjoint spans, rows [from, to), of whole contexts (if a string fits in) and spans."""
    both = np.empty((0, 2), np.int64)
    if places:
        p = np.array(places, np.int64)
        w = np.stack([np.maximum(p - (length - k), 0), np.minimum(p + length, size)], axis=1)
        both = w[w[:, 1] - w[:, 0] >= length]
    if spans:
        both = np.concatenate([both, np.array([(s["a"], s["b"]) for s in spans], np.int64)])
    if not len(both):
        return both
    both = both[np.argsort(both[:, 0], kind="stable")]
    reach = np.maximum.accumulate(both[:, 1])
    cut = np.flatnonzero(both[1:, 0] > reach[:-1]) + 1
    return np.stack([both[np.concatenate([[0], cut]), 0], reach[np.append(cut - 1, len(both) - 1)]], axis=1)


def remove_repeats(df: DataFrame, length: int = 200, k: int = GRAM, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """``df`` with four more columns: ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs) and ``kept`` (the remaining bytes, or with
    ``as_text`` the remaining whole characters)."""
    more = ["n_bytes", "n_removed", "n_spans"]
    df = df.drop(*more, "kept")
    text = F.coalesce(df[text_col], F.lit(""))
    spans = repeated_spans(df.select(df[id_col].alias("doc_id"), F.xxhash64(text).alias("uid"), text.alias("text")), length, k)
    spans = spans.select(F.col("doc_id").alias("_sd_id"), F.col("uid").alias("_sd_uid"), F.col("places").alias("_sd_places"), F.col("spans").alias("_sd_spans"))
    joined = df.join(spans, df[id_col].eqNullSafe(F.col("_sd_id")) & (F.xxhash64(text) == F.col("_sd_uid")), "left").select(df["*"], "_sd_places", "_sd_spans")
    schema = StructType([*df.schema.fields, *(StructField(c, LongType(), False) for c in more), StructField("kept", StringType() if as_text else BinaryType(), False)])

    def work(batches):
        for part in slices(batches, text_col):
            kept, counts = [], np.zeros((3, part.num_rows), np.int64)
            for row, (text, places, spans) in enumerate(zip(*(column(part, c).to_pylist() for c in (text_col, "_sd_places", "_sd_spans")))):
                data = (text or "").encode()
                gone = union_spans(places, spans, len(data), length, k)
                counts[:, row] = len(data), (gone[:, 1] - gone[:, 0]).sum(), len(gone)
                edges = [0, *gone.ravel().tolist(), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            columns = [c for name, c in zip(part.schema.names, part.columns) if name not in ("_sd_places", "_sd_spans")]
            last = pa.array([x.decode(errors="ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, counts), last], schema.names)

    return joined.mapInArrow(work, schema)


def dedup_digests(df: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    out = remove_repeats(df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")), length)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def drop_repeats(df: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``df`` with what is left of its texts (and their lengths in
    ``chars_col``, if there), without the documents of which nothing is left.
    Columns of the input that have the counts' names keep their values."""
    own = {c: f"_own_{c}" for c in ("n_bytes", "n_removed", "n_spans", "kept") if c in df.columns}
    out = remove_repeats(df.withColumnsRenamed(own), length, GRAM, id_col, text_col, as_text=True).where((F.col("n_removed") == 0) | (F.col("kept") != ""))
    out = out.withColumn(text_col, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(text_col)))
    if chars_col in df.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(df.schema[chars_col].dataType))
    return out.drop(*own).withColumnsRenamed({v: k for k, v in own.items()}).select(*df.columns)
