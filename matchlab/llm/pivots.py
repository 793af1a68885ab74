"""Exact top-k search by inner product, with a pivot table.

The vectors' components become integers. The pivot table holds every vector's
distances to a few dozen pivots (far from each other, picked from a bounded
sample of the rows by hash of their id). The triangle inequality makes the
greatest difference of two vectors' distances to one pivot a lower bound of
their own distance, and with it 2 <q, c> = |q|^2 + |c|^2 - d(q, c)^2 has an upper
bound. Queries are compared with candidates block by block: a block as a whole
is passed over if its bound can't reach the query's k-th best so far (the
sample gives the first one); else its candidates are evaluated in order of
their bounds, until no bound reaches the k-th best score. A bound that equals it
is still evaluated, since ties go to the smaller id. Bounds are widened by
more than float arithmetic can be off, scores are exact integers.

A block of candidates holds rows whose nearest pivot is the same, split by
hash of the id into parts of about ``block_rows``; a block of queries holds about
``query_rows``. Each block of queries meets each block of candidates once; a
task gets one pair of blocks after the other, so it holds a few MB whatever
the input. Of a block pair at most k rows a query go on to the last ranking.

Defined results: vectors that are null or hold a null or non-finite component
(also after scaling), and rows with a null id, take no part; a shorter vector
counts as if zeros followed; rows equal in id and vector are one row, and rows
with a query's id are never its candidates (each distinct vector with that id
is a query of its own); scores beyond a long are its greatest or smallest
value; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from matchlab.llm.common import column, materialize

#: Relative error of distances and norms that bounds allow for.
SLACK = 1e-11
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def scaled(df: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id``, ``vec``: floor(scale * component) as doubles, in binary."""
    rows = df.select(df[id_col].alias("vec_id"), df[vec_col].cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")

    def work(batches):
        for batch in batches:
            lists = column(batch, "v")
            offsets = lists.offsets.to_numpy()
            flat = lists.values
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * flat.to_numpy(zero_copy_only=False).astype(np.float64)) + 0.0     # -0.0 is 0
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])       # a null is read as NaN
            good = np.flatnonzero(bad[offsets[1:]] == bad[offsets[:-1]])
            yield pa.RecordBatch.from_arrays(
                [column(batch, "vec_id").take(pa.array(good)), pa.array([x[offsets[i]:offsets[i + 1]].tobytes() for i in good], pa.binary())], ["vec_id", "vec"])

    return rows.mapInArrow(work, f"vec_id {dict(df.dtypes)[id_col]}, vec binary")


def matrix(blobs, width: int = 0) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    sizes = np.array([len(b) // 8 for b in blobs], np.int64)
    width = max([width, *sizes.tolist()])
    if len(sizes) and sizes.min() == width:
        return np.frombuffer(b"".join(blobs)).reshape(len(blobs), width)
    out = np.zeros((len(blobs), width))
    for row, b in zip(out, blobs):
        row[:len(b) // 8] = np.frombuffer(b)
    return out


def alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with the wider one's width."""
    width = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def far_apart(rows: np.ndarray, most: int) -> np.ndarray:
    """Rows picked one after the other, each farthest from those before."""
    picked, nearest = [], np.full(len(rows), np.inf)
    with np.errstate(over="ignore"):
        while len(picked) < min(most, len(rows)) and nearest.max() > 0:
            picked.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, ((rows - rows[picked[-1]]) ** 2).sum(axis=1))
    return rows[picked]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    rows, pivots = alike(rows, pivots)
    with np.errstate(over="ignore"):
        return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def upper(nq, nc, gap, reach):
    """Bound of the inner product from squared norms, a difference of distances and the distances' sum."""
    with np.errstate(over="ignore", invalid="ignore"):
        gap = np.maximum(0.0, gap - SLACK * reach)
        out = (nq + nc - gap * gap) / 2 + SLACK * (nq + nc) + 1.0
    return np.where(np.isnan(out), np.inf, out)


def inner(rows: np.ndarray, q: np.ndarray) -> list[int]:
    """Exact inner products of integer vectors."""
    with np.errstate(over="ignore"):
        plain = (np.abs(rows) @ np.abs(q)).max() < _EXACT if len(rows) else True
    if plain:
        return (rows @ q).astype(np.int64).tolist()
    mine = [int(x) for x in q]
    return [max(-_LONG - 1, min(_LONG, sum(int(a) * b for a, b in zip(r, mine) if a and b))) for r in rows]


class Block:
    """Candidates with their distances to the pivots."""

    def __init__(self, ids, vecs, dists):
        first = list({(i, v): n for n, (i, v) in reversed(list(enumerate(zip(ids, vecs))))}.values())     # equal rows are one
        first.sort(key=lambda n: ids[n])
        self.ids = [ids[n] for n in first]
        self.rows = matrix([vecs[n] for n in first])
        self.dist = matrix([dists[n] for n in first])
        with np.errstate(over="ignore"):
            self.norm = (self.rows ** 2).sum(axis=1)
        self.low, self.high, self.most = self.dist.min(axis=0), self.dist.max(axis=0), self.norm.max()

    def search(self, own, q, dq, k: int, floor: float, step: int = 128) -> tuple[list, int]:
        """The up to ``k`` best (-score, id) of score ``floor`` or more, and how
        many candidates were evaluated."""
        with np.errstate(over="ignore"):
            nq = float((q ** 2).sum())
        gap = np.maximum(dq - self.high, self.low - dq).max(initial=0.0)
        if upper(nq, self.most, gap, (dq + self.high).max(initial=0.0)) < floor:
            return [], 0
        with np.errstate(invalid="ignore"):
            bound = upper(nq, self.norm, np.abs(self.dist - dq).max(axis=1, initial=0.0), (self.dist + dq).max(axis=1, initial=0.0))
        todo = np.flatnonzero(bound >= floor)
        todo = todo[np.argsort(-bound[todo], kind="stable")]
        best, seen = [], 0
        rows, (q,) = self.rows, (q,)
        if rows.shape[1] != len(q):
            rows, q = alike(rows, q[None])
            q = q[0]
        for at in range(0, len(todo), step):
            part = todo[at:at + step]
            if len(best) == k and bound[part[0]] < -best[-1][0]:
                break
            seen += len(part)
            best += [(-s, self.ids[n]) for n, s in zip(part.tolist(), inner(rows[part], q)) if s >= floor and self.ids[n] != own]
            best = sorted(best)[:k]
        return best, seen


def top_k(df: DataFrame, k: int = 5, every: int = 50, scale: int = 256, pivots: int = 32, sample: int = 2048, block_rows: int = 4096,
          query_rows: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (int, from 1), ``vec_id``, ``score`` (long): the ``k``
    candidates with the greatest inner products of every query, the rows whose
    id is divisible by ``every``; ties go to the smaller id. ``sample`` bounds
    the rows by hash that pivots and first thresholds come from (the driver
    and each task hold them); results don't depend on it."""
    spark = df.sparkSession
    kind = dict(df.dtypes)[id_col]
    empty = spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score bigint")
    rows = scaled(df, scale, id_col, vec_col)
    n = rows.count()
    if not n:
        return empty
    by_hash = F.xxhash64("vec_id")
    share = min(1.0, 2.0 * sample / n)
    some = (rows if share == 1 else rows.where(F.pmod(by_hash, F.lit(1 << 40)) < int(share * (1 << 40)))).orderBy(by_hash, "vec_id", "vec").limit(sample).collect()
    seen = matrix([r.vec for r in some])
    chosen = far_apart(seen, pivots) if len(some) else np.zeros((1, 0))
    shared = spark.sparkContext.broadcast((chosen, [(r.vec_id, bytes(r.vec)) for r in some]))

    def measure(batches):
        for batch in batches:
            if batch.num_rows:
                d = distances(matrix(column(batch, "vec").to_pylist()), shared.value[0])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([x.tobytes() for x in d], pa.binary()), pa.array(np.argmin(np.where(np.isnan(d), np.inf, d), axis=1), pa.int32())],
                    ["vec_id", "vec", "dist", "nearest"])

    table = materialize(rows.mapInArrow(measure, f"vec_id {kind}, vec binary, dist binary, nearest int"), "pivot_table")
    counts = {r.nearest: r["count"] for r in table.groupBy("nearest").count().collect()}       # at most one row a pivot
    parts = [math.ceil(counts.get(p, 0) / block_rows) for p in range(len(chosen))]
    first = [sum(parts[:p]) for p in range(len(chosen))]
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("nearest") + 1)
    whole = F.collect_list(F.struct("vec_id", "vec", "dist"))
    blocks = table.groupBy((at(first) + F.pmod(by_hash, at(parts))).cast("int").alias("block")).agg(whole.alias("c"))
    asking = table.where(F.col("vec_id") % every == 0)
    n_queries = asking.count()
    if not n_queries:
        return empty
    queries = asking.groupBy(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(math.ceil(n_queries / query_rows))).alias("part")).agg(whole.alias("q"))

    def thresholds(batches):
        """Of each query the k-th best score in the sample: a bound that no result falls below."""
        known = Block(*zip(*[(i, v, b"") for i, v in shared.value[1]])) if shared.value[1] else None
        for batch in batches:
            for i in range(batch.num_rows):
                floors = []
                for q in column(batch, "q")[i].as_py():
                    best = known.search(q["vec_id"], np.frombuffer(q["vec"]), np.zeros(0), k, -np.inf, 1 << 20)[0] if known else []
                    floors.append(-float(best[-1][0]) if len(best) == k else -np.inf)
                yield pa.RecordBatch.from_arrays([column(batch.slice(i, 1), "q"), pa.array([floors], pa.list_(pa.float64()))], ["q", "floors"])

    held = f"array<struct<vec_id: {kind}, vec: binary, dist: binary>>"
    queries = queries.mapInArrow(thresholds, f"q {held}, floors array<double>")
    pairs = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(sum(parts) - 1)))).join(blocks, "block")

    def search(batches):
        last = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                number = column(batch, "block")[i].as_py()
                if last[0] != number:
                    c = pa.compute.list_flatten(column(batch.slice(i, 1), "c"))
                    last = number, Block(*(c.field(x).to_pylist() for x in range(3)))
                out = []
                done = set()
                for q, floor in zip(column(batch, "q")[i].as_py(), column(batch, "floors")[i].as_py()):
                    key = q["vec_id"], q["vec"]
                    if key not in done:
                        done.add(key)
                        best, _ = last[1].search(q["vec_id"], np.frombuffer(q["vec"]), np.frombuffer(q["dist"]), k, floor)
                        out += [(*key, found, -minus) for minus, found in best]
                if out:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out))), ["query_id", "vec", "vec_id", "score"])

    found = pairs.select("block", "q", "floors", "c").mapInArrow(search, f"query_id {kind}, vec binary, vec_id {kind}, score bigint")
    order = Window.partitionBy("query_id", "vec").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
