"""Near-duplicate documents by MinHash.

A document's set holds its distinct word shingles, as 64-bit hashes. A
signature is the minima of ``BANDS * ROWS`` universal hash functions over
the set; ``ROWS`` minima make a band, and documents that agree in a band
share a bucket. With the defaults a pair at the threshold 0.85 shares no
bucket with probability 6e-11.

Equal sets are one node from the start, so copies cost nothing later. Within
a bucket pairs are never listed as such: each node is held against one pivot
of its buckets (signatures first, then the full sets), links are joined to
components, and only buckets that still hold several components go on, with
another pivot, for a second round. Of what is left, a prefix filter on each
set's rarest shingles finds the pairs that may still be links, and these are
compared in blocks. The filter is exact: no pair that shares a bucket is left
out unless its nodes are linked already. Texts that fill in one template
without being links differ in their rarest shingles and make no pairs. Pairs
are listed only for shingles that at most ``LISTED`` sets have among their
rarest; of others, sets meet blocks of sets, so a large group of near copies
makes a row for each set and block, not for each pair.

Components come from alternating large-star and small-star steps.

Defined results: a null text, an empty one or one without words has an empty
set and is linked with nothing; repeated rows are equal sets; rows with the
same id are one document, linked by what any of its texts links; a null id is
linked with nothing and kept; an empty table gives an empty one; further
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, Window, functions as F

from matchlab.llm.chunks import _Index
from matchlab.llm.common import column, id_text, materialize, slices

BANDS, ROWS = 32, 4
#: A pair is compared by its sets if its signatures agree in this share less than
#: the threshold (8 standard deviations of the estimate).
SLACK = 0.25
STAR_ROUNDS = 2
#: Nodes of a block, for what is left after them, and its shingles.
BLOCK, BLOCK_SHINGLES = 512, 1 << 21
#: Pairs of left-over nodes are listed by a shingle that at most so many of them share.
LISTED = 8
#: Slots that the left-over sets' shingles are counted in (a power of two). The
#: counts only order shingles; any order gives the same links.
RARITY = 1 << 20

_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_SHORT = [np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344)]


class Words:
    """64-bit hashes of words; the cache is emptied when it is full."""

    def __init__(self, limit: int = 500_000):
        self.limit = limit
        self.clear()

    def clear(self):
        self.index, self.hashes = _Index(), np.empty(0, np.uint64)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.index) > self.limit:
            self.clear()
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.new:
            new, self.index.new = self.index.new, []
            self.hashes = np.concatenate([self.hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))])
        return self.hashes[at]


def _mix(a, b, c):
    x = a * _K[0]
    x ^= x >> np.uint64(29)
    x += b
    x *= _K[1]
    x ^= x >> np.uint64(32)
    x += c
    x *= _K[2]
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[str], words: Words, size: int = 3) -> list[np.ndarray]:
    """The sorted set of each text. Words are what lies between ASCII white
    space, with A-Z lower-cased; with fewer than ``size`` words the whole
    sequence is one shingle."""
    split = [t.encode().lower().split() for t in texts]
    flat = words([w for ws in split for w in ws])
    out, at = [], 0
    for ws in split:
        h, at = flat[at:at + len(ws)], at + len(ws)
        if len(h) >= size:
            s = h[:len(h) - size + 1]
            for k in range(1, size, 2):
                s = _mix(s, h[k:len(h) - size + 1 + k], h[k + 1:len(h) - size + 2 + k] if k + 1 < size else np.uint64(size))
            out.append(np.unique(s))
        elif len(h):
            s = np.array([len(h)], np.uint64) ^ _SHORT[1]
            for x in h:
                s = _mix(s, x[None], _SHORT[0])
            out.append(s)
        else:
            out.append(h)
    return out


def functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of ``n`` multiply-add hash functions."""
    r = np.random.RandomState(20240229)
    return (r.randint(0, 1 << 31, n).astype(np.uint32) << np.uint32(1)) | np.uint32(1), r.randint(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)


def minima(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    a, b = functions(bands * rows)
    out = np.full((len(sets), bands * rows), 0xFFFFFFFF, np.uint32)
    for i, s in enumerate(sets):
        x = (s ^ (s >> np.uint64(32))).astype(np.uint32)
        for k in range(0, len(x), 1024):
            np.minimum(out[i], (x[k:k + 1024, None] * a + b).min(axis=0), out=out[i])
    return out


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    s = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), s.shape[:2])
    for k in range(rows):
        h = _mix(h, s[:, :, k], _SHORT[0])
    return h.astype(np.int64)


_WORDS: list[Words] = []


def _words() -> Words:
    if not _WORDS:
        _WORDS.append(Words())
    return _WORDS[0]


def signatures(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, n_shingles, set_hash, bands``; ``docs``: doc_id, text."""

    def run(batches):
        for part in slices(batches, most=1 << 20):
            sets = shingle_sets(column(part, "text").to_pylist(), _words(), size)
            keys = band_keys(minima(sets))
            yield pa.RecordBatch.from_arrays([
                column(part, "doc_id"), pa.array(list(map(len, sets)), pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.ListArray.from_arrays(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32), keys.ravel())],
                ["doc_id", "n_shingles", "set_hash", "bands"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles bigint, set_hash binary, bands array<bigint>")


def full_sets(docs: DataFrame, size: int = 3) -> DataFrame:
    """``node, hashes, minima`` (binary) of each row; ``docs``: node, text."""

    def run(batches):
        for part in slices(batches, most=1 << 20):
            sets = shingle_sets(column(part, "text").to_pylist(), _words(), size)
            yield pa.RecordBatch.from_arrays([column(part, "node"), pa.array([s.tobytes() for s in sets], pa.binary()),
                                              pa.array([m.tobytes() for m in minima(sets)], pa.binary())], ["node", "hashes", "minima"])

    return docs.mapInArrow(run, f"node {dict(docs.dtypes)['node']}, hashes binary, minima binary")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` with ``linked``: 100 * intersection >= percent * union."""
    kind = dict(pairs.dtypes)["a"]
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"), F.col("minima").alias("ma"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"), F.col("minima").alias("mb"))

    def run(batches):
        for whole in batches:
            for batch in (whole.slice(i, 64) for i in range(0, whole.num_rows, 64)):
                linked = []
                for ha, ma, hb, mb in zip(*(column(batch, c).to_pylist() for c in ("ha", "ma", "hb", "mb"))):
                    alike = (np.frombuffer(ma, np.uint32) == np.frombuffer(mb, np.uint32)).mean()
                    ok = alike >= percent / 100 - SLACK
                    if ok:
                        x, y = np.frombuffer(ha, np.uint64), np.frombuffer(hb, np.uint64)
                        both = np.concatenate([x, y])
                        both.sort(kind="stable")
                        same = int((both[1:] == both[:-1]).sum())
                        ok = 100 * same >= percent * (len(both) - same)
                    linked.append(bool(ok))
                yield pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "ma", "hb", "mb").mapInArrow(run, f"a {kind}, b {kind}, linked boolean")


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges`` written, with their number and a sum of their hashes, taken as they are written."""
    seen = Observation()
    out = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "links")
    return out, (seen.get["n"], seen.get["h"])


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``node, comp`` of every node of the links ``a, b``; comp: its component's
    smallest node. ``known``: components (node, comp) of earlier links, to go on from."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if known is not None:
        edges = edges.union(known.select("node", "comp"))
    edges, before = _stored(edges.where("u != v").distinct())
    while before[0]:
        # large star: the larger neighbours of u go to the smallest of its neighbourhood
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges, now = _stored(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).where("u != v").distinct())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(edges.select("v", "v")).distinct()


def _open_buckets(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members, with their component, of buckets that hold more than one."""
    now = members.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    return materialize(now.join(several, "key"), "buckets")


def _star(buckets: DataFrame, order) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, the first by ``order``:
    once for each pair, with the number of buckets that pair shares."""
    pivots = buckets.groupBy("key").agg(F.min(F.struct(order.alias("o"), "node", "n", "comp")).alias("p"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return buckets.join(pivots.select("key", "p"), "key").where("comp != p.comp").groupBy("node", F.col("p.node").alias("pivot")).agg(
        F.count(F.lit(1)).alias("shared"), F.first("n").alias("n"), F.first("p.n").alias("pn"))


def near_duplicates(df: DataFrame, percent: int = 85, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row. Documents with
    100 * intersection >= percent * union are linked; a component is named
    after its smallest id, and that document is kept."""
    docs = id_text(df, id_col=id_col, text_col=text_col)
    sig = materialize(signatures(docs, size), "signatures")
    nodes = materialize(sig.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_hash").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "nodes")
    every = nodes.select("node", "n", F.explode("bands").alias("key"))
    # a table of its own, so that AQE can split a hot bucket's rows in the join
    shared = materialize(every.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"), "shared")
    # a document with one id and several texts has several nodes of that name: one row of each bucket is enough
    members = materialize(every.join(shared, "key").groupBy("key", "node").agg(F.min("n").alias("n")), "members")
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(members.select("node").distinct(), "node", "left_semi")
    sets = materialize(full_sets(texts, size), "sets")

    fits = (100 * F.least("n", "pn") >= percent * F.greatest("n", "pn"))
    pair = [F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")]
    comp, buckets, tested = None, members.withColumn("comp", F.col("node")), None
    for r in range(STAR_ROUNDS):
        star = _star(buckets, F.xxhash64("node", F.lit(r))).where(fits)
        if not r:       # the pivot that a node shares most buckets with
            best = Window.partitionBy("node").orderBy(F.desc("shared"), "pivot")
            star = star.withColumn("k", F.row_number().over(best)).where("k = 1")
        pairs = star.select(*pair).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        done = materialize(verify(pairs, sets, percent), "verified")
        tested = done if tested is None else tested.union(done)
        comp = materialize(components(done.where("linked").select("a", "b"), comp), "components")
        buckets = _open_buckets(members, comp)
        if buckets.isEmpty():
            break
    else:
        comp = materialize(components(materialize(_compare_blocks(buckets, sets, percent), "verified"), comp), "components")
    return _named(sig, nodes, comp)


def intersections(sets: list[np.ndarray], dense: int = 16, step: int = 4096) -> np.ndarray:
    """Sizes of all intersections: a shingle that few sets have adds to its
    pairs, the others go through products of membership matrices."""
    m = len(sets)
    owner = np.repeat(np.arange(m), list(map(len, sets)))
    flat = np.concatenate(sets) if m else np.empty(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, np.int64)
    size = np.diff(np.append(start, len(flat)))
    out = np.zeros((m, m), np.int64)
    for k in range(2, dense + 1):
        own = start[size == k]
        for i in range(k):
            for j in range(k):
                np.add.at(out, (owner[own + i], owner[own + j]), 1)
    many = np.flatnonzero(size > dense)
    for at in range(0, len(many), step):
        own = many[at:at + step]
        member = np.zeros((m, len(own)), np.float32)
        for c, (a, n) in enumerate(zip(start[own], size[own])):
            member[owner[a:a + n], c] = 1
        out += (member @ member.T).astype(np.int64)
    return out


def _rarity(left: DataFrame) -> np.ndarray:
    """Occurrences of the shingles in ``left`` (hashes), added up by their low bits."""

    def count(batches):
        dense = np.zeros(RARITY, np.int64)
        for b in batches:
            for x in column(b, "hashes"):
                dense += np.bincount(np.frombuffer(x.as_py(), np.uint64) & np.uint64(RARITY - 1), minlength=RARITY)
        own = np.flatnonzero(dense)
        yield pa.RecordBatch.from_arrays([pa.array(own % 64, pa.int32()), pa.array(own, pa.int32()), pa.array(dense[own])], ["part", "slot", "n"])

    def pack(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([column(b, c).to_numpy().tobytes()], pa.binary()) for c in ("slot", "n")], ["slots", "counts"])

    sums = left.select("hashes").mapInArrow(count, "part int, slot int, n bigint").groupBy("part", "slot").agg(F.sum("n").alias("n"))
    out = np.zeros(RARITY, np.int64)
    for r in sums.select("slot", "n").mapInArrow(pack, "slots binary, counts binary").toLocalIterator():
        out[np.frombuffer(r.slots, np.int32)] = np.frombuffer(r.counts, np.int64)
    return out


def _prefixes(left: DataFrame, percent: int) -> DataFrame:
    """``key, node, comp, n, rest, first``: each set's rarest shingles. ``rest``: shingles
    from this one on; ``first``: two sets of a link share one that the smaller has as such."""
    held = left.sparkSession.sparkContext.broadcast(_rarity(left))
    kind = dict(left.dtypes)["node"]

    def run(batches):
        counts = held.value
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                keys, rests, firsts, sizes, n = [], [], [], [], []
                for x in column(batch, "hashes"):
                    h = np.frombuffer(x.as_py(), np.uint64)
                    n.append(len(h))
                    size = len(h) - -(-percent * len(h) // 100) + 1
                    at = np.lexsort((h, counts[h & np.uint64(RARITY - 1)]))[:size]
                    keys.append(h[at].view(np.int64))
                    rests.append(len(h) - np.arange(len(at)))
                    firsts.append(rests[-1] * (100 + percent) >= 2 * percent * len(h))
                    sizes.append(len(at))
                take = pa.array(np.repeat(np.arange(len(n)), sizes))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(keys)), column(batch, "node").take(take), column(batch, "comp").take(take), pa.array(np.repeat(n, sizes)),
                    pa.array(np.concatenate(rests)), pa.array(np.concatenate(firsts))], ["key", "node", "comp", "n", "rest", "first"])

    return left.mapInArrow(run, f"key bigint, node {kind}, comp {kind}, n bigint, rest bigint, first boolean")


def _open_prefixes(left: DataFrame, percent: int) -> DataFrame:
    """``_prefixes`` of the shingles that may make a pair, with the number of entries
    of the shingle (``size``) and the smallest node among them (``top``)."""
    entries = materialize(_prefixes(left, percent), "prefixes")
    # a table of its own, so that AQE can split a hot shingle's rows in the join
    open_keys = materialize(entries.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("first").alias("any"), F.count(F.lit(1)).alias("size"), F.min("node").alias("top")).where(
        "lo != hi AND any").select("key", "size", "top"), "prefixes-shared")
    return materialize(entries.join(open_keys, "key"), "prefixes-open")


def _candidates(left: DataFrame, percent: int, entries: DataFrame | None = None) -> DataFrame:
    """Pairs ``a, b`` of different components that may be links: a prefix filter.
    ``entries``: those of ``_open_prefixes(left, percent)`` to pair (none given: all).

    In any one order of the shingles, here from rare to frequent, let w be the
    first that two sets share. From w on the smaller and the larger have at
    least their intersection, which in a link is percent / (100 + percent) of
    both sizes together. So w lies in the smaller one's ``first`` shingles and
    in the larger one's prefix, and a shingle met too late in both to leave an
    intersection makes no pair: those of a template that many sets have in
    common come after what a set has for itself."""
    entries = _open_prefixes(left, percent) if entries is None else entries
    x, y = entries.where("first").alias("x"), entries.alias("y")
    return x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp"))
                  & (F.struct("x.n", "x.node") < F.struct("y.n", "y.node")) & F.expr(f"100 * x.n >= {percent} * y.n")
                  & F.expr(f"{100 + percent} * least(x.rest, y.rest) >= {percent} * (x.n + y.n)")).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _blocks_met(entries: DataFrame, dealt: DataFrame, percent: int) -> DataFrame:
    """``cluster, lo, hi, node, own``: each node with the blocks that may hold a
    link to it. What ``_candidates`` asks of two entries of a shingle is asked
    of an entry and the bounds of a block's entries, which any of these meets
    that makes a pair: a row for each entry and block, not for each pair."""
    entries = materialize(entries.join(dealt, "node"), "prefixes-dealt")
    sides = materialize(entries.groupBy("key", "own").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.max("rest").alias("rest"), F.max("first").alias("first")).withColumnRenamed("own", "other"), "prefixes-sides")
    x, y = entries.alias("x"), sides.alias("y")
    return x.join(y, (F.col("x.key") == F.col("y.key")) & F.expr("(x.comp != y.lo OR x.comp != y.hi) AND (x.first OR y.first)")
                  & F.expr(f"100 * y.most >= {percent} * x.n AND 100 * x.n >= {percent} * y.least")
                  & F.expr(f"{100 + percent} * least(x.rest, y.rest) >= {percent} * (x.n + y.least)")).select(
        "cluster", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "own").distinct()


def _compare_blocks(buckets: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` between components that share an open bucket. Nodes that
    candidate pairs, or shingles of too many sets to list their pairs, connect
    are a cluster; its nodes are dealt into blocks of about ``block`` nodes and
    at most about ``BLOCK_SHINGLES``, and a task compares two blocks that may
    have a link, of each the nodes that may be in one. Of the links between two
    components a task reports one."""
    kind = dict(sets.dtypes)["node"]
    left = materialize(buckets.select("node", "comp").distinct().join(sets.select("node", "hashes"), "node"), "left-over")
    entries = _open_prefixes(left, percent)
    few, many = entries.where(F.col("size") <= LISTED), entries.where(F.col("size") > LISTED)
    pairs = materialize(_candidates(left, percent, few), "candidates")
    clusters = materialize(components(pairs.union(many.select("node", "top"))), "clusters").withColumnRenamed("comp", "cluster")
    sized = clusters.join(left.groupBy("node").agg(F.sum(F.octet_length("hashes") / 8).alias("n")), "node")
    sizes = sized.groupBy("cluster").agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = materialize(clusters.join(sizes, "cluster").select("node", "cluster", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")), "dealt")
    met = pairs.join(dealt.select(F.col("node").alias("a"), "cluster", F.col("own").alias("i")), "a").join(
        dealt.select(F.col("node").alias("b"), F.col("own").alias("j")), "b")
    met = met.select("cluster", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"),
                     F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("i").alias("own")), F.struct(F.col("b").alias("node"), F.col("j").alias("own")))))
    met = met.union(_blocks_met(many, dealt, percent)).distinct()
    rows = met.join(left, "node")

    def work(t: pa.Table) -> pa.Table:
        held = [np.frombuffer(x.as_py(), np.uint64) for x in t["hashes"]]
        n = np.array(list(map(len, held)))
        same = intersections(held)
        comp, own = t["comp"].to_numpy(), t["own"].to_numpy()
        ok = (100 * same >= percent * (n[:, None] + n[None, :] - same)) & (comp[:, None] < comp[None, :])
        if t["lo"][0].as_py() != t["hi"][0].as_py():
            ok &= own[:, None] != own[None, :]
        a, b = np.nonzero(ok)
        _, one = np.unique(np.stack([comp[a], comp[b]], axis=1), axis=0, return_index=True)
        return pa.Table.from_arrays([t["node"].take(pa.array(a[one])), t["node"].take(pa.array(b[one]))], ["a", "b"])

    return rows.groupBy("cluster", "lo", "hi").applyInArrow(work, f"a {kind}, b {kind}")


def _named(sig: DataFrame, nodes: DataFrame, comp: DataFrame) -> DataFrame:
    names = nodes.join(comp, "node", "left").select("set_hash", F.coalesce("comp", "node").alias("component_id"))
    return sig.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_hash")).alias("set_hash")).join(names, "set_hash", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(df: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the documents that aren't kept."""
    gone = near_duplicates(df, percent, size, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias(id_col)).distinct()
    return df.join(gone, id_col, "left_anti").select(*df.columns)
