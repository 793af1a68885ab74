"""Language-model scores from a probabilistic suffix tree.

A token's symbol is one of 256: 0 is a document's end, 1-127 are the most
frequent words of the training texts, 128-255 the other words by their last
two characters. The tree's states are contexts of up to ``DEPTH`` symbols. A
context is retained if what follows it diverges from what follows its suffix
(one symbol shorter): the divergence times the context's count has to exceed
half the number of parameters (different next symbols less one) times the
logarithm of the number of training tokens; with a retained context all its
suffixes are. On top of it stand contexts of whole words, of one word and then longer
ones up to ``WORD_DEPTH``: every context that training texts hold twice or more is
tested in the same way against its longest retained suffix (if none is, the symbols' tree). A state's next-symbol distribution is smoothed towards its
suffix's, the root's towards the uniform one. Every token is scored by its
longest suffix state; a symbol that stands for many words also by the word's
smoothed share among them, where all words never met are one more word. A
retained word context with C tokens after it, k of them different, makes of the
probability p by its suffix (c + k * p) / (C + k), where c is the token's count after it.

Every word of the training texts is counted, and counts never meet in one
place. The documents are dealt into groups by id; a group's distinct words
go, as sorted arrays of 64-bit hashes, to buckets by hash; a bucket adds up
its words' counts over all groups and answers each group with the counts it
needs. So a task holds its own documents' words, not the corpus's. Words after
their contexts are counted the same way, a level after the other: all words after a
context meet in one bucket, which tests it. Texts are split once; a group keeps its tokens as places in
the list of its words. Symbol
n-grams are counted by tasks and added up in Spark; the tree has at most
256^DEPTH + 256 + 1 states of 256 numbers, which bounds what is broadcast
(``TREE_MB``).

Defined results: a null text is an empty one, whose only token is the end;
without any training text every count is 0 and the tree is uniform; repeated
rows count and are scored repeatedly; a null id is never held out; an empty
table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from matchlab import session
from matchlab.llm.align import squeeze
from matchlab.llm.common import column, held_out, id_text, materialize, partitions_for, sweep
from matchlab.llm.letters import Sums, codes
from matchlab.llm.minhash import Words, _mix

SYMBOLS = 256
FREQUENT = 127
DEPTH = 2
TREE_MB = 80
UNIT = 1024             # parts of a natural logarithm that are added up as integers, so that sums don't depend on their order
WORD_DEPTH = 3
SMOOTH = 256.0
_PARTS = 16
_END = np.uint64(0x452821E638D01377)    # the end token's hash


class Tokens:
    """The tokens of some documents, one document after the other."""

    def __init__(self, texts: list[str], words: Words):
        split = [t.encode().lower().split() for t in texts]
        counts = np.array([len(x) for x in split], np.int64)
        ends = np.cumsum(counts + 1)                    # each document's end included
        self.starts = ends - counts - 1
        self.sizes = counts + 1
        real = np.ones(int(ends[-1]) if len(ends) else 0, bool)
        real[ends - 1] = False
        self.hashes = np.full(len(real), _END, np.uint64)
        flat = [w for x in split for w in x]
        step = 1 << 19
        self.hashes[real] = np.concatenate([words(flat[i:i + step]) for i in range(0, len(flat), step)] or [np.empty(0, np.uint64)])
        # a word's last two characters
        text = codes(b" ".join(flat).decode() + " ")
        stop = np.flatnonzero(text == 32) if flat else np.empty(0, np.int64)
        last, before = text[stop - 1], text[np.maximum(stop - 2, 0)]
        before = np.where(np.diff(stop, prepend=-1) > 2, before, 0)
        h = last * np.uint32(0x9E3779B1) + before * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0xC2B2AE35)
        self.endings = np.zeros(len(real), np.uint8)
        self.endings[real] = 128 + (h >> np.uint32(25))

    def symbols(self, frequent: np.ndarray) -> np.ndarray:
        """``frequent``: sorted hashes; the symbol of each is its place plus one."""
        if not len(frequent):
            return self.endings.astype(np.int64)
        at = np.minimum(np.searchsorted(frequent, self.hashes), len(frequent) - 1)
        return np.where(frequent[at] == self.hashes, at + 1, self.endings).astype(np.int64)

    def contexts(self, symbols: np.ndarray) -> np.ndarray:
        return contexts(symbols, self.sizes)


def places(sizes: np.ndarray) -> np.ndarray:
    """Each token's place in its document."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def contexts(symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The DEPTH symbols before each token as one number; before a document's first stand ends."""
    at = places(sizes)
    out = np.zeros(len(symbols), np.int64)
    for d in range(DEPTH, 0, -1):
        before = np.concatenate([np.zeros(min(d, len(symbols)), np.int64), symbols[:-d]])
        out = out * SYMBOLS + np.where(at >= d, before, 0)
    return out


_WORDS: list[Words] = []


def tokens_of(texts) -> Tokens:
    if not _WORDS:
        _WORDS.append(Words(300_000))
    return Tokens(texts, _WORDS[0])


def homes(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the sorted words by bucket, and where each bucket begins in it."""
    home = (words % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    return order, np.searchsorted(home[order], np.arange(buckets + 1))


def pack(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, kind, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def expand(data: bytes, kind, n: int) -> np.ndarray:
    """The inverse of ``squeeze`` for numbers of four bytes."""
    return np.ascontiguousarray(unpack(data, np.uint8, 4 * n).reshape(4, n).T).view(kind).ravel()


def split(docs: DataFrame) -> DataFrame:
    """A row for each group: its documents, its sorted distinct words' hashes and
    endings, and its tokens as places among these."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(group: pa.Table) -> pa.Table:
        t = tokens_of(group["text"].to_pylist())
        words, first, at = np.unique(t.hashes, return_index=True, return_inverse=True)
        return pa.table({"gid": [group["gid"][0].as_py()], "doc_id": pa.array([group["doc_id"].to_pylist()], pa.list_(group["doc_id"].type)),
                         "held_out": [group["held_out"].to_pylist()], "sizes": [t.sizes.tolist()], "words": [words.tobytes()],
                         "endings": [t.endings[first].tobytes()], "tokens": [squeeze(at)]})

    return docs.groupBy("gid").applyInArrow(work, f"gid bigint, doc_id array<{kind}>, held_out array<boolean>, sizes array<bigint>, words binary, endings binary, tokens binary")


class Group:
    """A row of ``split``."""

    def __init__(self, row: dict):
        self.gid, self.sizes = row["gid"], np.array(row["sizes"], np.int64)
        self.held = np.array(row["held_out"], bool)
        self.train = np.repeat(~self.held, self.sizes)
        self.words, self.endings = np.frombuffer(row["words"], np.uint64), np.frombuffer(row.get("endings", b""), np.uint8)
        self.tokens = expand(row["tokens"], np.int32, int(self.sizes.sum()))

    def symbols(self, frequent: np.ndarray) -> np.ndarray:
        out = self.endings.astype(np.int64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, self.words), len(frequent) - 1)
            out = np.where(frequent[at] == self.words, at + 1, out)
        return out[self.tokens]


def gather(groups: DataFrame, buckets: int) -> DataFrame:
    """For each group and bucket the group's distinct words, their training counts and endings."""

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                g = Group(row)
                counts = np.bincount(g.tokens[g.train], minlength=len(g.words)).astype(np.int32)
                order, cuts = homes(g.words, buckets)
                mine = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                rows = [(b, g.gid, g.words[m].tobytes(), counts[m].tobytes(), g.endings[m].tobytes()) for b, m in enumerate(mine) if len(m)]
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "gid", "words", "counts", "endings"])

    return groups.mapInArrow(work, "bucket int, gid bigint, words binary, counts binary, endings binary")


def answer(words: DataFrame) -> DataFrame:
    """For each bucket and group the words' counts in the whole corpus; with
    gid -1 the bucket's known words by ending, its tokens, and its most
    frequent words."""

    def work(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_py(), np.uint64) for x in group["words"]]
        counts = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in group["counts"]])
        endings = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in group["endings"]])
        distinct, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        sums = np.bincount(at, counts, len(distinct)).astype(np.int64)
        stops = np.cumsum([len(k) for k in keys])
        b = group["bucket"][0].as_py()
        out = [(b, g, sums[at[e - len(k):e]].tobytes(), None, None, None) for g, k, e in zip(group["gid"].to_pylist(), keys, stops)]
        own = endings[first]
        known = np.bincount(own[sums > 0], minlength=SYMBOLS)
        top = np.lexsort((distinct, -sums))
        top = top[(sums[top] > 0) & (distinct[top] != _END)][:FREQUENT]
        tops = [{"word": int(w), "count": int(c), "ending": int(x)} for w, c, x in zip(distinct[top].view(np.int64), sums[top], own[top])]
        out.append((b, -1, None, known.tolist(), int(sums.sum()), tops))
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.struct([("word", pa.int64()), ("count", pa.int64()), ("ending", pa.int32())]))]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["bucket", "gid", "counts", "known", "tokens", "top"])

    return words.groupBy("bucket").applyInArrow(work, "bucket int, gid bigint, counts binary, known array<bigint>, tokens bigint, top array<struct<word:bigint,count:bigint,ending:int>>")


def count_symbols(groups: DataFrame, frequent: np.ndarray) -> Sums:
    """Counts of all contexts with their next symbol, as context * 256 + symbol."""

    def count(batches):
        dense = np.zeros(SYMBOLS ** (DEPTH + 1), np.int32)
        for b in batches:
            for row in b.to_pylist():
                g = Group(row)
                s = g.symbols(frequent)
                x, n = np.unique((contexts(s, g.sizes) * SYMBOLS + s)[g.train], return_counts=True)
                dense[x] += n.astype(np.int32)
        found = np.flatnonzero(dense).astype(np.uint32)
        for k in range(_PARTS):
            own = found[found % _PARTS == k]
            if len(own):
                yield batch(k, own, dense[own].astype(np.int64))

    def add(batches):
        sums: dict[int, Sums] = {}
        for b in batches:
            for part, x, n in zip(*(c.to_pylist() for c in b.columns)):
                sums.setdefault(part, Sums()).add(np.frombuffer(x, np.uint32), np.frombuffer(n, np.int64))
        for part, s in sums.items():
            yield batch(part, s.codes, s.counts)

    def batch(part, x, n):
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "codes": [x.tobytes()], "counts": [n.tobytes()]})

    schema = "part int, codes binary, counts binary"
    found = [(np.frombuffer(r["codes"], np.uint32), np.frombuffer(r["counts"], np.int64))
             for r in groups.mapInArrow(count, schema).repartition(_PARTS, "part").mapInArrow(add, schema).toLocalIterator()]
    out = Sums()
    if found:
        out.codes, out.counts = (np.concatenate(x) for x in zip(*found))
    return out


def grow(found: Sums) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tree: for each context the number of its longest state, each state's
    log10 next-symbol distribution, and the counts of the symbols."""
    dense = np.zeros((SYMBOLS ** DEPTH, SYMBOLS), np.float32)
    dense.ravel()[found.codes] = found.counts
    levels = {DEPTH: dense}
    for d in range(DEPTH - 1, -1, -1):          # without the oldest symbol
        levels[d] = levels[d + 1].reshape(SYMBOLS, SYMBOLS ** d, SYMBOLS).sum(axis=0, dtype=np.float64)
    root, n = levels[0][0], levels[0].sum()
    bar = np.log(max(n, 2)) / 2
    smooth = ((root + SMOOTH / SYMBOLS) / (n + SMOOTH))[None]
    keep, states = {}, [smooth]
    kept_rows: dict[int, np.ndarray] = {}
    for d in range(1, DEPTH + 1):
        block = SYMBOLS ** (d - 1)              # contexts with the same oldest symbol; their suffixes are all contexts one shorter
        keep[d] = np.zeros(SYMBOLS ** d, bool)
        nexts = []
        for a in range(SYMBOLS):
            c = levels[d][a * block:(a + 1) * block].astype(np.float64)
            sums = c.sum(axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(c > 0, c * (np.log(c / sums) - np.log(smooth)), 0).sum(axis=1)
            keep[d][a * block:(a + 1) * block] = gain > np.maximum((c > 0).sum(axis=1) - 1, 1) * bar
            if d < DEPTH:
                nexts.append((c + SMOOTH * smooth) / (sums + SMOOTH))
            else:
                own = np.flatnonzero(keep[d][a * block:(a + 1) * block])
                nexts.append(((c[own] + SMOOTH * smooth[own]) / (sums[own] + SMOOTH)).astype(np.float32))
        kept_rows[d] = np.concatenate(nexts)
        if d < DEPTH:
            smooth = kept_rows[d]
    for d in range(DEPTH, 1, -1):
        keep[d - 1] |= keep[d].reshape(SYMBOLS, -1).any(axis=0)
    longest, at = np.zeros(1, np.int64), 1
    for d in range(1, DEPTH + 1):
        own = np.flatnonzero(keep[d])
        longest = np.tile(longest, SYMBOLS)
        longest[own] = at + np.arange(len(own))
        at += len(own)
        states.append(kept_rows[d][own] if d < DEPTH else kept_rows[d])
    return longest.astype(np.int32), np.log10(np.concatenate(states)).astype(np.float32), root


STATE = ["gid", "doc_id", "held_out", "sizes", "words", "tokens", "n_known", "base", "logs", "open"]


def state_schema(groups: DataFrame) -> str:
    return ", ".join(f"{c} {k}" for c, k in groups.drop("endings").dtypes) + ", n_known array<bigint>, base array<double>, logs binary, open binary"


def state_row(row: dict, n_known, base, logs: np.ndarray, open_: np.ndarray, doc_id: pa.DataType) -> pa.Table:
    """``logs``: each token's log10-probability so far; ``open``: whether the next longer context is to be tested."""
    cells = {**{c: row[c] for c in STATE[:6]}, "n_known": n_known, "base": base, "logs": squeeze(logs.astype(np.float32).view(np.uint32)), "open": pack(np.packbits(open_))}
    kinds = {"gid": pa.int64(), "doc_id": doc_id, "held_out": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int64()), "n_known": pa.list_(pa.int64()), "base": pa.list_(pa.float64())}
    return pa.table({c: pa.array([cells[c]], kinds.get(c, pa.binary())) for c in STATE})


def begin(groups: DataFrame, answers: DataFrame, buckets: int, frequent: np.ndarray, tree, known: np.ndarray, tokens: int) -> DataFrame:
    """The base scores, and every token's log10-probability by the tree of symbols."""
    longest, states, root = tree
    if longest.nbytes + states.nbytes > TREE_MB << 20:
        raise ValueError("the tree is too large to broadcast")
    held = groups.sparkSession.sparkContext.broadcast((frequent, longest, states, root, known))

    def work(group: pa.Table, got: pa.Table) -> pa.Table:
        frequent, longest, states, root, known = held.value
        row = group.to_pylist()[0]
        g = Group(row)
        order, cuts = homes(g.words, buckets)
        counts = np.zeros(len(g.words), np.int64)
        for b, blob in zip(got["bucket"].to_pylist(), got["counts"]):
            counts[order[cuts[b]:cuts[b + 1]]] = np.frombuffer(blob.as_py(), np.int64)
        c = counts[g.tokens]
        distinct = known.sum() + len(frequent)
        base = np.log10((c + 0.1) / (tokens + 0.1 * (distinct + 1)))
        s = g.symbols(frequent)
        logs = states[longest[contexts(s, g.sizes)], s].astype(np.float64)
        many = s >= 128
        logs[many] += np.log10((c[many] + 0.1) / (root + 0.1 * (known + 1))[s[many]])
        starts = np.cumsum(g.sizes) - g.sizes
        open_ = (places(g.sizes) >= 1) & (np.concatenate([[0], c[:-1]]) >= 2)
        return state_row(row, np.add.reduceat((c > 0).astype(np.int64), starts).tolist(), np.add.reduceat(base, starts).tolist(), logs, open_, group["doc_id"].type)

    return groups.groupBy("gid").cogroup(answers.where("gid >= 0").select("gid", "bucket", "counts").groupBy("gid")).applyInArrow(work, state_schema(groups))


class Types:
    """What follows the contexts of ``depth`` words in a group, at its open tokens:
    distinct (context, next word), by bucket of the context and by hash."""

    def __init__(self, g: Group, open_: np.ndarray, depth: int, buckets: int):
        self.at = np.flatnonzero(open_)
        hashes = g.words[g.tokens]
        context = np.full(len(self.at), depth, np.uint64)
        for d in range(depth, 0, -1):
            context = _mix(context, hashes[self.at - d], np.uint64(d))
        full, first, self.back = np.unique(_mix(context, hashes[self.at], np.uint64(0)), return_index=True, return_inverse=True)
        home = (context[first] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((full, context[first], home))
        self.first, self.full, self.context = first[order], full[order], context[first[order]]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.back = place[self.back]
        self.cuts = np.searchsorted(home[order], np.arange(buckets + 1))


def opened(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    return expand(row["logs"], np.float32, n), np.unpackbits(unpack(row["open"], np.uint8, -(-n // 8)), count=n).astype(bool)


def ask(state: DataFrame, depth: int, buckets: int) -> DataFrame:
    """For each group and bucket: contexts with a next word, how often the
    group's training texts have it, and the sum of its log-probabilities there by the suffixes, negative and in units."""

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                g = Group(row)
                logs, open_ = opened(row, len(g.tokens))
                t = Types(g, open_, depth, buckets)
                own = g.train[t.at]
                counts = np.bincount(t.back[own], minlength=len(t.full)).astype(np.int32)
                lower = np.bincount(t.back[own], np.rint(logs[t.at[own]].astype(np.float64) * (-np.log(10) * UNIT)), len(t.full)).astype(np.int64)
                rows = [(k, g.gid, int(b - a), *(pack(x[a:b]) for x in (t.context, t.full, counts, lower)))
                        for k, (a, b) in enumerate(zip(t.cuts[:-1].tolist(), t.cuts[1:].tolist())) if b > a]
                if rows:
                    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "gid", "n", "context", "word", "counts", "lower"])

    return state.mapInArrow(work, "bucket int, gid bigint, n bigint, context binary, word binary, counts binary, lower binary")


def tested(asked: DataFrame, bar: float) -> DataFrame:
    """For each bucket and group, for what it asked: the count in the corpus, and
    for retained contexts (else 0) the tokens after it and how many are different."""

    def work(group: pa.Table) -> pa.Table:
        sizes = group["n"].to_pylist()
        context, word, counts, lower = (np.concatenate([unpack(x.as_py(), kind, n) for x, n in zip(group[c], sizes)])
                                        for c, kind in (("context", np.uint64), ("word", np.uint64), ("counts", np.int32), ("lower", np.int64)))
        distinct, first, at = np.unique(word, return_index=True, return_inverse=True)
        sums = np.bincount(at, counts, len(distinct)).astype(np.int64)
        _, of = np.unique(context[first], return_inverse=True)
        total = np.bincount(of, sums).astype(np.int64)
        kinds = np.bincount(of, sums > 0).astype(np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.bincount(of, np.where(sums > 0, sums * np.log(sums / total[of]), 0)) + np.bincount(of[at], lower) / UNIT
        keep = (total >= 2) & (gain > np.maximum(kinds - 1, 1) * bar)
        total, kinds = np.where(keep, total, 0), np.where(keep, kinds, 0)
        ends = np.cumsum(sizes)
        rows = [(g, group["bucket"][0].as_py(), pack(sums[x].astype(np.int32)), pack(total[of[x]].astype(np.int32)), pack(kinds[of[x]].astype(np.int32)))
                for g, x in zip(group["gid"].to_pylist(), (at[e - n:e] for e, n in zip(ends, sizes)))]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64(), pa.int32(), *[pa.binary()] * 3])], names=["gid", "bucket", "counts", "total", "kinds"])

    return asked.groupBy("bucket").applyInArrow(work, "gid bigint, bucket int, counts binary, total binary, kinds binary")


def deepen(state: DataFrame, answers: DataFrame, depth: int, buckets: int) -> DataFrame:
    """The state after the contexts of ``depth`` words."""

    def work(group: pa.Table, got: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        g = Group(row)
        logs, open_ = opened(row, len(g.tokens))
        t = Types(g, open_, depth, buckets)
        told = np.zeros((3, len(t.full)), np.int64)
        for b, *blobs in zip(*(got[c].to_pylist() for c in ("bucket", "counts", "total", "kinds"))):
            own = slice(t.cuts[b], t.cuts[b + 1])
            for x, blob in zip(told, blobs):
                x[own] = unpack(blob, np.int32, own.stop - own.start)
        c, total, kinds = told[:, t.back]
        logs, count, keep = logs.astype(np.float64), np.zeros(len(g.tokens), np.int64), total > 0
        at = t.at[keep]
        logs[at] = np.log10((c[keep] + kinds[keep] * 10.0**logs[at]) / (total[keep] + kinds[keep]))
        count[t.at] = c
        longer = (places(g.sizes) > depth) & (np.concatenate([[0], count[:-1]]) >= 2)
        return state_row(row, row["n_known"], row["base"], logs, longer, group["doc_id"].type)

    return state.groupBy("gid").cogroup(answers.groupBy("gid")).applyInArrow(work, state.schema)


def finish(state: DataFrame, tokens: int) -> DataFrame:
    kind = state.schema["doc_id"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def work(batches):
        for batch in batches:
            for k, row in enumerate(batch.to_pylist()):
                sizes = np.array(row["sizes"], np.int64)
                logs, _ = opened(row, int(sizes.sum()))
                score = np.add.reduceat(logs.astype(np.float64), np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_id"], column(batch, "doc_id").type.value_type), pa.array(row["held_out"]), pa.array(sizes), pa.array(row["n_known"], pa.int64()),
                                                  pa.array(np.full(len(sizes), tokens, np.int64)), pa.array(row["base"]), pa.array(score)], names)

    return state.mapInArrow(work, schema)


def lm_scores(df: DataFrame, mod: int = 10, rest: int = 0, id_col: str = "doc_id", text_col: str = "text", group_mb: int = 4) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of
    every row. A task holds a group of about ``group_mb`` MB of input."""
    groups = partitions_for(df, group_mb)
    buckets = max(8, groups // 8)      # a bucket answers all groups: there are groups x buckets answers
    docs = id_text(df, held_out(df[id_col], mod, rest).alias("held_out"), id_col=id_col, text_col=text_col)
    docs = docs.withColumn("gid", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
    split_up = materialize(split(docs), "lm-tokens")
    answers = materialize(answer(gather(split_up, buckets)), "lm-answers")
    sums = answers.where("gid < 0")
    tokens = sums.agg(F.sum("tokens").alias("n")).first().n or 0
    known = np.zeros(SYMBOLS, np.int64)
    for r in sums.select(F.posexplode("known").alias("symbol", "n")).groupBy("symbol").agg(F.sum("n").alias("n")).collect():    # 256 rows
        known[r.symbol] = r.n
    top = sums.select(F.inline("top")).orderBy(F.desc("count"), "word").limit(FREQUENT).collect()
    frequent = np.sort(np.array([r.word for r in top], np.int64).view(np.uint64))
    for r in top:
        known[r.ending] -= 1
    tree = grow(count_symbols(split_up, frequent))
    sweep(df.sparkSession)
    state = materialize(begin(split_up, answers, buckets, frequent, tree, known, tokens), "lm-state")
    for done in (split_up, answers):
        session.discard(done)
    bar = float(np.log(max(tokens, 2)) / 2)
    for depth in range(1, WORD_DEPTH + 1):
        sweep(df.sparkSession)
        told = materialize(tested(ask(state, depth, buckets), bar), "lm-answers")
        sweep(df.sparkSession)
        deeper = materialize(deepen(state, told, depth, buckets), "lm-state")
        for done in (state, told):
            session.discard(done)
        state = deeper
    return finish(state, tokens)
