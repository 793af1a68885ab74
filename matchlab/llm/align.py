"""Alignment of two tokenizers' tokens, and corpus-wide counts of linked ids.

Both tokenizers (A: byte-level BPE, B: sentencepiece with byte fallback) encode
a space and the text. A text is cut before each space that ends a word: there
both tokenizers begin a new piece, so a distinct chunk is encoded once a task
(bounded cache). The ends of all A and B tokens of a slice of documents, in
bytes, are two sorted arrays. Merge path: diagonals every ``PIECE`` steps are
cut by binary search into independent pieces of equal work; all pieces merge
in step. Each emits the overlapping pairs of tokens with the number of common
ends so far in its piece; a running sum over the pieces' common ends stitches
what crosses a piece's border into one group.

Counts: a task puts documents into blocks of about ``BLOCK_PAIRS`` linked id
pairs. A block's distinct pairs and in how many of its documents each occurs
are summed over the corpus; the sums go back to the blocks that asked. So a
pair crosses the shuffle once a block that holds it, however many documents
do, and a task of the last step holds one block. The greatest count of each A
id (at most one row an id of the vocabulary) is broadcast.

Defined results: null and empty texts, and texts that a tokenizer doesn't
give back byte by byte, have no tokens; special tokens' strings are plain
text; repeated rows count as documents each; a null id is kept; an empty table
gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from matchlab.llm.bpe import byte_letters
from matchlab.llm.chunks import WHITE, ragged
from matchlab.llm.common import column, id_text, materialize, slices

PIECE = 64
BLOCK_PAIRS = 1 << 20
#: Groups with more links than this are reduced to distinct ids with their counts first.
MANY_LINKS = 1 << 12
_CUT = re.compile(f"(?<![{WHITE}]) ")
_ODD = re.compile(f"[{WHITE}] ")
_BYTE = re.compile("<0x([0-9A-F]{2})>")


class Table:
    """Ids of chunks, one after the other, in arrays that grow."""

    def __init__(self):
        self.ids, self.used = np.empty(1 << 16, np.int32), 0
        self.starts, self.sizes = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self.n = 0

    def add(self, lists: list) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.concatenate([np.asarray(x, np.int32) for x in lists]) if lists else np.empty(0, np.int32)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.n + len(lists) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.empty_like(x)]) for x in (self.starts, self.sizes))
        self.ids[self.used:self.used + len(flat)] = flat
        self.sizes[self.n:self.n + len(lists)] = sizes
        self.starts[self.n:self.n + len(lists)] = self.used + np.cumsum(sizes) - sizes
        self.n += len(lists)
        self.used += len(flat)

    def take(self, slots: np.ndarray) -> np.ndarray:
        return self.ids[ragged(self.starts[slots], self.sizes[slots])]


class Both:
    """Both tokenizers behind one cache of chunks (without their leading space)."""

    def __init__(self, spec: str, model: bytes, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(spec)
        self.a.no_truncation(), self.a.no_padding()
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for word, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(map(letters.__getitem__, word)) if all(c in letters for c in word) else word.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece that goes on behind a space isn't supported")
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.lone = [pieces.index("▁")]
        if len(self.bytes_a) * len(pieces) > 1 << 32:
            raise ValueError("vocabularies whose pairs of ids don't fit in 32 bits aren't supported")
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.words_a, self.words_b = ([str(i) for i in range(len(x))] for x in (self.bytes_a, self.bytes_b))
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.index, self.tables, self.sound = {}, (Table(), Table()), np.empty(0, bool)

    def _apart(self, ids, sizes, lengths) -> list:
        """``ids`` of a running text told apart by the chunks' lengths in bytes."""
        ends = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum(lengths)) + 1
        return np.split(ids, ends[:-1])

    def _learn(self, new: list[str]) -> None:
        raw = [b" " + c.encode() for c in new]
        lengths = list(map(len, raw))
        out = [None] * len(new), [None] * len(new)
        plain = [i for i, c in enumerate(new) if c and "▁" not in c and not any(x.isspace() for x in (c[0], c[-1]))]
        for k in range(0, len(plain), 4096):        # running text of many chunks
            own = plain[k:k + 4096]
            text, n = " ".join(new[i] for i in own), [lengths[i] for i in own]
            a = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int32)
            b = np.array(self.b.encode(text), np.int32)
            for made, ids, sizes in ((out[0], a, self.size_a), (out[1], b, self.size_b)):
                if int(sizes[ids].sum()) == sum(n):
                    for i, x in zip(own, self._apart(ids, sizes, n)):
                        made[i] = x
        rest = [i for i, x in enumerate(out[0]) if x is None]
        for i, e in zip(rest, self.a.encode_batch_fast([" " + new[i] for i in rest], add_special_tokens=False)):
            out[0][i] = e.ids
        rest = [i for i, x in enumerate(out[1]) if x is None]
        for i, e in zip(rest, self.b.encode([new[i] for i in rest], num_threads=1)):
            out[1][i] = e if new[i] else self.lone
        fine = np.ones(len(new), bool)
        for made, table, own in zip(out, self.tables, (self.bytes_a, self.bytes_b)):
            table.add(made)
            fine &= np.fromiter((b"".join([own[i] for i in x]) == r for x, r in zip(made, raw)), bool, len(new))
        self.sound = np.concatenate([self.sound, fine])

    def encode(self, texts: list) -> tuple:
        """A ids, B ids, and where each text's end in both."""
        if len(self.index) > self.limit:
            self.clear()
        keys, ends, index, new = [], [], self.index, []
        for t in texts:
            if t:
                keys += _CUT.split(" " + t)[1:] if t[0] in WHITE or _ODD.search(t) else t.split(" ")
            ends.append(len(keys))
        for c in set(keys):
            if c not in index:
                index[c] = len(index)
                new.append(c)
        if new:
            self._learn(new)
        slots = np.fromiter(map(index.__getitem__, keys), np.int64, len(keys))
        ends = np.array(ends, np.int64)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        broken = np.concatenate([[0], np.cumsum(~self.sound[slots])])
        whole = np.repeat(broken[ends] == broken[starts], ends - starts)
        slots = slots[whole]
        out = []
        for table in self.tables:
            sizes = np.zeros(len(whole), np.int64)
            sizes[whole] = table.sizes[slots]
            out += [table.take(slots), np.concatenate([[0], np.cumsum(sizes)])[ends]]
        return out[0], out[2], out[1], out[3]


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each A and each B token, and the number of groups, from
    the tokens' ends: strictly growing arrays with the same last value."""
    na, nb = len(a), len(b)
    total = na + nb
    group_a, group_b = np.zeros(na, np.int64), np.zeros(nb, np.int64)
    if not total:
        return group_a, group_b, 0
    # diagonals: of the first d steps, i take an A end (at equal ends A goes first)
    d = np.arange(0, total, piece)
    lo, hi = np.maximum(0, d - nb), np.minimum(d, na)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        first = open_ & (a[np.minimum(mid, na - 1)] <= b[np.clip(d - 1 - mid, 0, nb - 1)])
        lo, hi = np.where(first, mid + 1, lo), np.where(open_ & ~first, mid, hi)
    i, j = lo, d - lo
    # sentinels: behind the last end, and a start before the first
    ax, bx = np.append(a, np.iinfo(np.int64).max), np.append(b, np.iinfo(np.int64).max)
    sa, sb = np.concatenate([[0], a]), np.concatenate([[0], b])
    common = np.zeros(len(d), np.int64)
    emitted = []
    for _ in range(piece):
        ea, eb = ax[i], bx[j]
        over = np.maximum(sa[i], sb[j]) < np.minimum(ea, eb)
        over &= (i < na) & (j < nb)
        emitted.append((np.flatnonzero(over), i[over], j[over], common[over]))
        take_a = ea <= eb
        common += (ea == eb) & (i < na)
        i, j = np.minimum(i + take_a, na), np.minimum(j + ~take_a, nb)
    # stitch by the common ends in the pieces before (one counts in the piece that takes its A end; steps behind the last end change nothing)
    before = np.cumsum(common) - common
    for own, x, y, seen in emitted:
        group_a[x] = group_b[y] = before[own] + seen
    return group_a, group_b, int(common.sum())


def linked_pairs(ids_a, ids_b, group_a, group_b, n: int, doc_of_group, vocabulary_b: int) -> tuple:
    """Distinct keys doc << 32 | A id * vocabulary + B id, in order, and how many links each has."""
    x, y = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    first_a, first_b = np.cumsum(x) - x, np.cumsum(y) - y
    links = x * y
    keys, weights = [], []
    few = np.flatnonzero(links <= MANY_LINKS)
    for own in np.split(few, np.searchsorted(np.cumsum(links[few]), np.arange(1 << 22, int(links[few].sum()), 1 << 22))) if len(few) else []:
        g = np.repeat(own, links[own])
        at = ragged(np.zeros(len(own), np.int64), links[own])
        a, b = ids_a[first_a[g] + at // y[g]], ids_b[first_b[g] + at % y[g]]
        keys.append(doc_of_group[g] << 32 | a.astype(np.int64) * vocabulary_b + b)
        weights.append(np.ones(len(g), np.int64))
    for g in np.flatnonzero(links > MANY_LINKS).tolist():
        a, ca = np.unique(ids_a[first_a[g]:first_a[g] + x[g]], return_counts=True)
        b, cb = np.unique(ids_b[first_b[g]:first_b[g] + y[g]], return_counts=True)
        keys.append((doc_of_group[g] << 32 | a.astype(np.int64)[:, None] * vocabulary_b + b).ravel())
        weights.append((ca[:, None] * cb).ravel())
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    if len(keys) == int(weights.sum()):
        return np.unique(keys, return_counts=True)
    keys, back = np.unique(keys, return_inverse=True)
    return keys, np.bincount(back, weights).astype(np.int64)


def squeeze(x: np.ndarray) -> bytes:
    """Small numbers, as compressed byte planes."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


_MADE: dict[int, Both] = {}


def both(spec: str, model: bytes) -> Both:
    key = hash((spec, model))
    if key not in _MADE:
        _MADE[key] = Both(spec, model)
    return _MADE[key]


def group_texts(t: Both, ids_a, ids_b, group_a, group_b, n: int, doc_of_group, docs: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document."""
    x, y = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    begin = np.cumsum(x + y) - x - y
    words = np.empty(int((x + y).sum()), object)
    marks = np.full(len(words), ",", object)
    words[ragged(begin, x)] = np.array(t.words_a, object)[ids_a]
    words[ragged(begin + x, y)] = np.array(t.words_b, object)[ids_b]
    marks[begin + x - 1] = "|"
    marks[begin + x + y - 1] = ";"
    each = np.empty(2 * len(words), object)
    each[::2], each[1::2] = words, marks
    ends = 2 * np.cumsum(np.bincount(doc_of_group, x + y, minlength=docs).astype(np.int64))
    each = each.tolist()
    return ["".join(each[a:b - 1]) if b > a else "" for a, b in zip([0, *ends.tolist()], ends.tolist())]


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "block", "n_pairs", "pairs", "times"]


def align(df: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """A row for each document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``groups_sha256``, ``groups`` (if asked for; ids of each group as
    ``a1,a2|b1;a3|b2``), and its linked id pairs: the document's ``block``, and
    ``pairs`` (gaps between their numbers in the block's list) and ``times``
    (links of each), both squeezed, ``n_pairs`` many. A row with ``n_a`` null ends
    each block: ``pairs`` is the block's list (gaps between A id * size of B's
    vocabulary + B id), ``times`` the documents that hold each. ``tokenizer_a``
    and ``tokenizer_b`` are files the driver can open; they are broadcast (a few
    MB, whatever the input)."""
    sc = df.sparkSession.sparkContext
    with open(tokenizer_a, encoding="utf-8") as f, open(tokenizer_b, "rb") as g:
        shared = sc.broadcast((f.read(), g.read()))
    schema = (f"doc_id {dict(df.dtypes)[id_col]}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
              "block bigint, n_pairs bigint, pairs binary, times binary")

    def work(batches):
        t = both(*shared.value)
        wide = len(t.bytes_b)
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def close():
            """Rows of the held documents and of their block."""
            every = [x[-2] for x in held]
            flat = np.concatenate(every) if every else np.zeros(0, np.int64)
            distinct, back = np.unique(flat, return_inverse=True)
            at, rows = 0, []
            for *first, pairs, times in held:
                own = back[at:at + len(pairs)]
                at += len(pairs)
                rows.append((*first, block, len(pairs), squeeze(np.diff(own, prepend=0)), squeeze(times)))
            for k in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows[k:k + 2000]), types)], NAMES)
            if len(distinct):
                rows = [(None,) * 7 + (block, len(distinct), squeeze(np.diff(distinct, prepend=0)), squeeze(np.bincount(back)))]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), types)], NAMES)

        types = None
        for part in slices(batches):
            types = types or [column(part, "doc_id").type, *[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            docs = part.num_rows
            ids_a, ids_b, ends_a, ends_b = t.encode(column(part, "text").to_pylist())
            group_a, group_b, n = merge_path(np.cumsum(t.size_a[ids_a]), np.cumsum(t.size_b[ids_b]))
            n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
            doc_of_group = np.zeros(n, np.int64)
            doc_of_group[group_a] = np.repeat(np.arange(docs), n_a)
            links = np.bincount(doc_of_group, np.bincount(group_a, minlength=n) * np.bincount(group_b, minlength=n), minlength=docs).astype(np.int64)
            texts = group_texts(t, ids_a, ids_b, group_a, group_b, n, doc_of_group, docs)
            keys, times = linked_pairs(ids_a, ids_b, group_a, group_b, n, doc_of_group, wide)
            cuts = np.searchsorted(keys, np.arange(docs + 1) << 32)
            for k, (i, g) in enumerate(zip(column(part, "doc_id").to_pylist(), np.bincount(doc_of_group, minlength=docs).tolist())):
                own = slice(cuts[k], cuts[k + 1])
                sha = hashlib.sha256(texts[k].encode()).hexdigest() if n_a[k] else ""
                held.append((i, int(n_a[k]), int(n_b[k]), g, int(links[k]), sha, texts[k] if with_groups else None, keys[own] & 0xFFFFFFFF, times[own]))
                size += len(held[-1][-1])
                if size >= BLOCK_PAIRS:
                    yield from close()
                    block, held, size = block + 1, [], 0
        if held:
            yield from close()

    return id_text(df, id_col=id_col, text_col=text_col).mapInArrow(work, schema)


def asked(aligned: DataFrame) -> DataFrame:
    """``block``, ``pair``, ``n``: in how many of the block's documents each of its linked pairs occurs."""
    def work(batches):
        for batch in batches:
            for block, n, pairs, times in zip(*(column(batch, c).to_pylist() for c in ("block", "n_pairs", "pairs", "times"))):
                keys, n = np.cumsum(unsqueeze(pairs, n)), unsqueeze(times, n)
                for k in range(0, len(keys), 1 << 16):
                    own = keys[k:k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own), pa.array(n[k:k + (1 << 16)])], ["block", "pair", "n"])

    return aligned.where("n_a IS NULL").select("block", "n_pairs", "pairs", "times").mapInArrow(work, "block bigint, pair bigint, n bigint")


def vocabulary(tokenizer_b: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_b).get_piece_size()


def link_counts(aligned: DataFrame, vocabulary_b: int) -> DataFrame:
    """``pair``, ``a_id``, ``b_id``, ``n_docs``: in how many documents of the corpus each pair is linked."""
    sums = asked(aligned).groupBy("pair").agg(F.sum("n").alias("n_docs"))
    return sums.select("pair", F.expr(f"pair div {vocabulary_b}").cast("int").alias("a_id"), F.expr(f"pair % {vocabulary_b}").cast("int").alias("b_id"), "n_docs")


def score_links(aligned: DataFrame, vocabulary_b: int) -> DataFrame:
    """What ``align`` tells of each document, with ``n_best`` (links whose count
    is their A id's greatest) and ``count_sum`` (sum of the counts of all links)."""
    counts = link_counts(aligned, vocabulary_b)
    best = counts.groupBy("a_id").agg(F.max("n_docs").alias("most"))       # one row an id of A's vocabulary at most
    counts = counts.join(F.broadcast(best), "a_id").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))
    answers = asked(aligned).join(counts, "pair").select("block", "pair", "n_docs", "best")
    told = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def gather(known: pa.Table, docs: pa.Table) -> pa.Table:
        order = np.argsort(known["pair"].to_numpy(), kind="stable")
        n, top = known["n_docs"].to_numpy()[order], known["best"].to_numpy(zero_copy_only=False)[order]
        sums, tops = [], []
        for size, pairs, times in zip(docs["n_pairs"].to_pylist(), docs["pairs"].to_pylist(), docs["times"].to_pylist()):
            own, times = np.cumsum(unsqueeze(pairs, size)), unsqueeze(times, size)
            sums.append(int((n[own] * times).sum()))
            tops.append(int(times[top[own]].sum()))
        return pa.table([*(docs[c] for c in told), pa.array(tops, pa.int64()), pa.array(sums, pa.int64())], names=[*told, "n_best", "count_sum"])

    kinds = dict(aligned.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in told) + ", n_best bigint, count_sum bigint"
    docs = aligned.where("n_a IS NOT NULL").select(*told, "block", "n_pairs", "pairs", "times")
    return answers.groupBy("block").cogroup(docs.groupBy("block")).applyInArrow(gather, schema)


def alignments(df: DataFrame, tokenizer_a: str, tokenizer_b: str, **more) -> DataFrame:
    """Every document's alignment and corpus-wide link counts, as digests."""
    aligned = materialize(align(df, tokenizer_a, tokenizer_b, **more), "aligned")
    return score_links(aligned, vocabulary(tokenizer_b)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
