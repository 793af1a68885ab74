"""Harmonic packing of documents into sequences of a fixed capacity.

A document's ids (with the end id) are cut into pieces of the capacity and a
rest. The rest's class is k = capacity // length: a slot of class k is
capacity // k long, and a bin of class k holds exactly k pieces, so a bin is
filled by counting, without looking at lengths. Where a slot would stay
emptier than ``waste``, the rest is cut once more: a piece as long as a slot
of class k + 1, which leaves nothing, and a smaller rest. Every Spark
partition fills its own bins, so there is no shuffle; the open bins that a
partition ends with (fewer than k pieces of each class) are put together,
longest piece first, into the first bin with room.

Defined results: a null or empty text is the end id alone; repeated rows are
packed as often as they occur; an empty table gives an empty one; further
columns are ignored. ``sequence_id`` is partition * 2^33 + number: unique,
and the same when a lost task runs again.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchlab.llm.chunks import ChunkEncoder, added_tokens
from matchlab.llm.common import column, id_text, slices

NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_MADE: dict[int, ChunkEncoder] = {}


def library_encoder(spec: str) -> ChunkEncoder:
    """Ids by the tokenizers library, asked once for each distinct chunk."""
    if hash(spec) not in _MADE:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        t = Tokenizer.from_str(spec)
        t.no_truncation(), t.no_padding()
        # bytes of each token: its letters stand for one byte each; added tokens are ASCII
        sizes = np.zeros(t.get_vocab_size(), np.int64)
        for word, i in t.get_vocab().items():
            sizes[i] = len(word)

        def encode(chunks: list[str]) -> list:
            """Chunks of a space and a word are encoded many at once, as running
            text, and told apart by the bytes of their tokens."""
            out: list = [None] * len(chunks)
            plain = [i for i, c in enumerate(chunks) if c[0] == " " and len(c) > 1 and not (c[-1].isspace() or c[1].isspace())]
            for k in range(0, len(plain), 4096):
                own = plain[k:k + 4096]
                ids = np.array(t.encode_batch_fast(["".join([chunks[i] for i in own])], add_special_tokens=False)[0].ids, np.int64)
                ends = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum([len(chunks[i].encode()) for i in own])) + 1
                for i, a, b in zip(own, [0, *ends.tolist()], ends.tolist()):
                    out[i] = ids[a:b]
            rest = [i for i, x in enumerate(out) if x is None]
            for i, e in zip(rest, t.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False)):
                out[i] = e.ids
            return out

        _MADE[hash(spec)] = ChunkEncoder(encode, added_tokens(spec), limit=800_000)
    return _MADE[hash(spec)]


def cuts(n: int, capacity: int = 1024, waste: float = 1 / 16) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    out, rest = [capacity] * (n // capacity), n % capacity
    while rest:
        k = capacity // rest
        if capacity // k - rest <= waste * (capacity // k):
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


class Bins:
    """Open bins of one partition: of each class the pieces that don't fill a bin yet."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id, self.open = capacity, first_id, {}

    def add(self, piece: tuple, out: list) -> None:
        k = self.capacity // piece[2]
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            self._close(self.open.pop(k), out)

    def _close(self, pieces: list, out: list) -> None:
        at = 0
        for p in pieces:
            out.append((*p, self.next_id, at))
            at += p[2]
        self.next_id += 1

    def finish(self, out: list) -> None:
        bins: list[list] = []
        room: list[int] = []
        for p in sorted((p for held in self.open.values() for p in held), key=lambda p: -p[2]):
            i = next((i for i, r in enumerate(room) if r >= p[2]), len(room))
            if i == len(room):
                bins.append([])
                room.append(self.capacity)
            bins[i].append(p)
            room[i] -= p[2]
        for b in bins:
            self._close(b, out)


def pack(df: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, waste: float = 1 / 16,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` (and the piece's ``ids`` if ``with_ids``)."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    id_type = dict(df.dtypes)[id_col]
    schema = f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids + ", sequence_id bigint, offset bigint"
    names = NAMES[:5] + ["ids"] * with_ids + NAMES[5:]

    def run(batches):
        from pyspark import TaskContext
        encode, bins = library_encoder(spec.value).encode, Bins(capacity, TaskContext.get().partitionId() << 33)
        made, kind = [], None

        def rows(out):
            arrays = [pa.array(x, kind if i == 0 else pa.list_(pa.int32()) if names[i] == "ids" else pa.int64()) for i, x in enumerate(zip(*out))]
            return pa.RecordBatch.from_arrays(arrays, names)

        for part in slices(batches):
            kind = column(part, "doc_id").type
            ids, ends, _ = encode(column(part, "text").to_pylist())
            a = 0
            for doc, b in zip(column(part, "doc_id").to_pylist(), ends.tolist()):
                own, at = np.append(ids[a:b], np.uint32(end_id)).astype("<u4"), 0
                a = b
                for n in cuts(len(own), capacity, waste):
                    piece = own[at:at + n]
                    bins.add((doc, at, n, zlib.crc32(piece), len(own), *[piece.astype(np.int32)] * with_ids), made)
                    at += n
            if made:
                yield rows(made)
                made = []
        bins.finish(made)
        if made:
            yield rows(made)

    return id_text(df, id_col=id_col, text_col=text_col).mapInArrow(run, schema)
