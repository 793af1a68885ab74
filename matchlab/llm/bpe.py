"""Byte-pair encoding and decoding in linear time.

Encoding: an Aho-Corasick automaton over the reversed vocabulary, run over a
reversed piece, gives the longest token that starts at every byte. The
encoder takes the longest token, checks it against its left neighbour in the
pair-compatibility table, and falls back to the next shorter prefix token,
or a token back, where the pair can't stand side by side in a merged piece.
A position from which no encoding goes on is marked and never tried again,
so the work is linear in the piece. A pair is compatible if undoing its
merges, latest first, never meets a merge across the border that byte-pair
encoding would have made before. Results equal those of applying the merges
in order of rank.

Decoding: the bytes of all tokens lie in one array, token i from offset[i]
to offset[i + 1]; ids become bytes by one gather.

Defined results: a null text is an empty one; an empty one has no ids (the
digests are those of the empty string); repeated rows give repeated rows; an
empty table gives an empty one; further input columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchlab.llm.chunks import WHITE, ChunkEncoder, added_tokens, ragged
from matchlab.llm.common import column, id_text, slices

#: Fixed value: the pattern of byte-level pre-tokenization, with white space spelled out.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the rest counted up from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Tables of one vocabulary; ``spec`` is the text of a tokenizer file."""

    def __init__(self, spec: str):
        import ahocorasick
        import regex

        t = json.loads(spec)
        vocab, merges = t["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in t["model"]["merges"]]
        letters = byte_letters()
        self.added = added_tokens(spec)
        n = max([*vocab.values(), *self.added.values()]) + 1
        self.token = [b""] * n
        for word, i in vocab.items():
            self.token[i] = bytes(letters[c] for c in word)
        for word, i in self.added.items():
            self.token[i] = word.encode()
        # rank of the merge that makes a token (bytes: none), its two halves, and pair -> rank
        self.rank, self.halves, self.merge = [-1] * n, [None] * n, {}
        for r, (a, b) in enumerate(merges):
            a, b, made = vocab[a], vocab[b], vocab[a + b]
            if self.rank[made] >= 0:
                raise ValueError("a token that two merges make isn't supported")
            self.rank[made], self.halves[made], self.merge[a, b] = r, (a, b), r
        whole = {self.token[i]: i for i in vocab.values() if self.rank[i] >= 0 or len(self.token[i]) == 1}
        self.length = list(map(len, self.token))
        self.shorter = [-1] * n
        machine = ahocorasick.Automaton()
        for b, i in whole.items():
            machine.add_word(b.decode("latin-1")[::-1], i)
            self.shorter[i] = next((whole[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in whole), -1)
        machine.make_automaton()
        self.machine, self.compatible, self.known, self.pieces = machine, {}, {}, regex.compile(PATTERN)
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])

    def fits(self, left: int, right: int) -> bool:
        """Do ``left`` and ``right`` stay side by side under the merges?"""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > 1_000_000:
                self.compatible.clear()
            known = self.compatible[left, right] = self._undo(left, right)
        return known

    def _undo(self, left: int, right: int) -> bool:
        rank, merge = self.rank, self.merge
        # Merges done so far are those before (bound, side): a merge across the border
        # happens if its rank is smaller, or equal and it stands further left.
        bound, from_left = len(merge), False
        while True:
            across = merge.get((left, right))
            if across is not None and (across < bound or across == bound and not from_left):
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                bound, from_left, left = a, True, self.halves[left][1]
            elif b > a:
                bound, from_left, right = b, False, self.halves[right][0]
            else:       # the same token twice: the right one was made last
                bound, from_left, right = b, False, self.halves[right][0]

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        n = len(piece)
        first = [-1] * n
        for end, i in self.machine.iter(piece.decode("latin-1")[::-1]):
            if first[n - 1 - end] < 0:      # at each end the automaton gives the longest first
                first[n - 1 - end] = i
        length, shorter, fits = self.length, self.shorter, self.fits
        out, at, closed, token = [], 0, bytearray(n + 1), first[0]
        while True:
            end = at + length[token]
            if not closed[end] and (not out or fits(out[-1], token)):
                out.append(token)
                if end == n:
                    return out
                at, token = end, first[end]
                continue
            token = shorter[token]
            while token < 0:
                closed[at] = 1
                token = out.pop()
                at -= length[token]
                token = shorter[token]

    def encode_chunks(self, chunks) -> list[list[int]]:
        if len(self.known) > 200_000:
            self.known.clear()
        known, out = self.known, []
        for c in chunks:
            ids = []
            for piece in self.pieces.findall(c):
                own = known.get(piece)
                if own is None:
                    own = self.encode_bytes(piece.encode())
                    if len(piece) < 40:
                        known[piece] = own
                ids += own
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each text; ``ends``: where each text's ids end."""
        lengths = self.offset[ids + 1] - self.offset[ids]
        data = self.bytes[ragged(self.offset[ids], lengths)].tobytes()
        upto = np.concatenate([[0], np.cumsum(lengths)])[ends]
        return [data[a:b] for a, b in zip([0, *upto], upto)]


_MADE: dict[int, tuple] = {}


def encoder(spec: str) -> tuple[Bpe, ChunkEncoder]:
    """The worker's own tables, built once."""
    if hash(spec) not in _MADE:
        b = Bpe(spec)
        _MADE[hash(spec)] = b, ChunkEncoder(b.encode_chunks, b.added, decimals=True)
    return _MADE[hash(spec)]


def encode_documents(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``ids`` (if ``with_ids``), and the digest columns
    ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every text.
    ``tokenizer`` is a file the driver can open; its text (a few MB, whatever
    the input) is broadcast."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    id_type = dict(df.dtypes)[id_col]
    schema = f"doc_id {id_type}, " + "ids array<int>, " * with_ids + "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        bpe, chunks = encoder(spec.value)
        for part in slices(batches):
            ids, ends, joined = chunks.encode(column(part, "text").to_pylist())
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            decoded = bpe.decode(ids.astype(np.int64), ends)
            columns = [column(part, "doc_id")]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int32)))
            columns += [
                pa.array(ends - starts, pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined]),
                pa.array([hashlib.sha256(x.decode(errors="replace").encode()).hexdigest() for x in decoded])]
            names = ["doc_id", *["ids"] * with_ids, "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return id_text(df, id_col=id_col, text_col=text_col).mapInArrow(run, schema)


def decode_ids(df: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and the ``text`` that an ids column stands for (null ids:
    empty; bytes that aren't UTF-8 become U+FFFD)."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        bpe, _ = encoder(spec.value)
        for batch in batches:
            lists = [x or [] for x in column(batch, "ids").to_pylist()]
            ends = np.cumsum([len(x) for x in lists], dtype=np.int64)
            ids = np.array([i for x in lists for i in x], np.int64)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array([x.decode(errors="replace") for x in bpe.decode(ids, ends)], pa.string())],
                ["doc_id", "text"])

    return df.select(df[id_col].alias("doc_id"), df[ids_col].alias("ids")).mapInArrow(run, f"doc_id {dict(df.dtypes)[id_col]}, text string")
