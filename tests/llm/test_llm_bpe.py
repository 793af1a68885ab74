import hashlib
import random

import pytest
from llm_cases import TEXTS, by_id, edge, empty
from pyspark.sql import functions as F

from matchlab.llm.bpe import Bpe, decode_ids, encode_documents, encoder
from matchlab.llm.packing import library_encoder
from matchlab.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def spec():
    return open(TOKENIZER, encoding="utf-8").read()


def odd_texts():
    rnd = random.Random(7)
    letters = " \n\t  aaabtheing'sll,.!12é字　<|endoftext|>\x1c\x85ﬁ½ "
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    out += ["".join(rnd.choice("aeinrst ") for _ in range(200)) for _ in range(100)]
    return out + ["foo  <|endoftext|>  bar", "<|endoftext|>", "a   b", " ", "  ", "\n \n x  ", "a" * 3000, "ab" * 500, "'s 't'll", *[t for t in TEXTS if t]]


@pytest.mark.parametrize("make", [lambda s: encoder(s)[1], library_encoder])
def test_ids_equal_the_librarys(make, spec, library):
    texts = odd_texts()
    ids, ends, joined = make(spec).encode(texts)
    at = 0
    for k, (t, e) in enumerate(zip(texts, library.encode_batch(texts, add_special_tokens=False))):
        assert ids[at:ends[k]].tolist() == e.ids, t
        if joined:
            assert joined[k] == ",".join(map(str, e.ids))
        at = ends[k]


def test_cache_overflow_keeps_results(spec, library):
    from matchlab.llm.chunks import ChunkEncoder
    b = Bpe(spec)
    small = ChunkEncoder(b.encode_chunks, b.added, limit=3)
    for t in odd_texts()[:60]:
        assert small.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_pair_table_is_exact(spec):
    """A piece's merges, applied in order of rank, against the encoder."""
    b = Bpe(spec)
    rnd = random.Random(3)

    def merged(piece):
        parts = [next(i for i, x in enumerate(b.token) if x == bytes([c]) and b.rank[i] < 0) for c in piece]
        while True:
            best = min(((b.merge[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in b.merge), default=None)
            if best is None:
                return parts
            i = best[1]
            made = next(k for k, h in enumerate(b.halves) if h == (parts[i], parts[i + 1]))
            parts[i:i + 2] = [made]

    for _ in range(25):
        piece = "".join(rnd.choice("aaeinthrs") for _ in range(rnd.randint(1, 14))).encode()
        assert b.encode_bytes(piece) == merged(piece)


def test_documents(spark, library):
    df = edge(spark)
    got = by_id(encode_documents(df, TOKENIZER))
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        r = got[i]
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert encode_documents(df, TOKENIZER).count() == df.count()
    assert encode_documents(empty(spark), TOKENIZER).count() == 0


def test_round_trip(spark):
    df = edge(spark)
    back = decode_ids(encode_documents(df, TOKENIZER), TOKENIZER)
    assert {r.doc_id: r.text for r in back.where("doc_id IS NOT NULL").collect()} == {
        r.doc_id: r.text for r in df.where("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()}
