import zlib
from collections import defaultdict

import numpy as np
from llm_cases import TEXTS, docs, edge, empty

from matchlab.llm.packing import Bins, cuts, pack
from matchlab.llm.queries import TOKENIZER


def test_cuts():
    for n in range(1, 5000):
        c = cuts(n)
        assert sum(c) == n and all(0 < x <= 1024 for x in c)
        assert all(1024 // (1024 // x) - x <= 1024 // (1024 // x) / 16 for x in c)


def test_bins_by_count():
    b, out = Bins(12, 100), []
    for i, n in enumerate([4, 6, 3, 3, 6, 4, 3, 4, 3, 5]):
        b.add((i, 0, n), out)
    b.finish(out)
    seqs = defaultdict(list)
    for i, _, n, seq, at in out:
        seqs[seq].append((at, n))
    assert sorted(i for i, *_ in out) == list(range(10))
    for x in seqs.values():
        x.sort()
        assert [a for a, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))] and sum(n for _, n in x) <= 12


def check(df, texts, fill):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    rows = pack(df, TOKENIZER).collect()
    seqs, by = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        if r.doc_id is not None:
            by[r.doc_id].append(r)
    for x in seqs.values():
        x.sort()
        assert [a for a, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))] and sum(n for _, n in x) <= 1024
    for i, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert sum(n for x in seqs.values() for _, n in x) >= fill * 1024 * len(seqs)


def test_edge(spark):
    df = edge(spark).where("doc_id IS NULL OR doc_id != 5")       # without the repeated rows
    check(df, {i: t for i, t in enumerate(TEXTS) if i != 5}, 0.5)
    assert pack(empty(spark), TOKENIZER).count() == 0
    assert pack(edge(spark).where("doc_id = 5"), TOKENIZER).count() == 3


def test_little_padding(spark):
    texts = {i: " ".join(f"w{(i * 31 + k * k) % 977}" for k in range(20 + (i * 37) % 900)) for i in range(400)}
    check(docs(spark, list(texts.values())), texts, 0.95)


def test_ids(spark):
    rows = pack(docs(spark, ["some words", "more"]), TOKENIZER, with_ids=True).collect()
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
