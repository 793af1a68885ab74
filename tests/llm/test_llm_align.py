import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import LONG, TEXTS, docs, edge, empty

from matchlab.llm import align as module
from matchlab.llm.align import Both, align, alignments, asked, link_counts, linked_pairs, merge_path, squeeze, unsqueeze, vocabulary
from matchlab.llm.bpe import byte_letters
from matchlab.llm.queries import PIECES, TOKENIZER

LETTERS = byte_letters()


@pytest.fixture(scope="module")
def plain():
    """Both libraries on whole texts: ids and bytes of tokens."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(TOKENIZER)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def encode(text):
        if not text:
            return [], [], [], []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bx, by = [bytes(LETTERS[c] for c in a.id_to_token(i)) for i in x], [piece(i) for i in y]
        whole = (" " + text).encode()
        return (x, bx, y, by) if b"".join(bx) == whole == b"".join(by) else ([], [], [], [])
    return encode


def brute(encode, texts):
    """Groups by walking over the bytes, links as all pairs, counts over all documents."""
    per, seen = [], Counter()
    for t in texts:
        x, bx, y, by = encode(t)
        ends_a, ends_b = np.cumsum([len(z) for z in bx]).tolist(), np.cumsum([len(z) for z in by]).tolist()
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            u, v = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            groups.append((x[i:u], y[j:v]))
            i, j = u, v
        links = [(p, q) for g, h in groups for p in g for q in h]
        seen.update(set(links))
        per.append((len(x), len(y), groups, links))
    most = Counter()
    for (p, _), n in seen.items():
        most[p] = max(most[p], n)
    out = []
    for n_a, n_b, groups, links in per:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(seen[k] == most[k[0]] for k in links), sum(seen[k] for k in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, seen


def odd_texts():
    rnd = random.Random(7)
    letters = " \n\t  aaabtheing'sll,.!12é字　▁<|endoftext|></s>\x1c\x85ﬁ½=- "
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(600)]
    out += ["".join(rnd.choice("aeinrst ") for _ in range(200)) for _ in range(40)] + ["word " * 30, "x▁y", "<s> <unk> </s> <0x41>", "=" * 777 + "a" * 301]
    return out + ["foo  <|endoftext|>  bar", "a   b ", "b  ", " ", "  ", "   x", "\n \n x  ", "\x00", "'s 't'll", "字" * 50, "🙂🙃 é́"]


def test_ids_equal_the_libraries(plain):
    t = Both(open(TOKENIZER, encoding="utf-8").read(), open(PIECES, "rb").read(), limit=500)
    texts = odd_texts() + [x for x in TEXTS if x]
    for part in (texts, texts[::-1]):
        a, b, ends_a, ends_b = t.encode(part)
        for k, text in enumerate(part):
            x, _, y, _ = plain(text)
            lo_a, lo_b = (ends_a[k - 1], ends_b[k - 1]) if k else (0, 0)
            assert (a[lo_a:ends_a[k]].tolist(), b[lo_b:ends_b[k]].tolist()) == (x, y), repr(text)
    assert t.encode([])[0].tolist() == [] and t.encode([None, ""])[2].tolist() == [0, 0]


@pytest.mark.parametrize("piece", [1, 2, 7, 64, 5000])
def test_merge_path_in_any_pieces(piece):
    rnd = random.Random(piece)
    for _ in range(60):
        n = rnd.randint(1, 300)
        a, b = (sorted({*rnd.sample(range(1, n + 1), rnd.randint(1, n)), n}) for _ in range(2))
        group_a, group_b, k = merge_path(np.array(a), np.array(b), piece)
        ends = sorted(set(a) & set(b))
        assert k == len(ends)
        assert group_a.tolist() == [sum(e < x for e in ends) for x in a] and group_b.tolist() == [sum(e < x for e in ends) for x in b]
    assert merge_path(np.zeros(0, np.int64), np.zeros(0, np.int64))[2] == 0


@pytest.mark.parametrize("many", [0, 6, 1 << 12])
def test_links(monkeypatch, many):
    """Large groups are counted by distinct ids, with the same result."""
    monkeypatch.setattr(module, "MANY_LINKS", many)
    rnd = np.random.default_rng(many)
    group_a, group_b = (np.sort(np.concatenate([np.arange(30), rnd.integers(0, 30, 90)])) for _ in range(2))
    ids_a, ids_b, doc = rnd.integers(0, 5, 120), rnd.integers(0, 5, 120), np.sort(rnd.integers(0, 4, 30))
    want = Counter((int(doc[g]), int(p), int(q)) for p, g in zip(ids_a, group_a) for q, h in zip(ids_b, group_b) if g == h)
    keys, times = linked_pairs(ids_a, ids_b, group_a, group_b, 30, doc, 100)
    assert [((k >> 32), (k & 0xFFFFFFFF) // 100, k % (1 << 32) % 100) for k in keys.tolist()] == sorted(want)
    assert times.tolist() == [want[k] for k in sorted(want)]


def test_squeeze():
    for x in ([], [0], [7, 1 << 31, 255, 256]):
        assert unsqueeze(squeeze(np.array(x, np.int64)), len(x)).tolist() == x


@pytest.mark.parametrize("pairs", [1, 300, 1 << 20])
def test_equals_brute_force(spark, plain, monkeypatch, pairs):
    monkeypatch.setattr(module, "BLOCK_PAIRS", pairs)       # the driver's value travels with the function's globals
    texts = odd_texts()[::2 if pairs == 1 else 1] + ["the same text of words"] * 30 + [t for t in TEXTS if t != LONG]
    want, seen = brute(plain, texts)
    df = docs(spark, texts)
    got = {r.doc_id: r for r in alignments(df, TOKENIZER, PIECES).collect()}
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == w, repr(texts[i])
    aligned = align(df, TOKENIZER, PIECES)
    assert {(r.a_id, r.b_id): r.n_docs for r in link_counts(aligned, vocabulary(PIECES)).collect()} == seen


def test_real_texts(spark, plain):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.collect()
    want, _ = brute(plain, [r.text for r in rows])
    got = {r.doc_id: tuple(r)[1:] for r in alignments(df, TOKENIZER, PIECES).collect()}
    for r, (n_a, n_b, n, links, best, total, sha) in zip(rows, want):
        assert got[r.doc_id] == (n_a, n_b, n, links, best, total, sha)


def test_edges(spark, plain):
    df = edge(spark)
    out = alignments(df, TOKENIZER, PIECES).collect()
    assert len(out) == df.count() and all(r.groups_sha256 == "" for r in out if not r.n_a)
    texts = [r.text for r in df.collect()]
    assert sorted(str(tuple(r)[1:]) for r in out) == sorted(str(w) for w in brute(plain, texts)[0])
    assert alignments(empty(spark), TOKENIZER, PIECES).count() == 0
    groups = {r.doc_id: r.groups for r in align(df, TOKENIZER, PIECES, with_groups=True).collect() if r.n_a}
    assert groups[4].count("|") == 1 and asked(align(df, TOKENIZER, PIECES)).where("n > 20").count() == 0
