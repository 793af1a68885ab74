import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import by_id, docs, edge, empty

from matchlab.llm.induced import repeats
from matchlab.llm.suffixdedup import anchors, dedup_digests, drop_repeats, gram_hashes, remove_repeats


def covered(pieces, length):
    c = Counter(p[i:i + length] for p in pieces for i in range(len(p) - length + 1))
    out = []
    for p in pieces:
        gone = np.zeros(len(p), bool)
        for i in range(len(p) - length + 1):
            if c[p[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(gone)
    return out


def some_pieces(rnd):
    letters = rnd.choice(["ab", "abc", "a", "abcdefgh"])
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))).encode() for _ in range(rnd.randint(1, 6))]
    return out + [out[0][:30] + b"x" + out[0][5:]] * rnd.randint(0, 2)


@pytest.mark.parametrize("memory", [3, 1 << 20])
def test_induced_sorting_finds_all_repeats(memory):
    """With a queue that spills at three entries, too."""
    rnd = random.Random(memory)
    for _ in range(120):
        pieces, length = some_pieces(rnd), rnd.choice([3, 4, 8, 20])
        for spans, want in zip(repeats(pieces, length, memory), covered(pieces, length)):
            got = np.zeros(len(want), bool)
            for a, b in spans:
                got[a:b] = True
            assert (got == want).all()
    assert repeats([], 5) == [] and len(repeats([b""], 5)[0]) == 0


def test_anchors_are_guaranteed():
    rnd = random.Random(1)
    for letters in ("ab", "abcdefghijkl", "a"):
        data = "".join(rnd.choice(letters) for _ in range(400)).encode()
        at, _ = anchors(data, 30, 7)
        inside = {i: {int(p) - i for p in at if i <= p <= i + 30 - 7} for i in range(len(data) - 30 + 1)}
        assert all(inside.values())
        by = {}
        for i, x in inside.items():     # equal strings share an anchor at the same place in them
            by.setdefault(data[i:i + 30], []).append(x)
        assert all(set.intersection(*x) for x in by.values())
    h = gram_hashes(np.frombuffer(b"abcabcab", np.uint8), 5)
    assert h[0] == h[3] and len(h) == 4 and len(set(h.tolist())) == 3


def same(df, length):
    rows = [((r.doc_id, k), (r.text or "").encode()) for k, r in enumerate(df.collect())]
    want = Counter()
    for (i, _), p, gone in zip([x for x, _ in rows], [p for _, p in rows], covered([p for _, p in rows], length)):
        kept = np.frombuffer(p, np.uint8)[~gone].tobytes()
        want[i, len(p), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(map(tuple, dedup_digests(df, length).collect())) == want


def test_driver_table(spark):
    same(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), 200)


def test_planted(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij é") for _ in range(rnd.randint(2, 9)))
    shared = [" ".join(word() for _ in range(n)) for n in (20, 40, 60, 60)]
    texts = []
    for k in range(60):
        own = [" ".join(word() for _ in range(rnd.randint(0, 40))) for _ in range(3)]
        texts.append(own[0] + rnd.choice(shared) + own[1] + (rnd.choice(shared) if k % 3 else "") + own[2])
    texts += [texts[0]] * 3 + [texts[1][:-20] + "!" + texts[1][10:], "z" * 900, "z" * 250, "xy" * 300]
    same(docs(spark, texts), 60)
    same(docs(spark, texts), 200)


def test_edge(spark):
    df = edge(spark)
    same(df, 200)
    same(df, 60)
    assert dedup_digests(empty(spark)).count() == 0
    assert [c for c in remove_repeats(df).columns if c in ("uid", "gid", "source")] == ["source", "uid", "gid"]


def test_stage(spark):
    a, b = "é" * 150, "unlike text " * 3
    df = docs(spark, [a + b, a, b, None, ""])
    out = drop_repeats(df)
    assert out.columns == df.columns
    got = by_id(out)
    assert set(got) == {0, 2, 3, 4} and got[0].text == b and got[0].n_chars == len(b) and got[2].text == b and got[3].text is None


def test_common_phrase_goes_to_no_shard(spark, monkeypatch):
    """A phrase shorter than the length with other text around it in every document, and a longer one."""
    from matchlab.llm import suffixdedup
    monkeypatch.setattr(suffixdedup, "HOT", 8, raising=False)
    most, plain = [], suffixdedup.shard_repeats

    def spy(pieces, length):
        most.extend(r["count"] for r in pieces.groupBy("shard").count().collect())
        return plain(pieces, length)

    monkeypatch.setattr(suffixdedup, "shard_repeats", spy)
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("abcdefghij é") for _ in range(n))
    short, long = text(70), text(230)
    texts = [text(rnd.randint(0, 200)) + short + text(rnd.randint(0, 200)) for _ in range(30)]
    texts += [text(rnd.randint(0, 90)) + long[rnd.randint(0, 30):] + text(rnd.randint(0, 90)) for _ in range(30)]
    same(docs(spark, texts), 200)
    assert not most or max(most) <= 8


def test_short_phrase_makes_no_pieces(spark, monkeypatch):
    """Contexts that have only a phrase in common that is shorter than any core hold no
    repeat; those that share a core are held against each other."""
    from matchlab.llm import suffixdedup
    seen, plain = [], suffixdedup.shard_repeats

    def spy(pieces, length):
        seen.append({r.row for r in pieces.select("row").distinct().collect()})
        return plain(pieces, length)

    monkeypatch.setattr(suffixdedup, "shard_repeats", spy)
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdefghij é") for _ in range(n))
    short, long = text(60), text(230)
    same(docs(spark, [text(rnd.randint(150, 300)) + short + text(rnd.randint(150, 300)) for _ in range(40)]), 200)
    assert not seen[-1]
    same(docs(spark, [text(150) + short + text(150) for _ in range(20)] + [text(150) + long[rnd.randint(0, 20):] + text(150) for _ in range(5)]), 200)
    assert len(seen[-1]) == 5


def test_equal_strings_share_a_core():
    """The bits that choose contexts: where two texts have a string in common, anchors in both agree in the string's part."""
    from matchlab.llm.suffixdedup import PARTS, core_hashes, part_bounds, selected
    rnd, wide = random.Random(3), 64 // PARTS
    text = lambda n: bytes(rnd.choice(b"abcdefghij") for _ in range(n))
    for length, k in ((200, 40), (30, 7), (12, 12), (13, 12)):
        bounds = part_bounds(length, k)
        for _ in range(60):
            s, found = text(length), []
            for _ in range(2):
                before = text(rnd.randint(0, length))
                data = before + s + text(rnd.randint(0, length))
                at, h = selected(data, length, k)
                bits = core_hashes(at, h, length, k).view(np.uint64)
                found.append({int(p) - len(before): [int(x) >> wide * j & (1 << wide) - 1 for j in range(PARTS)] for p, x in zip(at, bits)})
            both = [p for p in found[0].keys() & found[1].keys() if 0 <= p <= length - k]
            assert both
            for p in both:
                own = [j for j in range(PARTS) if bounds[j] <= p <= bounds[j + 1]]
                assert own and all(found[0][p][j] == found[1][p][j] != 0 for j in own)
