import random
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import TEXTS, by_id, docs, edge, empty

from matchlab.llm.minhash import BANDS, ROWS, Words, band_keys, components, drop_near_duplicates, intersections, minima, near_duplicates, shingle_sets


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, percent, size):
    sets = [shingles(t, size) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]) or rows[a][0] == rows[b][0]:
                top[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(rows):
        low[find(a)] = min(low.get(find(a), i), i)
    return {i: (len(sets[a]), low[find(a)]) for a, (i, _) in enumerate(rows)}


def same(df, percent=85, size=3):
    rows = [(r.doc_id, r.text) for r in df.collect() if r.doc_id is not None]
    want = brute(rows, percent, size)
    got = near_duplicates(df, percent, size)
    assert got.count() == df.count()
    for i, r in by_id(got).items():
        assert (r.component_id, r.kept) == (want[i][1], want[i][1] == i)


def near_copies(seed=5):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.randint(20, 120))]
        for _ in range(rnd.randint(1, 8)):
            own = list(base)
            for _ in range(rnd.randint(0, 6)):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            texts.append(" ".join(own))
    return texts


def test_driver_table(spark):
    same(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


@pytest.mark.parametrize("percent, size", [(85, 3), (80, 5)])
def test_near_copies(spark, percent, size):
    same(docs(spark, near_copies()), percent, size)


def test_one_large_group(spark):
    """A chain of texts: neighbours are linked, the ends far apart."""
    words = [f"w{i}" for i in range(400)]
    same(docs(spark, [" ".join(words[i:i + 100]) for i in range(0, 120, 2)]))


def test_edge(spark):
    same(edge(spark))
    got = near_duplicates(edge(spark)).collect()
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert near_duplicates(empty(spark)).count() == 0


def test_components_of_random_graphs(spark):
    rnd = random.Random(2)
    for n, m in ((40, 30), (60, 59)):
        pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] if m == 30 else [(i, i + 1) for i in rnd.sample(range(n - 1), n - 1)]
        top = {}
        for a, b in pairs:
            group = {a, b} | top.get(a, {a}) | top.get(b, {b})
            for x in group:
                top[x] = group
        got = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
        assert {r.node: r.comp for r in got} == {x: min(g) for x, g in top.items() if len(g) > 1}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_signatures_estimate_similarity():
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    a = [rnd.choice(words) for _ in range(600)]
    b = a[:450] + [rnd.choice(words) for _ in range(150)]
    sets = shingle_sets([" ".join(a), " ".join(b)], Words())
    true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    m = minima(sets)
    assert abs((m[0] == m[1]).mean() - true) < 0.15
    keys = band_keys(m)
    agree = (m[0] == m[1]).reshape(BANDS, ROWS).all(axis=1)
    assert ((keys[0] == keys[1]) == agree).all()


def test_sets_are_those_of_the_definition():
    for size in (3, 5):
        for t, s in zip(TEXTS[:9], shingle_sets([t or "" for t in TEXTS[:9]], Words(limit=2), size)):
            assert len(s) == len(shingles(t, size))
    by = defaultdict(set)
    for s in shingle_sets(["a b c", "A  b\tC\n", "a b", "b a", "a", "c b a"], Words()):
        by[tuple(s.tolist())].add(1)
    assert len(by) == 5


def test_stage(spark):
    df = docs(spark, near_copies())
    want = brute([(r.doc_id, r.text) for r in df.collect()], 80, 5)
    out = drop_near_duplicates(df, 80, 5)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == sorted(i for i, (_, c) in want.items() if c == i)
    assert drop_near_duplicates(edge(spark)).where("doc_id IS NULL").count() == 2


def test_intersections():
    rnd = np.random.RandomState(3)
    sets = [np.unique(rnd.randint(0, 60, rnd.randint(0, 50)).astype(np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) if i != j else None for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    for dense, step in ((16, 4096), (2, 7), (40, 5)):
        got = intersections(sets, dense, step)
        assert all(w is None or got[i, j] == w for i, row in enumerate(want) for j, w in enumerate(row))


def test_loose_group_in_blocks(spark, monkeypatch):
    """Copies with many edits: most pairs share buckets without a link."""
    from matchlab.llm import minhash
    monkeypatch.setattr(minhash._compare_blocks, "__defaults__", (16,))
    rnd = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(110):
        own = list(base)
        for _ in range(rnd.randint(2, 9)):
            own[rnd.randrange(120)] = f"x{rnd.randrange(40)}"
        texts.append(" ".join(own))
    same(docs(spark, texts))


def test_template_makes_no_pairs(spark):
    """Texts of one template, similarity 0.74, share buckets; only the links among them are paired."""
    from matchlab.llm import minhash
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base + [f"x{k}y{i}" for i in range(21)]) for k in range(60)]
    texts += [t.replace("w5 ", "v5 ") for t in texts[:10]]
    rnd.shuffle(texts)
    df = docs(spark, texts)
    same(df)
    left = spark.createDataFrame([(k, k, bytearray(s.tobytes())) for k, s in enumerate(shingle_sets(texts, Words()))], "node bigint, comp bigint, hashes binary")
    pairs = {(r.a, r.b) for r in minhash._candidates(left, 85).collect()}
    links = {tuple(sorted((i, j))) for i in range(70) for j in range(i) if texts[i].replace("v5 ", "w5 ") == texts[j].replace("v5 ", "w5 ")}
    assert {tuple(sorted(p)) for p in pairs} == links and len(links) == 10


def test_large_group_makes_rows_by_node(spark, monkeypatch):
    """Near copies that share their rarest shingles with many others: pairs aren't listed."""
    from matchlab.llm import minhash
    stored, counts = minhash._stored, []

    def count(edges):
        out = stored(edges)
        counts.append(out[1][0])
        return out

    monkeypatch.setattr(minhash, "_stored", count)
    rnd = random.Random(11)
    texts = []
    for k in range(160):
        own = [f"w{i}" for i in range(120)]
        for i in rnd.sample(range(2, 118, 3), 9):
            own[i] = "x"
        texts.append(" ".join(own))
    texts += [t.replace("w0 ", "v0 ") for t in texts[:20]]
    sets = [shingles(t, 3) for t in texts]
    want = {(i, j) for j in range(180) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    rows = [(k, k, bytearray(s.tobytes())) for k, s in enumerate(shingle_sets(texts, Words()))]
    left = spark.createDataFrame(rows, "node bigint, comp bigint, hashes binary").repartition(4)
    links = minhash._compare_blocks(left.select("node", "comp"), left.select("node", "hashes"), 85, 32).collect()
    assert {tuple(sorted((r.a, r.b))) for r in links} == want and len(want) >= 20
    assert max(counts) <= 6 * len(texts)
