import math
import zlib
from collections import Counter

import numpy as np
from llm_cases import TEXTS, by_id, docs, edge, empty

from matchlab.llm import suffixtree
from matchlab.llm.letters import Sums
from matchlab.llm.minhash import Words
from matchlab.llm.suffixtree import DEPTH, SYMBOLS, Tokens, grow, lm_scores


def brute(rows):
    """doc_id -> held_out, n_tokens, n_known, train_tokens, base_score."""
    end = object()
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 if i is not None else False for i, _ in rows}
    token = lambda t: [*(t or "").encode().lower().split(), end]
    c = Counter(x for i, t in rows if not out[i] for x in token(t))
    n, v = sum(c.values()), len(c)
    return {i: (out[i], len(token(t)), sum(x in c for x in token(t)), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in token(t))) for i, t in rows}


def same(df, rows):
    got, want = by_id(lm_scores(df)), brute(rows)
    for i, w in want.items():
        if i is not None:
            r = got[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
            assert abs(r.base_score - w[4]) <= 1e-9 * abs(w[4])
            assert r.score < 0
    return got


def test_base_and_gain(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = same(df, [(r.doc_id, r.text) for r in df.collect()])
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edge(spark):
    df = edge(spark)
    same(df, [(r.doc_id, r.text) for r in df.collect()])
    assert lm_scores(df).count() == df.count() and lm_scores(empty(spark)).count() == 0
    only = docs(spark, TEXTS).where("crc32(cast(cast(doc_id as string) as binary)) % 10 = 0")      # nothing to learn from
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in lm_scores(only).collect())


def test_equal_texts_score_equal(spark):
    got = by_id(lm_scores(docs(spark, TEXTS)))
    assert got[11].score == got[12].score


def tree_of(texts, frequent):
    t = Tokens(texts, Words())
    s = t.symbols(frequent)
    found = Sums()
    found.add((t.contexts(s) * SYMBOLS + s).astype(np.uint32))
    return t, s, grow(found)


def test_contexts_stay_in_their_document():
    t, s, _ = tree_of(["a b c", "", "d e"], np.empty(0, np.uint64))
    want = []
    for k, n in zip(t.starts, t.sizes):
        own = s[k:k + n].tolist()
        for i in range(n):
            before = ([0] * DEPTH + own[:i])[-DEPTH:]
            want.append(sum(x * SYMBOLS ** (DEPTH - 1 - j) for j, x in enumerate(before)))
    assert t.contexts(s).tolist() == want


def test_states_and_distributions():
    rnd = np.random.RandomState(1)
    texts = [" ".join(rnd.choice(["a", "b"], 400)) for _ in range(30)]                 # no memory: the suffixes do
    texts += [" ".join(["x", "y", "z"] * 200) for _ in range(10)]                      # x y z x y z ..
    t, s, (longest, states, root) = tree_of(texts, np.empty(0, np.uint64))
    assert np.allclose((10.0 ** states).sum(axis=1), 1, atol=1e-4)
    x, y, z = (s[t.starts[-1] + k] for k in range(3))
    assert states[longest[x * SYMBOLS + y], z] > math.log10(0.9)
    assert root.sum() == len(s)
    # every retained context diverges, or one that it is the suffix of does; a deeper state implies its suffixes
    one = np.unique(longest[np.arange(SYMBOLS ** DEPTH) % SYMBOLS + 0 * SYMBOLS])
    assert len(one) > 1


def test_token_probabilities_sum_to_one(spark):
    """Over the known words, the end and one word never met, in one context."""
    words = [f"w{i}" for i in range(200)]
    train = [w for w in words for _ in range(3)]
    base = docs(spark, [" ".join(train)] * 9)
    probe = ["", *words, "never-met-word"]
    rows = [(i, " ".join(train)) for i in range(1, 10)]
    free = [i for i in range(1000, 9000) if zlib.crc32(str(i).encode()) % 10 == 0][:len(probe)]
    df = spark.createDataFrame(rows + list(zip(free, probe)), "doc_id bigint, text string").repartition(3)
    got = by_id(lm_scores(df))
    # score("w") = p(w | start) * p(end | w); compare through documents "w" and the tree's own sums instead
    assert all(math.isfinite(got[i].score) for i in free) and base.count() == 9
    assert sum(10 ** got[i].score for i in free) <= 1 + 1e-9


def test_held_out_texts_beat_a_word_bigram(spark):
    """-3.294 a token for a word bigram with 20 pseudo-counts; without contexts of words it was -3.859."""
    rows = [r for r in lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect() if r.held_out]
    assert sum(r.score for r in rows) / sum(r.n_tokens for r in rows) > -3.294


def tokens_with_logs(spark, monkeypatch, df, depth):
    """doc_id -> each token's natural log-probability."""
    with monkeypatch.context() as m:
        m.setattr(suffixtree, "WORD_DEPTH", depth)
        m.setattr(suffixtree, "finish", lambda state, tokens: state)
        out = {}
        for r in lm_scores(df).collect():
            logs, _ = suffixtree.opened(r.asDict(), sum(r.sizes))
            for i, own in zip(r.doc_id, np.split(logs.astype(float) * math.log(10), np.cumsum(r.sizes)[:-1])):
                out[i] = own.tolist()
        return out


def test_word_contexts_by_brute_force(spark, monkeypatch):
    rnd = np.random.RandomState(3)
    words = [f"w{i}" for i in range(30)]
    chain = {(a, b): rnd.choice(words, 2).tolist() for a in words for b in words}
    texts = []
    for _ in range(60):
        t = rnd.choice(words, 2).tolist()
        while len(t) < 40:
            t.append(rnd.choice(chain[t[-2], t[-1]]))
        texts.append(" ".join(t))
    df = docs(spark, texts)
    split = {r.doc_id: [*r.text.split(), "end"] for r in df.select("doc_id", "text").collect()}
    train = [i for i in split if zlib.crc32(str(i).encode()) % 10]
    logs = tokens_with_logs(spark, monkeypatch, df, 0)
    bar = math.log(sum(len(split[i]) for i in train)) / 2
    n = Counter(w for i in train for w in split[i])
    open_ = {(i, k) for i, t in split.items() for k in range(1, len(t)) if n[t[k - 1]] >= 2}
    kept_at = []
    for depth in range(1, 4):
        c, gain, after = Counter(), Counter(), {}
        key = lambda i, k: tuple(split[i][k - depth:k])
        for i, k in sorted(open_):
            if i in train:
                c[key(i, k), split[i][k]] += 1
                gain[key(i, k)] -= logs[i][k]
        for (s, w), v in c.items():
            after.setdefault(s, Counter())[w] = v
        kept = {s for s, x in after.items() if (total := sum(x.values())) >= 2
                and gain[s] + sum(v * math.log(v / total) for v in x.values()) > max(len(x) - 1, 1) * bar}
        kept_at.append(len(kept))
        counted = {(i, k): after.get(key(i, k), {}).get(split[i][k], 0) for i, k in open_}
        for i, k in {(i, k) for i, k in open_ if key(i, k) in kept}:
            x = after[key(i, k)]
            logs[i][k] = math.log((x[split[i][k]] + len(x) * math.exp(logs[i][k])) / (sum(x.values()) + len(x)))
        open_ = {(i, k) for i, k in open_ if k > depth and counted.get((i, k - 1), 0) >= 2}
        got = tokens_with_logs(spark, monkeypatch, df, depth)
        for i, own in logs.items():
            assert np.allclose(own, got[i], atol=1e-4), (depth, i)
    assert kept_at[1]


def test_texts_that_occur_twice_score_apart(spark):
    rnd = np.random.RandomState(8)
    texts = [" ".join(f"{rnd.choice(list('abcdefgh'))}{rnd.randint(400)}" for _ in range(80)) for _ in range(60)]
    twice = [i for i in range(60, 90) if zlib.crc32(str(i).encode()) % 10]
    got = by_id(lm_scores(docs(spark, texts + texts[:30])))
    a = [got[i].score / got[i].n_tokens for i in twice]
    b = [got[i].score / got[i].n_tokens for i in range(30, 60)]
    assert np.mean(a) > np.mean(b) + 0.5
