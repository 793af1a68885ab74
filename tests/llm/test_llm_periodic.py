import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_cases import LONG, TEXTS, by_id, docs, edge, empty

from matchlab.llm.periodic import find_runs, nearest_less, number, periodic_tails, run_digests, runs_of

WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(w, least=6, exponent=4):
    """All maximal stretches of every period, the smallest period of each."""
    found = {}
    n = len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, exponent * q):
                found.setdefault((s, i + q - s), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute(doc_id, text):
    w = WORDS.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *(top if top else (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def made(words, **more):
    symbols, ends = number(words)
    begin, length, period = runs_of(symbols, ends, **more)
    starts = np.concatenate([[0], ends + 1])
    out = [[] for _ in words]
    for b, n, p in zip(begin, length, period):
        k = int(np.searchsorted(starts, b, side="right")) - 1
        out[k].append((int(b - starts[k]), int(n), int(p)))
    return [sorted(x) for x in out]


@pytest.mark.parametrize("least,exponent", [(6, 4), (2, 2), (5, 3)])
def test_runs_equal_brute_force(least, exponent):
    rnd = random.Random(least)
    words = [[rnd.choice("abcd"[:rnd.randint(1, 4)]) for _ in range(rnd.randint(0, 60))] for _ in range(400)]
    for _ in range(100):
        unit = [rnd.choice("abc") for _ in range(rnd.randint(1, 9))]
        words.append([rnd.choice("abc") for _ in range(rnd.randint(0, 9))] + unit * rnd.randint(1, 9) + unit[:rnd.randint(0, len(unit))] + ["b"])
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    words += [list(fib[-1]), ["a"] * 700, list("ab" * 300), list("aab" * 100 + "aabb" * 90), []]
    assert made(words, least=least, exponent=exponent) == [brute_runs(w, least, exponent) for w in words]
    assert made([], least=6, exponent=4) == [] and made([[]], least=6, exponent=4) == [[]]


def test_nearest_less():
    rnd = random.Random(2)
    for _ in range(200):
        v = np.array([rnd.randint(0, 4) for _ in range(rnd.randint(1, 40))])
        left, right = nearest_less(v, len(v))
        for k, x in enumerate(v):
            a = b = k
            while a > 0 and v[a - 1] > x:
                a -= 1
            while b + 1 < len(v) and v[b + 1] >= x:
                b += 1
            assert (left[k], right[k]) == (a, b)


def test_long_text():
    w = ("x y z " * 3 + "u v ").split() * 5000 + [str(i) for i in range(20000)] + ["q"] * 30000
    got, = made([w], least=6, exponent=4)
    assert (0, 55000, 11) in got and (75000, 30000, 1) in got and len(got) == 2


def test_digests_equal_brute_force(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["a", "b", "c d", "é\n"]) for _ in range(rnd.randint(0, 80))) for _ in range(200)]
    texts += ["go " * 50, " ".join(["x y\tz"] * 9) + " end", *[t for t in TEXTS if t != LONG]]
    got = by_id(run_digests(docs(spark, texts)))
    for i, t in enumerate(texts):
        assert tuple(got[i])[1:] == brute(i, t), (i, t)


def test_real_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = by_id(run_digests(df))
    rows = df.collect()
    assert len(got) == len(rows) and any(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in rows)
    for r in rows:
        if len(WORDS.findall(r.text or "")) < 3000:
            assert tuple(got[r.doc_id])[1:] == brute(r.doc_id, r.text)
    assert sum(r.n_runs > 0 for r in got.values()) > 5


def test_edges(spark):
    df = edge(spark)
    out = find_runs(df).collect()
    assert len(out) == df.count() and {r.n_words for r in out if r.collapsed == ""} == {0}
    assert run_digests(empty(spark)).count() == 0 and find_runs(empty(spark)).columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert {r.text for r in periodic_tails(df).collect()} >= {"", "one", "null id text with words"}
    digests = run_digests(df).collect()
    assert len(digests) == df.count() and all(r.runs_sha256 and r.collapsed_sha256 for r in digests)
