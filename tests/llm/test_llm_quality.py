import math
import random
from collections import Counter

import numpy as np
from llm_cases import TEXTS, by_id, docs, edge, empty

from matchlab.llm import quality
from matchlab.llm.letters import SYMBOLS, Sums, grams, table
from matchlab.llm.quality import ORDER, discounts, expand, judge, model_arrays, symbols


def base(text):
    text = text or ""
    w = text.encode().split()
    seen, dup = set(), 0
    for x in text.split("\n"):
        if x.encode().split():
            dup += x in seen
            seen.add(x)
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if c[w[i], w[i + 1], w[i + 2]] > 1 for k in (i, i + 1, i + 2)}
    n = len(covered)
    return len(w), sum(len(x.decode()) for x in w), sum(x in "#*$%&|<>" for x in text), dup, n, len(w) < 50 or 100 * n > 50 * len(w)


def same(df):
    rows = judge(df).collect()
    assert len(rows) == df.count()
    want = {r.doc_id: base(r.text) for r in df.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id]
            assert not (r.base_failed and r.kept)
    return {r.doc_id: r for r in rows}


def test_driver_table(spark):
    got = same(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    passed = [r for r in got.values() if not r.base_failed]
    assert sum(r.kept for r in passed) > 0.9 * len(passed)


def test_edge(spark):
    same(edge(spark, [(i, "a b c a b c\n" * 30, "en", None, None, *[None] * 11) for i in (100, 101)]))
    assert judge(empty(spark)).count() == 0


def test_bands_reject_other_text(spark):
    rnd = random.Random(9)
    syllables = ["ba", "to", "rin", "ka", "sel", "mo", "ten", "lu"]
    texts = [" ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(200)) for _ in range(80)]
    texts.append(" ".join("".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(200)))
    got = by_id(judge(docs(spark, texts)))
    assert not got[80].kept and not got[80].base_failed and sum(got[i].kept for i in range(80)) >= 78


def test_languages_have_their_own_bands(spark):
    rnd = random.Random(9)
    make = lambda s: " ".join("".join(rnd.choice(s) for _ in range(3)) for _ in range(150))
    texts = [make(["ba", "to", "rin", "el"]) for _ in range(30)] + [make(["xu", "qi", "ze", "yk"]) for _ in range(30)]
    got = by_id(judge(docs(spark, texts, ["a"] * 30 + [None] * 30)))
    assert len({(r.low, r.high) for r in got.values()}) == 2 and sum(r.kept for r in got.values()) >= 58


def test_kneser_ney_by_brute_force():
    text = symbols("the cat and the hat and the rat that sat on the mat " * 3)
    s = Sums()
    s.add(grams(text, ORDER)[ORDER - 1:])
    got = expand(model_arrays([s]), 0)
    p = np.exp(got.astype(float)).reshape(-1, SYMBOLS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)

    full = Counter(tuple(text[i - ORDER + 1:i + 1].tolist()) for i in range(ORDER - 1, len(text)))
    levels = {ORDER: full}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def prob(g):
        if not g:
            return 1 / SYMBOLS
        c = levels[len(g)]
        d = discounts(np.array(list(c.values())))
        own = {k: v for k, v in c.items() if k[:-1] == g[:-1]}
        total = sum(own.values())
        if not total:
            return prob(g[1:])
        return max(c[g] - d[min(c[g], 3)], 0) / total + sum(d[min(v, 3)] for v in own.values()) / total * prob(g[1:])

    for g in [*list(full)[:20], (1, 2, 3, 4), (20, 8, 5, 0), (0, 0, 0, 1)]:
        code = sum(x << 5 * (len(g) - 1 - k) for k, x in enumerate(g))
        assert math.isclose(math.exp(got[code]), prob(tuple(g)), rel_tol=1e-4)


def test_symbols():
    assert symbols("Ab  \n c1!")[ORDER - 1:].tolist() == [1, 2, 0, 3, 30, 31] and len(symbols("")) == ORDER - 1
    assert table().max() < SYMBOLS and base(TEXTS[6])[0] == 7


def test_any_number_of_languages(spark, monkeypatch):
    """More models than may be broadcast: the other languages are scored by groups, with the same numbers."""
    rnd = random.Random(4)
    make = lambda s: " ".join("".join(rnd.choice(s) for _ in range(3)) for _ in range(rnd.randint(40, 120)))
    texts, langs = [], []
    for k in range(9):
        letters = rnd.sample("abcdefghijklmnopqrstuvwxyz", 6)
        texts += [make(letters) for _ in range(4 + k)] + ["", None]
        langs += [None if k == 3 else f"l{k}"] * (6 + k)
    df = docs(spark, texts, langs)
    want = sorted(map(tuple, judge(df).collect()))
    monkeypatch.setattr(quality, "MODEL_MB", 0)
    assert sorted(map(tuple, judge(df).collect())) == want and len(want) == len(texts)      # none broadcast; failed before
    monkeypatch.setattr(quality, "MODEL_MB", 256)
    monkeypatch.setattr(quality, "LANGS", 2)
    monkeypatch.setattr(quality, "GROUP_GRAMS", 1000)
    assert sorted(map(tuple, judge(df).collect())) == want      # two broadcast, the others in several groups each


def test_model_bytes_is_a_bound():
    for n in (1, 50, 5000, 200_000):
        s = Sums()
        s.add(np.random.default_rng(n).integers(0, SYMBOLS**ORDER, n).astype(np.uint32))
        assert sum(a.nbytes for a in model_arrays([s])) <= quality.model_bytes(len(s.codes))


def test_other_scripts_have_bands(spark):
    """Random Cyrillic letters against Cyrillic syllables; all letters but a-z were three symbols."""
    rnd = random.Random(9)
    syllables = ["ба", "то", "рин", "ка", "сел", "мо", "тен", "лу"]
    texts = [" ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(200)) for _ in range(80)]
    texts.append(" ".join("".join(rnd.choice("бвгджзклмнпрстфхцчшщаеиоу") for _ in range(5)) for _ in range(200)))
    texts.append(" ".join("".join(rnd.sample(w, len(w))) for w in texts[0].split()))        # shuffled letters
    got = by_id(judge(docs(spark, texts, ["ru"] * 82)))
    assert not got[80].kept and not got[81].kept and sum(got[i].kept for i in range(80)) >= 78      # all kept before


def test_letters_by_brute_force(spark, monkeypatch):
    """Every document's log-perplexity from the two models, written anew, in blocks of a few documents."""
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choice("abéèж1!，𝒳") for _ in range(rnd.randint(1, 4))) for _ in range(60)) for _ in range(9)]
    langs = ["x"] * 6 + [None] * 3
    monkeypatch.setattr(quality, "BLOCK_EVENTS", 300)
    got = by_id(judge(docs(spark, texts, langs)))
    known = set("abcdefghijklmnopqrstuvwxyz ")
    grams4, logs = Counter(), {}
    for i, (t, lang) in enumerate(zip(texts, langs)):
        s = Sums()
        for j in range(9):
            if langs[j] == lang:
                s.add(grams(symbols(texts[j]), ORDER)[ORDER - 1:])
        own = expand(model_arrays([s]), 0)[grams(symbols(t), ORDER)[ORDER - 1:]]
        c = "   " + t
        logs[i] = []
        for k in range(3, len(c)):
            clean = set(c[k - 3:k]) <= known
            kind = table()[ord(c[k])] if clean else "any"
            if not clean or c[k] not in known:
                grams4[lang, kind, c[k - 3:k + 1]] += 1
                logs[i].append((lang, kind, c[k - 3:k + 1]))
            if clean:
                logs[i].append(float(own[k - 3]))
    levels = {4: grams4}
    for n in (3, 2, 1):
        levels[n] = Counter((x, k, g[1:]) for x, k, g in levels[n + 1])
    d = {n: discounts(np.array(list(levels[n].values()))) for n in levels}

    def prob(lang, kind, g):
        n = len(g)
        own = {x: v for x, v in levels[n].items() if x[:2] == (lang, kind) and x[2][:-1] == g[:-1]}
        below = prob(lang, kind, g[1:]) if n > 1 else 1 / (len(own) + 1)
        v = levels[n][lang, kind, g]
        return (v - d[n][min(v, 3)]) / sum(own.values()) + sum(d[n][min(x, 3)] for x in own.values()) / sum(own.values()) * below

    p = {x: math.log(prob(*x)) for x in grams4}
    for i, own in logs.items():
        assert math.isclose(got[i].log_ppl, -sum(p[x] if isinstance(x, tuple) else x for x in own) / len(texts[i]), rel_tol=1e-6)
