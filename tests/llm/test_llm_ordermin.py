import hashlib
import statistics

from llm_cases import TEXTS, by_id, docs, edge, empty

from matchlab.llm.ordermin import fingerprint_edits, fingerprints


def contract(rows):
    """id -> n_chars, digest of the edited text."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        h = len(t) // 2
        out[i] = len(t), hashlib.sha256((t[:len(t) - h] + n[:h]).encode()).hexdigest()
    return out


def test_edits(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = by_id(fingerprint_edits(df))
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == contract([(r.doc_id, r.text) for r in df.collect()])
    own = {r.doc_id: r.fingerprint for r in fingerprints(df).collect()}
    assert all(own[i] == r.fingerprint for i, r in got.items())
    assert statistics.mean(r.near_edited for r in got.values()) > 0.25 and statistics.mean(r.near_next for r in got.values()) < 0.05


def test_edge(spark):
    df = docs(spark, TEXTS)
    got = by_id(fingerprint_edits(df))
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == contract(list(enumerate(TEXTS)))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())
    assert got[11].fingerprint == got[12].fingerprint and got[12].near_next == 1 and got[0].fingerprint == ""
    out = fingerprint_edits(edge(spark))
    assert out.count() == edge(spark).count() and fingerprint_edits(empty(spark)).count() == 0
    assert out.where("doc_id IS NULL").count() == 2


def test_one_document_follows_itself(spark):
    r = fingerprint_edits(docs(spark, ["one two three four"])).first()
    assert r.near_next == 1


def test_order_and_occurrences_count(spark):
    a = [f"w{i}" for i in range(300)]
    b = a[150:] + a[:150]                                   # the same k-mers but one, exchanged halves
    c = a[:140] + ["other"] * 20 + a[160:]                  # the same order, a few words less
    got = by_id(fingerprint_edits(docs(spark, [" ".join(a), " ".join(b), " ".join(c), "x y " * 3, "x y " * 5])))
    # near_next: 2 -> 1, 1 -> 0, 4 -> 3
    assert got[1].near_next < 0.9 and got[4].near_next < 1
    c_a = by_id(fingerprint_edits(docs(spark, [" ".join(a), " ".join(c)])))[1].near_next
    assert c_a > got[1].near_next


def test_selection_by_brute_force(spark):
    """Occurrence numbers and minima with Python's own sorting, from Spark's hashes."""
    from pyspark.sql import functions as F

    from matchlab.llm.ordermin import _PLACE, sketch
    text = " ".join(["a b c d e f g h"] * 4 + [f"q{i}" for i in range(80)] + ["a b a b a b c"])
    words = text.split()
    h = lambda *x: F.xxhash64(*x)
    one = [r[0] for r in spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").orderBy("i").select(h("w")).collect()]
    kmers = [r[0] for r in spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(one, one[1:]))], "i int, a bigint, b bigint").orderBy("i").select(h("a", "b")).collect()]
    kmers = [x >> 24 for x in kmers]
    numbered, seen = [], {}
    for i, x in enumerate(kmers):
        numbered.append((i, x, seen.get(x, 0)))
        seen[x] = seen.get(x, 0) + 1
    hashed = spark.createDataFrame(numbered, "i int, x bigint, n int").orderBy("i").select("i", h("x", "n").alias("h")).collect()
    bins = {}
    for r in hashed:
        bins.setdefault((r.h >> 58) & 63, []).append((r.h >> 24, r.i))
    want = {}
    for b, x in bins.items():
        want[b] = [v for v, _ in sorted(sorted(x)[:2], key=lambda y: y[1])]
    rows = [(b, *(v + [None])[:2]) for b, v in want.items()]
    tuples = {r.b: r.t & _PLACE for r in spark.createDataFrame(rows, "b int, x bigint, y bigint").select("b", F.when(F.col("y").isNull(), h("x")).otherwise(h("x", "y")).alias("t")).collect()}
    got = sketch(spark.createDataFrame([(text,)], "text string"), ["text"]).first().text_t
    assert {x >> 24: x & _PLACE for x in got} == tuples


def test_no_python_in_the_plan(spark):
    plan = fingerprint_edits(docs(spark, TEXTS).select("doc_id", "text").repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
