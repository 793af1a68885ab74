import hashlib
import random

import numpy as np
import pytest
from llm_cases import by_id, docs, edge, empty

from matchlab.llm.linededup import dedup_lines, drop_repeated_lines, line_hashes, select, window_hashes


def brute(rows, run, alone=200):
    """id -> n_lines, n_removed, n_runs, kept text."""
    first, lines = {}, {i: (t or "").split("\n") for i, t in rows}
    solid = {i: [k for k, x in enumerate(x) if x.strip(" \t\r\x0b\x0c")] for i, x in lines.items()}
    wins = lambda i: [(s, tuple(lines[i][k] for k in solid[i][s:s + n])) for n in (run, 1) for s in range(len(solid[i]) - n + 1)
                      if n == run or len(lines[i][solid[i][s]]) >= alone]
    for i in sorted(lines):
        for s, w in wins(i):
            first.setdefault(w, (i, s))
    out = {}
    for i in lines:
        gone = {k for s, w in wins(i) if first[w] != (i, s) for k in range(s, s + len(w))}
        cut = {solid[i][k] for k in gone}
        out[i] = len(lines[i]), len(gone), sum(k - 1 not in gone for k in gone), "\n".join(x for k, x in enumerate(lines[i]) if k not in cut)
    return out


def some_texts(seed, n=40):
    rnd = random.Random(seed)
    pool = [f"line {k} " * rnd.randint(1, 3) for k in range(14)] + ["", "  "]
    return ["\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_brute_force(spark, run):
    df = docs(spark, some_texts(run))
    want = brute([(r.doc_id, r.text) for r in df.collect()], run)
    assert {i: (r.n_lines, r.n_removed, r.n_runs, r.text) for i, r in by_id(dedup_lines(df, run)).items()} == want


@pytest.mark.parametrize("run, alone", [(1, 9), (2, 15), (3, 8), (9, 1)])
def test_lines_alone(spark, run, alone):
    df = docs(spark, some_texts(10 * run))
    want = brute([(r.doc_id, r.text) for r in df.collect()], run, alone)
    assert {i: (r.n_lines, r.n_removed, r.n_runs, r.text) for i, r in by_id(dedup_lines(df, run, alone)).items()} == want


def test_no_long_line_stays_twice(spark):
    """Lengths count code points; a line one short of the limit stays; a line twice in one text goes, too."""
    long, short = "ж" * 200, "ж" * 199
    out = by_id(dedup_lines(docs(spark, [f"{long}\na\n{short}", f"b\n{long}\nc", f"{short}\nd\n{long}\ne\n{long}", long])))
    assert [out[i].text for i in range(4)] == [f"{long}\na\n{short}", "b\nc", f"{short}\nd\ne", ""]
    assert [out[i].n_runs for i in range(4)] == [0, 1, 2, 1]


def test_hash_halves():
    h = line_hashes(["a", "b", "a", "b"])
    assert (window_hashes(h, 2)[0] == window_hashes(h, 2)[2]).all() and len({tuple(x) for x in window_hashes(h, 2).tolist()}) == 2
    assert not set(window_hashes(h, 1).ravel().tolist()) & set(h.ravel().tolist())


def test_driver_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()], 2)
    assert {i: (r.n_lines, r.n_removed, r.n_runs, r.text) for i, r in by_id(dedup_lines(df)).items()} == want


def test_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from matchlab.llm.queries import QUERIES, SQL
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    cur = con.execute(SQL["op10_line_dedup"])
    names = [d[0] for d in cur.description]
    want = {r[names.index("doc_id")]: dict(zip(names, r)) for r in cur.fetchall()}
    got = {r.doc_id: r.asDict() for r in QUERIES["op10_line_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_winnowing_guarantee():
    rnd = np.random.RandomState(0)
    for run in (1, 2, 3, 4):
        h = rnd.randint(0, 6, 60).astype(np.uint64)
        at = select(h, run)
        for s in range(len(h) - run + 1):
            assert s <= at[s] < s + run and h[at[s]] == h[s:s + run].min()


def test_edge(spark):
    out = dedup_lines(edge(spark))
    assert out.count() == edge(spark).count()
    got = by_id(out)
    assert got[0].text == "" and got[3].n_removed == 0 and got[10].text == "the same line\nanother line\n"
    assert dedup_lines(empty(spark)).count() == 0
    stage = drop_repeated_lines(edge(spark))
    assert stage.columns == edge(spark).columns


def test_equal_rows_are_one_document(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "x\na\nb"), (None, "a\nb\nq"), (None, "a\nb\nq")]
    out = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()
    assert sorted((r.doc_id or 9, r.text) for r in out) == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "x"), (9, "q"), (9, "q")]


def test_stage_drops_empty_and_updates_length(spark):
    out = by_id(drop_repeated_lines(docs(spark, ["a\nb", "a\nb", "a\nb\nlong line", ""])))
    assert {i: (r.text, r.n_chars) for i, r in out.items()} == {0: ("a\nb", 3), 2: ("long line", 9), 3: ("", 0)}


def test_digest_columns(spark):
    from matchlab.llm.queries import QUERIES
    q = QUERIES["op10_line_dedup"](spark, "/root/testdata/sf0.001")
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()], 2)
    assert {r.doc_id: r.kept_sha256 for r in q.collect()} == {i: hashlib.sha256(w[3].encode()).hexdigest() for i, w in want.items()}
