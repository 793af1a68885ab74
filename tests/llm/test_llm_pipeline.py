import zlib

import numpy as np
import pytest
from llm_cases import docs, edge, empty
from test_llm_linededup import brute as lines
from test_llm_minhash import brute as near
from test_llm_suffixdedup import covered

import corpus_pipeline
from matchlab.llm.langid import BAND_GRAMS, BAND_TEXTS, predict, train
from matchlab.llm.packing import NAMES
from matchlab.session import materialize

SF = "/root/testdata/sf0.001"


def identified(df):
    """The language gate's rows, with medians of lists."""
    teach = {r.doc_id for r in df.collect() if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    langs, m = train(df.where(df.doc_id.isin(list(teach))))
    rows = [r for r in predict(df, langs, m, fit_col="fit").collect() if r.lang_pred != "und" and r.score >= 0.5]
    out = {}
    for lang in langs:
        fits = sorted(round(r.fit * 64) / 64 for r in rows if r.lang_pred == lang and r.doc_id in teach and r.fit_n >= BAND_GRAMS)
        low = lambda v: v[(len(v) - 1) // 2]
        mid = low(fits) if len(fits) >= BAND_TEXTS else None
        reach = max(2.0, 12 * 1.4826 * low(sorted(abs(x - mid) for x in fits))) if mid is not None else None
        out |= {r.doc_id: r.text for r in rows if r.lang_pred == lang
                and (mid is None or r.fit >= mid - reach * max(1.0, (BAND_GRAMS / r.fit_n) ** 0.5))}
    return out


def test_stages_in_order():
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "substring_dedup", "packing"]


def test_each_stage_against_brute_force(spark):
    """The decisions on the whole table, stage by stage."""
    now = spark.read.parquet(f"{SF}/documents.parquet")
    columns = now.columns
    texts = {i: t for i, t in identified(now).items()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        if name == "line_dedup":
            texts = {i: w[3] for i, w in lines(list(texts.items()), 2).items() if not w[1] or w[3].strip()}
        elif name == "near_dedup":
            kept = near(list(texts.items()), 80, 5)
            texts = {i: t for i, t in texts.items() if kept[i][1] == i}
        elif name == "substring_dedup":
            left = {}
            for (i, t), gone in zip(texts.items(), covered([t.encode() for t in texts.values()], 200)):
                x = np.frombuffer(t.encode(), np.uint8)[~gone].tobytes().decode(errors="ignore")
                if x or not gone.any():
                    left[i] = x
            texts = left
        now = materialize(stage(spark, now, SF), "stage-test")
        assert now.columns == columns
        rows = now.collect()
        assert {r.doc_id: r.text for r in rows} == texts, name
        assert all(r.n_chars == len(r.text) for r in rows) or name == "language_id"
    packed = corpus_pipeline.STAGES[4][1](spark, now, SF)
    assert packed.columns == NAMES and {r.doc_id for r in packed.collect()} == set(texts)
    whole = corpus_pipeline.run(spark, SF)
    assert {tuple(r)[:5] for r in whole.collect()} == {tuple(r)[:5] for r in packed.collect()}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_edge(spark, name, stage):
    df = edge(spark)
    assert stage(spark, df, SF).columns == (NAMES if name == "packing" else df.columns)
    assert stage(spark, empty(spark), SF).count() == 0
    stage(spark, df, SF).collect()


def test_clean_documents_stay(spark):
    df = docs(spark, [f"A clean document number {i} has words that no other one has like w{i}x and w{i}y in it." for i in range(20)])
    now = df
    for _, stage in corpus_pipeline.STAGES[:4]:
        now = materialize(stage(spark, now, SF), "stage-test")
    assert {(r.doc_id, r.text) for r in now.collect()} == {(r.doc_id, r.text) for r in df.collect()}


def test_other_columns_travel_along(spark):
    """Columns with the names of the stages' own counts keep their values."""
    rows = [(i, f"line one of {i}\nthe same two lines\nstand in every text\n" + "shared words go on and on " * 12 + f"end {i}", "en", "s", 1, f"k{i}", i * 7, f"l{i}", -i) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, n_removed bigint, n_lines string, n_spans bigint")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns
        for r in out.collect():
            assert (r.kept, r.n_removed, r.n_lines, r.n_spans) == (f"k{r.doc_id}", r.doc_id * 7, f"l{r.doc_id}", -r.doc_id), name


def test_run_leaves_others_tables(spark):
    """A result of another caller can be read after the pipeline has run."""
    from matchlab.llm.minhash import near_duplicates
    df = docs(spark, ["some words that are here twice"] * 2 + ["and others that are not here again"])
    result = near_duplicates(df)
    corpus_pipeline.run(spark, SF)
    assert result.count() == 3
