"""The pipeline: each stage against what it promises, on its own input."""

import pytest

import corpus_pipeline
from covspark.llm import mixing

from .test_decontaminate import plain as leaks
from .test_line_dedup import plain as lines
from .test_ngram_join import plain as groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out[name] = docs
    return out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_join", "decontaminate", "mix"]
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_language_keeps_documents_with_letters(stages):
    want = [(d, t) for d, t in pairs(stages["documents"]) if t and any(c.isalpha() for c in t)]
    assert pairs(stages["language_id"]) == want


def test_near_copies(stages):
    before = pairs(stages["line_dedup"])
    kept = {d for d, _, c in groups(before) if d == c}
    assert pairs(stages["ngram_join"]) == [x for x in before if x[0] in kept]


def test_lines_go(stages):
    want = lines(pairs(stages["language_id"]), 2)
    got = dict(pairs(stages["line_dedup"]))
    assert got == {d: t for d, (t, n, gone) in want.items() if n == 0 or gone < n}
    assert all(r.n_chars == len(r.text) for r in stages["line_dedup"].collect())


def test_benchmark_goes(spark, stages):
    before = pairs(stages["ngram_join"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in leaks(before, items)}
    assert pairs(stages["decontaminate"]) == [x for x in before if x[0] not in bad]


def test_mix(stages):
    want = {r.doc_id: r.copies for r in mixing.mix_counts(stages["decontaminate"]).collect()}
    got = {}
    for r in stages["mix"].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: n for d, n in want.items() if n}


def test_run(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages["mix"].collect()))


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_columns_of_the_user_stay(spark):
    rows = [(k, f"line {k} of some words\nand one more line that stands here", "en", "s", 1, 0.5, 7, 8, "h") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, n_lines int, n_dropped int, th string")
    out = corpus_pipeline.dedup_lines(spark, corpus_pipeline.language_id(spark, df, SF), SF)
    assert out.columns == df.columns
    assert {(r.score, r.n_lines, r.n_dropped, r.th) for r in out.collect()} == {(0.5, 7, 8, "h")}
