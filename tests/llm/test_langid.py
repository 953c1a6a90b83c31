"""Language mixtures: held-out accuracy, mixed documents, edge cases."""

import re

import numpy as np

from covspark.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = langid.query(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_mixture_finds_both_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    long = docs.where("n_chars > 2000")
    en, de = long.where("lang = 'en'").first().text[:1500], long.where("lang = 'de'").first().text[:1500]
    own = spark.createDataFrame([(1, en + "\n" + de), (2, en)], "doc_id long, text string")
    got = {r.doc_id: r.lang_mix for r in langid.predict(own, model).collect()}
    assert set(got[1]) >= {"en", "de"} and min(got[1]["en"], got[1]["de"]) > 0.3
    assert got[2]["en"] > 0.9 and abs(sum(got[1].values()) - 1) < 1e-6


def test_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    text = docs.where("lang = 'fr' and n_chars > 500").first().text
    own = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "123 -- !", 3), (None, text, 4), (None, text, 4), (5, text * 300, 5)],
                                "doc_id long, text string, score int")
    got = langid.predict(own, model).collect()
    assert [r.lang_pred for r in got] == ["und", "und", "und", "fr", "fr", "fr"]
    assert [r.score for r in got[:3]] == [0.0] * 3 and got[3].score == got[4].score
    assert langid.predict(own.where("false"), model).count() == 0
    nothing = langid.fit(own.selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r.lang_pred for r in langid.predict(own, nothing).collect()} == {"und"}


def test_sample_is_ranked_in_two_levels(spark):
    rows = spark.range(9000).selectExpr("case when id % 3 = 0 then 5 when id % 100 = 1 then null else id end as doc_id",
                                        "if(id % 10 = 0, 'de', 'en') as lang").repartition(6)
    chosen = langid.smallest(rows, 1500)
    assert chosen.columns == ["doc_id", "lang"]
    hashed = sorted((r.lang, r.h, r.doc_id or 0, r.doc_id) for r in rows.selectExpr("*", "xxhash64(doc_id) as h").collect())
    want = [[(r[3], lang) for r in hashed if r[0] == lang][:1500] for lang in ("de", "en")]
    assert sorted(map(tuple, chosen.collect()), key=repr) == sorted(want[0] + want[1], key=repr)
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    first, second = re.findall(r"row_number\(\) windowspecdefinition\((lang#\d+, (?:part#\d+L?)?)", plan)
    assert "part" in first + second and not ("part" in first and "part" in second)
