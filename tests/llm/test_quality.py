"""Rule ensemble: compiled rules equal the rules, held-out accuracy, edge cases."""

import numpy as np
import pytest

from covspark.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = quality.query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 30
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_compiled_rules_equal_rules(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)
    assert 0 < len(model.rules) < 200
    rows = quality.with_features(docs, ["doc_id"]).select("*", model.column().alias("s")).toPandas()
    x = {n: rows[n].to_numpy() for n in quality.features()}
    z = model.intercept + sum(w * r.holds(x) for r, w in model.rules)
    assert np.allclose(rows["s"], 1 / (1 + np.exp(-z)))


def test_edges(spark):
    schema = "doc_id long, text string, words string, quality_score string"
    docs = spark.createDataFrame([(1, None, "a", ""), (2, "", "b", ""), (3, "x y", None, ""), (3, "x y", None, ""), (4, "long " * 50_000, "", "")], schema)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0), (3, 1)], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == 5 and got[0].quality_score == got[1].quality_score
    none = quality.fit(docs, labels.where("false"))
    assert none.rules == () and quality.score(docs, none).first().quality_score == pytest.approx(0.5)
    assert quality.score(docs.where("false"), none).count() == 0
