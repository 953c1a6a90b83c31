"""Merkle fingerprints: order of documents, equality, likeness, located edits."""

import hashlib
import random

from covspark.llm import merkle


def test_compare(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(10**6), "\n".join("".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(1, 9))),
             "x", "y") for _ in range(150)]
    rows = list({r[0]: r for r in rows}.values()) + [(10**7, None, "x", "y"), (10**7 + 1, "", "x", "y"), (10**7 + 2, "z" * 90_000, "x", "y")]
    rows.append((10**7 + 3, rows[0][1], "x", "y"))
    df = spark.createDataFrame(rows, "doc_id long, text string, head string, id string")
    got = {r.doc_id: r for r in merkle.compare(df).collect()}
    assert len(got) == len(rows)
    text = {r[0]: r[1] or "" for r in rows}
    order = sorted(text)
    for this, after in zip(order, order[1:] + order[:1]):
        t, n = text[this], len(text[this])
        edited = t[:n - n // 4] + text[after][:n // 4]
        r = got[this]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited)
        if n > 200 and len(set(t)) > 1:
            assert r.near_edited > 0.5 > r.near_next
    assert got[10**7 + 3].fingerprint == got[rows[0][0]].fingerprint
    assert len({r.fingerprint[:64] for r in got.values()}) == len(set(text.values()))


def test_null_ids_repeats_single_and_empty(spark):
    df = spark.createDataFrame([(None, "first one here"), (1, "same"), (1, "same"), (1, "other")], "doc_id long, text string")
    got = merkle.compare(df).collect()
    assert len(got) == 4
    same = [r for r in got if r.n_chars == 4]
    assert same[0] == same[1]
    one = merkle.compare(df.limit(1)).collect()[0]
    assert one.near_next == 1.0
    assert merkle.compare(df.where("false")).count() == 0


def test_locate_edits(spark):
    a = "one\ntwo\n\nthree\nfour\n\nfive"
    rows = [(1, a, a), (2, a, a.replace("four", "FOUR")), (3, a, a + "\nsix"), (4, None, a), (5, None, None)]
    got = {r.k: [tuple(e) for e in r.edits] for r in merkle.locate_edits(spark.createDataFrame(rows, "k int, text_a string, text_b string")).collect()}
    assert got[1] == [] and got[2] == [(2, 2)] and got[3] == [(3, 2)] and got[5] == []
    assert got[4] == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)]


def test_ids_that_are_text(spark):
    rows = [("b", "second"), ("a", "first"), (None, "none"), ("c", "third third")]
    got = {r.doc_id: r for r in merkle.compare(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got["c"].edited_sha256 == hashlib.sha256(b"third thino").hexdigest()
    assert got["a"].edited_sha256 == hashlib.sha256(b"firss").hexdigest()
