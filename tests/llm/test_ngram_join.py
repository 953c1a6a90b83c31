"""Jaccard join against all pairs."""

import random
import re

import pytest

from covspark.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in WORD.findall(text or "")]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(s), low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(400)]
    shared = [rng.choice(vocab) for _ in range(40)]
    out = []
    for g in range(12):
        seed = [rng.choice(vocab) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.choice([1, 2, 5, 25])):
            w = list(seed)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(w)
    out += [shared + [rng.choice(vocab) for _ in range(rng.randint(0, 30))] for _ in range(40)]  # a passage that many hold
    texts = [" ".join(w).upper() if k % 9 == 0 else "\n".join(w) for k, w in enumerate(out)]
    texts += [None, "", " \t", "one", "one", "a b c d e", "a b c d e", "A b c d", texts[0], "x " * 20_000, "x " * 19_000]
    return [(1000 - k, t) for k, t in enumerate(texts)]


def test_components(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in rows], "doc_id long, text string, n int, key string")
    got = sorted(map(tuple, ngram_join.join(df).collect()))
    assert got == plain(rows)


def test_blocks_of_a_long_list(spark, rows, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    got = sorted(map(tuple, ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == plain(rows)


def test_keep_first_and_empty(spark, rows):
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, component_id string")
    out = ngram_join.keep_first(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, _, c in plain(rows) if d == c)
    assert ngram_join.join(df.where("false")).count() == 0
    assert ngram_join.keep_first(spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")).count() == 1


def test_keep_first_decides_by_row(spark):
    def text(seed, changed=None):
        w = [f"{seed}{i}" for i in range(60)]
        if changed is not None:
            w[changed] = "changed"
        return " ".join(w)

    a, b, c, d, e = map(text, "abcde")
    rows = [(3, b), (7, a), (7, b),  # a is clean, though its doc_id also stands on a copy
            (5, c), (5, c), (5, c), (9, c),  # exact copies under one doc_id
            (None, d), (4, d), (None, text("d", 59)),  # copies without a doc_id
            (6, e), (6, e.upper()), (6, text("e", 0)),  # one doc_id, one set, several texts
            (8, ""), (8, ""), (8, None), (None, None)]  # without a set: no copies
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, th string").repartition(5)
    out = ngram_join.keep_first(docs)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    want = [(3, b), (7, a), (5, c), (4, d), (8, ""), (8, ""), (8, None), (None, None)]
    assert sorted((x for x in got if x[0] != 6), key=repr) == sorted(want, key=repr)
    assert [t in (e, e.upper(), text("e", 0)) for i, t in got if i == 6] == [True]


def test_keep_first_near_copies_without_ids(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(w)), (None, " ".join([*w[:-1], "x"])), (None, " ".join(["y", *w[1:]]))]
    assert ngram_join.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1
