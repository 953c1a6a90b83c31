"""SimHash decontamination against a plain search, and the multi-index guarantee."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from covspark.llm import decontaminate as d

WORD = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in WORD.findall(text or "")]


def bag(w):
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def plain(docs, items):
    """(doc, item) -> best similarity over the item-sized windows."""
    out = {}
    for doc_id, text in docs:
        w = words(text)
        for item_id, t in items:
            v = words(t)
            if not v:
                continue
            b = bag(v)
            for i in range(len(w) - len(v) + 1):
                a = bag(w[i:i + len(v)])
                shared = sum((a & b).values())
                sim = shared / (sum(a.values()) + sum(b.values()) - shared)
                if sim >= d.SIMILARITY:
                    out[(doc_id, item_id)] = max(sim, out.get((doc_id, item_id), 0))
    return out


@pytest.fixture(scope="module")
def fixture():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(8, 60)))) for i in range(25)]
    items += [(50, "Tiny Item"), (51, ""), (52, None), (3, items[3][1])]
    docs = []
    for k in range(120):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 200))]
        if k % 3 == 0:
            v = items[rng.randrange(25)][1].split()
            if k % 2:
                v[rng.randrange(len(v))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = v
        docs.append((k, (", " if k % 5 == 0 else " ").join(x.upper() if k % 7 == 0 else x for x in w)))
    docs += [(200, None), (201, ""), (202, "so a tiny-item here"), (0, docs[0][1]), (203, "a b " * 30_000 + items[1][1])]
    return docs, items


def test_finds_what_a_plain_search_finds(spark, fixture):
    docs, items = fixture
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = plain([x for x in docs if x[0] != 203], [x for x in items if x[1]])
    for size in (d.BLOCK_WORDS, 200):  # one block and several give the same
        got = d.find_leaks(df, bench, size).collect()
        best = {(r.doc_id, r.item_id): r.similarity for r in got if r.doc_id != 203}
        assert best == pytest.approx(want)
        assert any(r.doc_id == 203 and r.item_id == 1 for r in got)
    assert (202, 50) in want


def test_drop_keeps_clean_documents_and_columns(spark, fixture):
    docs, items = fixture
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in docs], "doc_id long, text string, item_id string, similarity double")
    bench = spark.createDataFrame(items, "item_id long, text string")
    bad = {k for k, _ in plain([x for x in docs if x[0] != 203], [x for x in items if x[1]])} | {203}
    out = d.drop_contaminated(df, bench)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, _ in docs if i not in bad)


def test_multi_index_keeps_all_within_radius():
    rng = np.random.default_rng(0)
    items = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.zeros(4000, np.uint64)
    for _ in range(30):
        flips |= np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64)
    prints = items[rng.integers(0, 40, 4000)] ^ np.where(rng.random(4000) < .7, flips & rng.integers(0, 2**63, 4000, dtype=np.uint64), flips)
    got = {(int(i), int(j)) for i, j, _ in d.near(prints, items)}
    want = {(int(i), int(j)) for i, j in np.argwhere(np.bitwise_count(prints[:, None] ^ items[None, :]) <= d.RADIUS)}
    assert got == want and want


def test_empty(spark, fixture):
    docs, items = fixture
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert d.find_leaks(df.where("false"), bench).count() == 0
    assert d.find_leaks(df, bench.where("false")).count() == 0
    assert d.drop_contaminated(df, bench.where("false")).count() == len(docs)


def plain_short(docs, items):
    """(doc, item) -> similarity of documents with fewer words than the item, as one window."""
    out = {}
    for doc_id, text in docs:
        w = words(text)
        for item_id, t in items:
            v = words(t)
            if 0 < len(w) < len(v):
                k = min(5, len(v))
                a, b = (Counter(tuple(x[i:i + k]) for i in range(len(x) - k + 1)) for x in (w, v))
                shared = sum((a & b).values())
                sim = shared / (sum(a.values()) + sum(b.values()) - shared)
                if sim >= d.SIMILARITY:
                    out[(doc_id, item_id)] = max(sim, out.get((doc_id, item_id), 0))
    return out


def test_documents_shorter_than_an_item_and_items_without_id(spark):
    rng = random.Random(6)
    items = [(k, " ".join(f"u{rng.randrange(5000)}" for _ in range(n))) for k, n in enumerate([40, 40, 60, 10, 4])]
    items += [(None, " ".join(f"null{i}" for i in range(30))), (None, "tiny null item"), (7, items[0][1])]
    docs = [(i, w) for i, w in enumerate(" ".join(x) for _, t in items for v in [t.split()] for n in range(len(v))
                                         for x in (v[:len(v) - n], v[n:]))]  # items less their last or first words
    docs += [(1000 + k, " ".join([*t.split()[:-2], "other"])) for k, (_, t) in enumerate(items)]
    want = plain(docs, items) | plain_short(docs, items)
    assert len(plain_short(docs, items)) > 50 and any(i is None for _, i in want)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    for size in (d.BLOCK_WORDS, 40):
        got = d.find_leaks(df, bench, size).collect()
        assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(want)
        n = {i: len(words(t)) for i, t in docs}
        assert all(r.start_word + r.n_words <= n[r.doc_id] for r in got)
        kept = d.drop_contaminated(df, bench, size).collect()
        assert sorted(r.doc_id for r in kept) == sorted(set(n) - {i for i, _ in want})
