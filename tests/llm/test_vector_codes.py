"""Trie walk against all distances, training and codes against a plain version, odd rows."""

import hashlib
import math
import random

import numpy as np

from covspark.llm import vector_codes


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [(k, lab, [math.floor(4096 * c) for c in x]) for k, lab, x in rows
            if x is not None and not any(c is None or not math.isfinite(c) for c in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            at = [assign(p, c[p])[1] for c in cut]
            for i in range(len(books[p])):
                mine = [c[p] for c, j in zip(cut, at) if j == i]
                if mine:
                    books[p][i] = [sum(col) // len(mine) for col in zip(*mine)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (k, lab, _), c in zip(kept, cut):
        best = [assign(p, c[p]) for p in range(parts)]
        out.append((k, lab, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best)))
    per = {}
    for _, lab, _, e in out:
        per[lab] = per.get(lab, 0) + e
    return sorted(((k, code, e, per[lab], sha) for k, lab, code, e in out), key=repr)


def given(n, seed, width=2):
    rng = random.Random(seed)
    step = lambda: np.float32(rng.choice([-0.5, -0.2501, 0.0, 0.1, 0.25, 0.7])).item()  # noqa: E731  many ties and shared prefixes
    rows = [(10 * k + 3, rng.choice([None, 0, 1, 2]), [step() for _ in range(8 * width)]) for k in range(n)]
    rng.shuffle(rows)
    return rows


def test_walk_shares_prefixes_and_blocks():
    rng = np.random.default_rng(5)
    book = rng.integers(-9, 9, (16, 4))
    for n in (1, 2, 7, 40, 300):
        leaves = np.unique(rng.integers(-3, 3, (n, 4)), axis=0)
        want = ((leaves[:, None, :] - book) ** 2).sum(2)
        for block in (1, 3, 64):
            got = np.concatenate([d for _, d in vector_codes.walk(leaves, book, block)])
            assert (got == want).all()
        unsorted = rng.integers(-3, 3, (n, 4))  # order only decides what is shared
        code, error = vector_codes.nearest(unsorted, book, 5)
        want = ((unsorted[:, None, :] - book) ** 2).sum(2)
        assert (code == want.argmin(1)).all() and (error == want.min(1)).all()


def check(spark, folder, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "'x' as v", "1 as pos", "2 as error")
    df.repartition(5).write.parquet(f"{folder}/embeddings.parquet")
    got = vector_codes.query(spark, str(folder))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


def test_query(spark, tmp_path):
    rows = given(160, 1)
    odd = [(5, 1, None), (6, 1, [None] * 16), (7, 1, [float("nan")] * 16), (8, 2, [float("inf")] + [0.0] * 15), (9, 2, [-0.25] * 16)]
    check(spark, tmp_path, rows + odd + [rows[0]] * 40 + [(None, None, [0.125] * 16)])


def test_fewer_rows_than_entries(spark, tmp_path):
    check(spark, tmp_path, given(5, 2, width=1))


def test_other_lengths_empty_table_and_decoding(spark):
    rows = given(60, 3) + [(0, 1, [0.5] * 16), (1, 1, [0.5] * 7), (2, 1, []), (4, 1, [0.5] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    whole = vector_codes.whole_vectors(df)
    books = vector_codes.train(whole)
    assert books.shape == (8, 16, 2)
    coded = vector_codes.decode(vector_codes.encode(whole, books), books).collect()
    assert len(coded) == 61
    by_id = {k: x for k, _, x in rows}
    for r in coded:
        away = sum((math.floor(4096 * x) - 4096 * y) ** 2 for x, y in zip(by_id[r.vec_id], r.decoded))
        assert round(away) == r.error
    none = vector_codes.whole_vectors(df.where("false"))
    assert vector_codes.encode(none, vector_codes.train(none)).count() == 0
