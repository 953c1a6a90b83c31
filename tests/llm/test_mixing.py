"""Systematic mixing: targets, bounds, edge cases."""

import pytest

from covspark.llm import mixing

SCHEMA = "doc_id long, text string, source string, copies long, size string"


def fill(weights, sizes, most=3):
    """Targets by repeated sharing, the plain way."""
    total, out, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while open_ and left > 1e-9:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if out[i] + left * weights[i] / w > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] += left * weights[i] / w
            break
        for i in over:
            left -= most * sizes[i] - out[i]
            out[i] = float(most * sizes[i])
            open_.discard(i)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "w " * (i % 40 + 1), "hot" if i % 3 else f"s{i % 7}", 1, "x") for i in range(600)]
    rows += [(700, None, "s1", 1, "x"), (701, "", None, 1, "x"), (702, "a b c", None, 1, "x"), (None, "one two", "hot", 1, "x"),
             (5, rows[5][1], rows[5][2], 1, "x"), (703, None, "silent", 1, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_and_bounds(docs):
    rows = mixing.mix_counts(docs).collect()
    assert len(rows) == docs.count()
    texts = [(r.source, len((r.text or "").split())) for r in docs.collect()]
    names = sorted({s for s, _ in texts if s is not None}) + [None]
    sizes = [sum(n for s, n in texts if s == name) for name in names]
    want = fill([(5, 2, 1)[i % 3] for i in range(len(names))], sizes)
    assert sum(want) == pytest.approx(sum(sizes))
    got = {}
    for r in rows:
        assert 0 <= r.copies <= 3
        key = (r.source_size, round(r.target, 6))
        got[key] = got.get(key, 0) + r.copies * r.size
    for size, target in zip(sizes, want):
        assert abs(got[(size, round(target, 6))] - target) <= 40  # the largest document


def test_reruns_agree_and_copies_are_emitted(docs):
    one = sorted(map(tuple, mixing.mix_counts(docs).collect()), key=repr)
    two = sorted(map(tuple, mixing.mix_counts(docs.repartition(7)).collect()), key=repr)
    assert one == two
    out = mixing.emit(docs)
    assert out.columns == [*docs.columns, "mix_copy"]  # clashing names of the input survive
    assert out.count() == sum(r[4] for r in one)


def test_empty(spark):
    assert mixing.mix_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, None, "a", 1, "")], SCHEMA)
    assert [tuple(r) for r in mixing.mix_counts(only).collect()] == [(1, 0, 0, 0.0, 0)]
