"""Line dedup against all pairs of lines."""

import random

import pytest
from pyspark.sql import functions as F

from covspark.llm import line_dedup


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def plain(rows, edits):
    lines = sorted({(d, i + 1, x) for d, t in rows if t is not None for i, x in enumerate(t.split("\n")) if x.strip(" ")})
    first = {}
    for d, i, x in lines:
        first.setdefault(x, (d, i))
    many = [x for x in first if len(x) >= line_dedup.MIN_CHARS]
    near = {x for x in many if any(first[y] < first[x] and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits for y in many)}
    gone = {(d, i) for d, i, x in lines if x in near or first[x] != (d, i)}
    return {d: (None, 0, 0) if t is None else (
        "\n".join(x for i, x in enumerate(t.split("\n"), 1) if (d, i) not in gone),
        sum(1 for x in t.split("\n") if x.strip(" ")), sum(1 for i, _ in enumerate(t.split("\n"), 1) if (d, i) in gone)) for d, t in rows}


def edited(rng, line, times):
    line = list(line)
    for _ in range(times):
        k = rng.randrange(len(line))
        kind = rng.randrange(3)
        if kind == 0:
            line[k] = rng.choice("abxé\U0001f600")
        elif kind == 1:
            del line[k]
        else:
            line.insert(k, rng.choice("abz"))
    return "".join(line)


@pytest.mark.parametrize("edits", [2, 1])
def test_dedup(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choice("abcdé \U0001f600") for _ in range(rng.randint(32, 40))) for _ in range(6)]
    rows = [(d, "\n".join(edited(rng, rng.choice(base), rng.randint(0, 3)) for _ in range(rng.randint(0, 5)))) for d in range(50)]
    rows[7] = (7, None)
    rows += [rows[5], (61, "\n\n  \nshort\nshort"), (62, "hot\n" * 300 + "x" * 5000)]
    docs = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, pos string, n_lines int")
    out = line_dedup.dedup(docs, edits).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in out} == plain(rows, edits)


def test_edit_check(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 12)))
        pairs.append((a, edited(rng, a, rng.randint(0, 4)) if len(a) > 5 else "".join(rng.choice("ab") for _ in range(rng.randint(0, 4)))))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2, 3):
        for r in df.withColumn("ok", line_dedup.within_edits(F.col("a"), F.col("b"), edits)).collect():
            assert r.ok == (distance(r.a, r.b) <= edits), (r, edits)


def test_empty_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "one line\nother"), (1, "one line")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup(docs).collect()}
    assert got == {None: "one line\nother", 1: ""}
    assert line_dedup.dedup(docs.where("false")).count() == 0


def test_rows_that_tie_on_doc_id(spark):
    head, near = "a boilerplate line that very many documents hold", "A boilerplate line that very many documents hold"
    copy = "a whole copy, first line\n\nits second line"
    rows = [(None, f"{head}\nown text {k}") for k in range(6)] + [(None, copy)] * 5  # null doc_ids
    rows += [(4, f"{head}\nmore text {k}") for k in range(3)] + [(4, f"{near}\n{k}") for k in range(3)]  # one doc_id, several texts
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = line_dedup.dedup(docs)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    got = out.collect()
    assert len(got) == len(rows)
    left = [x for r in got for x in r.text.split("\n") if x]
    assert len(left) == len(set(left)) and set(left) == {x for _, t in rows for x in t.split("\n") if x} - {near}
    assert [r.doc_id for r in got if head in r.text] == [None]
    assert sorted((r.text, r.n_dropped) for r in got if r.n_lines == 2 and not r.text.strip()) == [("", 2)] * 4
    assert sum(r.text == copy for r in got) == 1
    assert all(r.n_dropped == r.n_lines - sum(1 for x in r.text.split("\n") if x) for r in got)
