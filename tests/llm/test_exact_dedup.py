"""Exact dedup by block naming against grouping of the normalised texts."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from covspark.llm import exact_dedup


def plain(rows):
    body = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    by = defaultdict(list)
    for (k, _), b in zip(rows, body):
        by[b].append(k)
    least = {b: min((k is None, k or 0) for k in ks) for b, ks in by.items()}
    return sorted((str(k), str(None if least[b][0] else least[b][1]), len(by[b]), hashlib.sha256(b.encode()).hexdigest()) for (k, _), b in zip(rows, body))


def texts(seed):
    """Near equal ones: the same blocks in other order or number, one changed byte, a prefix, repeats of one block."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(6)) for _ in range(4)]
    out = [None, "", " ", "\n\t", "a", "a ", "a ", "a\x1f"]
    for n in (1, 2, 3, 5, 8, 9, 17):
        parts = [rng.choice(words) for _ in range(n)]
        one = " ".join(parts)
        out += [one, one.replace(" ", " \n "), one + "x", one[:-1], " ".join(parts[::-1]), one + " " + one, words[0] * n, words[0] * n + "b"]
    return [(rng.randrange(10**9), t) for t in out + rng.choices(out, k=60)]


@pytest.mark.parametrize("block,bits", [(16, None), (32, 3)])
def test_groups_equal_texts(spark, block, bits):
    rows = texts(block) + [(None, "a"), (None, "only null"), (None, "only null"), (5, "twice"), (5, "twice"), (5, "other")]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, row int, name string")
    hashed = F.xxhash64 if bits is None else (lambda b: F.xxhash64(b) % (1 << bits))  # few hashes: blocks collide
    got = exact_dedup.groups(df, block=block, hashed=hashed).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == plain(rows)
    kept = [r for r in got if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)
    assert len({(r.level, r.name) for r in got}) == len(kept)


def test_hot_group_and_long_text(spark):
    long = "word " * 40_000
    rows = [(i, "the same everywhere") for i in range(400)] + [(1000, long), (1001, long), (1002, long + "!")]
    got = {r.doc_id: r for r in exact_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(r.kept for r in got.values()) == 3 and got[399].keep_id == 0 and got[399].group_size == 400
    assert got[1001].keep_id == 1000 and got[1002].kept and got[1002].group_size == 1


def test_empty_table(spark):
    out = exact_dedup.groups(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0 and out.columns[:5] == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
