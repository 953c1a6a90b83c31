"""Suffix array and byte dedup against plain versions."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from covspark.llm import suffix_array, suffix_dedup


def test_suffix_array(spark):
    rng = random.Random(1)
    s = [[rng.randint(1, 3) for _ in range(rng.randint(0, 30))] + [-1 - k] for k in range(60)]
    df = spark.createDataFrame(list(enumerate(s)), "sid long, syms array<bigint>")
    got = {(r.sid, i): v for r in suffix_array.suffix_ranks(df).collect() for i, v in enumerate(r.ranks)}
    order = sorted((s[k][i:], k, i) for k in range(len(s)) for i in range(len(s[k])))
    assert got == {x[1:]: rank for rank, x in enumerate(order)}


def test_suffix_array_of_nothing(spark):
    assert suffix_array.suffix_ranks(spark.createDataFrame([], "sid long, syms array<bigint>")).count() == 0


def brute(texts, length):
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("seed,block,piece", [(1, 4, 1_000_000), (2, 16, 1_000_000), (3, 8, 70)])
def test_removal(spark, monkeypatch, seed, block, piece):
    monkeypatch.setattr(suffix_dedup, "GRAM", 8)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    if piece < 1000:  # long documents come alone and are handled in pieces
        from covspark.llm import common
        slices = common.text_slices
        monkeypatch.setattr(suffix_dedup, "text_slices", lambda batch: slices(batch, limit=100))
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdefgh é") for _ in range(900))
    texts = []
    for _ in range(40):
        t = ""
        for _ in range(rng.randint(0, 4)):
            a = rng.randrange(800)
            t += base[a:a + rng.randint(10, 200)]
            if rng.random() < .5:
                t += "".join(rng.choice("xyz") for _ in range(rng.randint(1, 20)))
            if rng.random() < .2:
                t += "ab " * rng.randint(1, 60)
        texts.append(t)
    texts[3] = None
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)] + [(5, texts[5], "x", 1), (None, texts[7], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string, start int")
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans),
                  hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup.remove_repeats(df, 40, block).collect())
    want = brute([(r[1] or "").encode() for r in rows], 40)
    assert got == sorted((r[0] if r[0] is not None else -1, *w) for r, w in zip(rows, want))


def test_removal_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(df).count() == 0
    one = spark.createDataFrame([(1, "short")], "doc_id long, text string").collect()
    out = suffix_dedup.remove_repeats(spark.createDataFrame(one)).collect()
    assert out[0].kept == b"short" and out[0].spans == []


def test_text_is_hashed_in_small_slices():
    batch = pa.RecordBatch.from_pydict({"text": ["ab" * 1000] * 1000})
    sizes = [len(data) for _, data, _, _ in suffix_dedup._pieces(batch, 400)]
    assert sum(sizes) == 2_000_000 and max(sizes) <= 250_000


def test_blocks_are_cut_once_for_all_copies(spark, monkeypatch):
    rng = random.Random(7)
    a = "".join(rng.choice("abcdefgh ") for _ in range(1200))
    texts = [a] * 12 + [a[:500] + "x" * 30 + a[530:]]  # stretches of the last one are others at the same anchors
    seen, resolve = [], suffix_dedup.resolve

    def counted(rows, keys, passed):
        if keys[0] == "core":
            seen.extend(r["count"] for r in rows.groupBy("core", "low", "high", "left", "right").count().collect())
        return resolve(rows, keys, passed)

    monkeypatch.setattr(suffix_dedup, "resolve", counted)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(6).cache()
    got = sorted((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
                 for r in suffix_dedup.remove_repeats(df).collect())
    assert got == [(k, *w) for k, w in enumerate(brute([t.encode() for t in texts], 400))]
    assert seen and max(seen) <= 2  # once for the copies, once for the last text
