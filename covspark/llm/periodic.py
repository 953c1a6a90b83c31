"""Periodic run detection: Lyndon arrays by Baier grouping under both orders, Lyndon roots extended through LCE into runs.

A run is a stretch of words of smallest period q, at least ``max(LEAST, 2 q)`` words long, that no neighbour extends.
Every run holds, under one of an order of the words and its reverse, a place whose longest Lyndon word is as long as the
run's period (its Lyndon root).  Both Lyndon arrays come from the first phase of Baier's suffix sorter: suffixes are
grouped by their first word; groups are taken from the highest on, a group's context is the longest Lyndon word of its
suffixes, and the nearest earlier suffix of a lower group has its context extended by it and moves up to a new group
right above its own.  Nearest earlier ones are found by path halving, so both arrays take nearly linear time.  A root is
extended to both sides by comparing the text with itself shifted by the period, in doubling slices; roots inside the run
found last with their period aren't extended again.

A run repeats some ``GRAM`` = LEAST / 2 words at the distance of its period, and each of its words lies in such a
repeat.  So only the stretches of words covered by repeated six-word shingles of the document go through the grouping;
they are found by numpy over slices of many documents.  A text without repeated shingles has no runs.  A collision of
two shingles' 64-bit hashes only makes a stretch longer: words are compared as they are.

One document is one row, handled by one task in time and memory linear in it (about 50 bytes a word); documents share
nothing, so there is no shuffle.

Defined results: a null or empty text, or one without words, has no runs and an empty collapsed text; texts of any
length are whole; equal rows give equal rows; an empty table gives an empty result; columns of the input are not kept,
but for the key, whatever they are named.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import mix, prefix_hash, span_hash, table, text_slices, word_spans

LEAST = 12
_U = np.uint64
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def lyndon_array(s: list[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each place (a proper prefix is smaller)."""
    n = len(s)
    out = [0] * n
    symbols = sorted(set(s))
    number = {x: g for g, x in enumerate(symbols)}
    group = [number[x] for x in s]  # of each suffix not yet taken
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(symbols)
    lower = list(range(-1, len(symbols) - 1))
    upper = list(range(1, len(symbols) + 1))
    parent = list(range(n + 1))  # of place i at i + 1; 0: before the text
    g = len(symbols) - 1
    while g >= 0:
        taken = [i for i in members[g] if group[i] == g]
        length = context[g]
        for i in taken:
            out[i] = length
            parent[i + 1] = i
        times: dict[int, int] = {}
        for i in taken:
            x = i
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            if x:
                times[x - 1] = times.get(x - 1, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, k in times.items():
            moved.setdefault((-k, group[j]), []).append(j)
        for minus, h in sorted(moved):  # most repeats first: they end highest above h
            new = len(members)
            members.append(moved[minus, h])
            for j in members[new]:
                group[j] = new
            context.append(context[h] - minus * length)
            up = upper[h]
            lower.append(h)
            upper.append(up)
            upper[h] = new
            lower[up if up < new else g] = new
        g = lower[g]
    return out


def _alike(a: np.ndarray, i: int, j: int) -> int:
    """How many places a[i:] and a[j:] agree from their starts on (i < j)."""
    k, step, n = 0, 16, len(a)
    while j + k < n:
        m = min(step, n - j - k)
        differ = a[i + k:i + k + m] != a[j + k:j + k + m]
        at = int(differ.argmax())
        if differ[at]:
            return k + at
        k, step = k + m, step * 2
    return k


def find_runs(s: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``s`` of at least max(least, 2 period) symbols, by start, then period."""
    n = len(s)
    if n < 2:
        return []
    a = np.array(s, np.int64)
    back = np.ascontiguousarray(a[::-1])
    period = np.array([lyndon_array(s), lyndon_array([-x for x in s])])
    i = np.tile(np.arange(n), 2)
    q = period.ravel()
    right = i + q < n
    right[right] = a[i[right]] == a[i[right] + q[right]]
    left = i > 0
    left[left] = a[i[left] - 1] == a[i[left] + q[left] - 1]
    some = left | right
    q, i = q[some], i[some]
    order = np.lexsort((i, q))
    out, last = set(), (0, 0, 0)
    for p, k in zip(q[order].tolist(), i[order].tolist()):
        if p == last[0] and last[1] <= k and k + p <= last[2]:
            continue
        begin, end = k - _alike(back, n - k - p, n - k), k + p + _alike(a, k, k + p)
        if end - begin >= 2 * p:
            last = (p, begin, end)
            if end - begin >= least:
                out.add((begin, end - begin, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _stretches(data: np.ndarray, offsets: np.ndarray, gram: int):
    """(row, first word, end word) of the stretches covered by shingles that their row repeats, words counted in the row."""
    begin, end, first = word_spans(data, offsets)
    if len(begin) <= gram:
        return []
    w = span_hash(prefix_hash(data), begin, end)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    full = np.zeros(len(w) - gram + 1, _U)
    for k in range(gram):
        full = mix(full + w[k:k + len(full)])
    full += mix(row[:len(full)].astype(_U) + _U(1))
    ok = row[:len(full)] == row[gram - 1:]
    at, h = np.flatnonzero(ok), full[ok]
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return []
    place = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    at = at[twice[place] == h]
    edge = np.zeros(len(w) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + gram, -1)
    covered = np.zeros(len(w) + 2, bool)
    covered[1:-1] = np.cumsum(edge[:-1]) > 0
    cut = np.zeros(len(w) + 1, bool)
    cut[first] = True
    starts = np.flatnonzero(covered[1:] & (~covered[:-1] | cut)) if len(w) else []
    ends = np.flatnonzero(covered[:-1] & (~covered[1:] | cut))
    rows = row[starts]
    return zip(rows.tolist(), (starts - first[rows]).tolist(), (ends - first[rows]).tolist())


def text_runs(texts: list[bytes], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start, then period."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    row, words = -1, []
    for k, lo, hi in _stretches(data, offsets, least // 2):
        if hi - lo < least:
            continue
        if k != row:
            row, words = k, texts[k].split()
        ids: dict[bytes, int] = {}
        out[k] += [(lo + b, m, q) for b, m, q in find_runs([ids.setdefault(x, len(ids)) for x in words[lo:hi]], least)]
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, each run cut down to its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for b, m, q in runs:
        keep[b + q:b + m] = False
    return b" ".join(words[i] for i in np.flatnonzero(keep))


def runs(docs: DataFrame, key: str = "doc_id", column: str = "text", least: int = LEAST, prepare=None) -> DataFrame:
    """(key, n_words, runs, collapsed): the periodic runs of each text, by start, then period, and the text with each
    run cut down to its first period.  ``prepare(key, words)`` may give the words to take instead of the text's own."""
    given = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{column}`").alias("text"))
    schema = StructType([*given.select(F.col("key").alias(key)).schema, *StructType.fromDDL(
        "n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")])

    def run(batches):
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                raw, at = data.tobytes(), offsets.tolist()
                texts = [raw[b:e] for b, e in zip(at, at[1:])]
                if prepare:
                    for k, name in enumerate(rows.column("key").to_pylist()):
                        changed = prepare(name, texts[k])
                        texts[k] = texts[k] if changed is None else changed
                found = text_runs(texts, least)
                words = [t.split() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key"), pa.array([len(x) for x in words], pa.int64()),
                     pa.array([[{"start": b, "length": m, "period": q} for b, m, q in r] for r in found], _RUNS),
                     pa.array([collapse(x, r).decode() for x, r in zip(words, found)], pa.string())],
                    names=[key, "n_words", "runs", "collapsed"])

    return given.mapInArrow(run, schema)


def repeat_tail(doc_id, text: bytes) -> bytes | None:
    """The query's input: of every tenth document the tail repeats its first words."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10:
        return None
    words = text.split()
    if not words:
        return None
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a])


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs(table(spark, sf_dir, "documents"), prepare=repeat_tail)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    text = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("best"),
                       _digest(text).alias("runs_sha256"), _digest(F.col("collapsed")).alias("collapsed_sha256"))
    length = -F.col("best.minus")
    return out.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
                      F.expr("(-1000 * best.minus) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
