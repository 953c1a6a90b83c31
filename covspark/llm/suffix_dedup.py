"""Removal of repeated byte strings by a distributed suffix array.

Every byte that a ``LENGTH``-byte string covers is removed if the same string also starts anywhere else.  Strings of
that length are called windows; they lie within one document.

The suffix array need not hold all bytes.  A window's anchor is the place of its smallest 32-byte hash (the leftmost), so
equal windows have equal anchors at equal offsets; the windows of one anchor form a stretch of text.  Stretches whose
anchor occurs once hold no repeated window, and a whole stretch that occurs twice holds nothing else.  What remains is cut
into blocks of ``BLOCK`` neighbouring windows.  All windows of a block share its core of LENGTH - BLOCK + 1 bytes, so a
block is written as left bytes, one symbol for the core, right bytes, and each of its windows as ``BLOCK`` symbols; blocks
whose core occurs once are done, as are blocks that occur twice.  The suffix array (``suffix_array``) of all others is
built, neighbours in suffix order are compared over ``BLOCK`` symbols, and the windows that agree with one are repeated.
Each step is exact up to 64-bit hashes of the compared bytes.

Defined results: a null text is empty; a document shorter than ``LENGTH`` bytes loses nothing; repeated rows repeat each
other's text; documents of any length are handled in pieces; an empty table gives an empty result; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import mix, powers, prefix_hash, save, span_hash, table
from .suffix_array import suffix_ranks

LENGTH = 400
BLOCK = 16
GRAM = 32
PIECE = 1_000_000  # windows of one document handled at once
SLICE = 200_000  # bytes of text hashed at once, so that numpy's arrays stay in a core's cache

_U = np.uint64
_POS = 24  # bits of a place in a piece
_SALT = _U(0x9E3779B97F4A7C15)


def text_slices(batch: pa.RecordBatch):
    return common.text_slices(batch, limit=SLICE)


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` neighbours, from minima over powers of two."""
    n, w = len(a) - width + 1, 1
    while 2 * w <= width:
        a = np.minimum(a[:-w], a[w:])
        w *= 2
    return np.minimum(a[:n], a[width - w:][:n])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(row, first window, last window, anchor, anchor hash, stretch hash) of the stretches of a slice."""
    z = np.zeros(0, np.int64)
    gram = min(GRAM, length)
    count = np.maximum(np.diff(offsets) - length + 1, 0)  # windows of each row
    full = np.flatnonzero(count)
    if not len(full):
        return z, z, z, z, z.astype(_U), z.astype(_U)
    cum = prefix_hash(data)
    n = len(data) - gram + 1
    h = mix((cum[gram:] - cum[:n]) * powers(len(cum))[1][:n])
    low = _sliding_min(((h >> _U(_POS)) << _U(_POS)) | np.arange(n, dtype=_U), length - gram + 1)
    ends = np.cumsum(count[full])
    x = np.arange(ends[-1]) + np.repeat(offsets[full] - ends + count[full], count[full])
    p = (low[x] & _U((1 << _POS) - 1)).astype(np.int64)
    new = np.ones(len(x), bool)
    new[1:] = p[1:] != p[:-1]
    new[ends[:-1]] = True
    first = np.flatnonzero(new)
    row = full[np.searchsorted(ends, first, "right")]
    lo, hi, p = x[first], np.append(x[first[1:] - 1], x[-1]), p[first]
    c = mix(span_hash(cum, lo, hi + length) + (p - lo).astype(_U) * _SALT + h[p] * _U(3))
    return row, lo, hi, p, h[p], c


def _pieces(batch: pa.RecordBatch, length: int):
    """(rows, bytes, offsets, offset of the piece in its document): slices of small documents, pieces of long ones."""
    for rows, data, offsets in text_slices(batch):
        if rows.num_rows == 1 and len(data) > PIECE + length:
            for at in range(0, len(data) - length + 1, PIECE):
                own = data[at:at + PIECE + length - 1]
                yield rows, own, np.array([0, len(own)]), at
        else:
            yield rows, data, offsets, 0


def _long(x):
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal runs."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return start[first], reach[np.append(first[1:] - 1, len(start) - 1)] if len(first) else end[:0]


def first_pass(docs: DataFrame, length: int) -> DataFrame:
    """(th, id.., start, stop, a, h, c, sure): one row per distinct stretch of a task (its windows' start and stop, the
    anchor's place from start, anchor and stretch hash; ``sure``: it occurs twice in the task), and rows without h for
    repeats that the task knows of."""
    schema = docs.select("doc_id").schema.add("th", "long").add("start", "long").add("stop", "long").add("a", "integer")
    schema = schema.add("h", "long").add("c", "long").add("sure", "boolean")

    def run(batches):
        kept, ids = [], []
        base = 0
        for batch in batches:
            ids.append((batch.column("doc_id"), batch.column("th")))
            place = 0
            for rows, data, offsets, at in _pieces(batch, length):
                # rows of a slice are numbered through the task
                if at == 0:
                    begin, place = place, place + rows.num_rows
                row, lo, hi, p, h, c = stretches(data, offsets, length)
                kept.append((base + begin + row, lo - offsets[row] + at, hi - offsets[row] + at + length, (p - lo).astype(np.int32), h, c))
            base += batch.num_rows
        if not kept:
            return
        row, start, stop, a, h, c = (np.concatenate(x) for x in zip(*kept))
        doc = pa.concat_arrays([x[0] for x in ids]) if ids else None
        th = pa.concat_arrays([x[1] for x in ids])
        _, at, inverse, times = np.unique(c, return_index=True, return_inverse=True, return_counts=True)
        sure = times[inverse] > 1
        out = []
        for lo in range(0, len(at), 200_000):
            own = at[lo:lo + 200_000]
            out.append((row[own], start[own], stop[own], pa.array(a[own]), _long(h[own]), _long(c[own]), sure[own]))
        again = np.flatnonzero(sure)
        if len(again):
            wide = np.int64(1) << np.int64(40)  # documents side by side, so that one union serves all
            s, e = _merge(row[again] * wide + start[again], row[again] * wide + stop[again])
            n = len(s)
            out.append((s // wide, s % wide, e - (s // wide) * wide, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), np.ones(n, bool)))
        for r, s, e, a_, h_, c_, sure_ in out:
            yield pa.RecordBatch.from_arrays([doc.take(pa.array(r)), th.take(pa.array(r)), _long(s), _long(e), a_, h_, c_, pa.array(sure_)], names=schema.names)

    return docs.select("doc_id", "th", "text").mapInArrow(run, schema)


def _resolve(keys: list[str], passed: list[str]):
    """Streams rows sorted by ``keys`` = (key, value..): emits ``passed`` with repeated, mixed and ends."""
    def run(batches):
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held[0], part])
            n = part.num_rows
            if not n:
                continue
            cols = [part.column(k).to_numpy() for k in keys]
            same_key = cols[0][1:] == cols[0][:-1]
            same = same_key.copy()
            for c in cols[1:]:
                same &= c[1:] == c[:-1]
            with_prev = np.concatenate([[held is not None and held[1]], same])
            other = np.concatenate([[held is not None and held[2]], same_key & ~same])  # another value just before
            # a run inherits at its first row whether its key had another value before it
            run_id = np.cumsum(~with_prev) if with_prev[0] else np.cumsum(~with_prev) - 1
            starts = np.flatnonzero(~with_prev)
            first_other = np.zeros(int(run_id[-1]) + 1, bool)
            if with_prev[0]:
                first_other[0] = held[3]
                first_other[1:] = other[starts]
            else:
                first_other[:] = other[starts]
            yield_n = n - 1
            with_next = np.concatenate([same, [False]])
            next_other = np.concatenate([same_key & ~same, [False]])
            repeated = with_prev | with_next | np.asarray(part.column("sure").to_numpy(zero_copy_only=False), bool)
            mixed = first_other[run_id] | next_other
            if yield_n:
                out = part.slice(0, yield_n).select(passed)
                for name, v in (("repeated", repeated), ("mixed", mixed), ("ends", ~with_next)):
                    out = out.append_column(name, pa.array(v[:yield_n]))
                yield from out.combine_chunks().to_batches()
            held = (part.slice(n - 1, 1), bool(with_prev[-1]), bool(other[-1]) and not with_prev[-1], bool(first_other[run_id[-1]]))
        if held is not None:
            out = held[0].select(passed)
            sure = bool(held[0].column("sure")[0].as_py())
            for name, v in (("repeated", held[1] or sure), ("mixed", held[3] or held[2]), ("ends", True)):
                out = out.append_column(name, pa.array([v]))
            yield from out.combine_chunks().to_batches()
    return run


def resolve(rows: DataFrame, keys: list[str], passed: list[str]) -> DataFrame:
    """Rows with repeated (the row's values under ``keys`` stand twice, or ``sure``), mixed (the first key has other
    values too; known at the row that ends its run) and ends."""
    schema = rows.select(*passed).schema.add("repeated", "boolean").add("mixed", "boolean").add("ends", "boolean")
    return rows.repartition(keys[0]).sortWithinPartitions(*keys).mapInArrow(_resolve(keys, passed), schema)


def _cut(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes data[begin:end] of each pair."""
    off = np.concatenate([[0], np.cumsum(end - begin)])
    at = np.arange(off[-1]) + np.repeat(begin - off[:-1], end - begin)
    return pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data[at])])


def blocks(docs: DataFrame, mixed: DataFrame, length: int, block: int) -> DataFrame:
    """Blocks of the stretches ``mixed`` (doc_id, th, start, stop, a, c): (core, low, high, left, right, doc_id, th, x):
    the block's windows from ``x`` on have high..low left bytes.  Only documents that hold such a stretch are read."""
    lists = mixed.groupBy(F.col("doc_id").alias("of_id"), F.col("th").alias("of_th")).agg(
        F.collect_list(F.struct("start", "stop", "a", "c")).alias("found"))
    held = docs.join(lists, docs["doc_id"].eqNullSafe(lists["of_id"]) & (docs["th"] == lists["of_th"])).select("doc_id", "th", "text", "found")
    schema = docs.select("doc_id").schema.add("th", "long").add("core", "long").add("low", "integer").add("high", "integer")
    schema = schema.add("left", "binary").add("right", "binary").add("x", "long")

    def run(batches):
        seen = set()  # a repeated row brings its stretches again
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                found = rows.column("found")
                row = np.repeat(np.arange(rows.num_rows), found.value_lengths().to_numpy())
                start, stop, a, c = (found.flatten().field(k).to_numpy() for k in range(4))
                own = []
                for i, v in enumerate(c.tolist()):
                    if v not in seen:
                        seen.add(v)
                        own.append(i)
                if not own:
                    continue
                row, a = row[own], a[own]
                start, stop = start[own] + offsets[row], stop[own] + offsets[row]
                piece = start // PIECE
                for at in np.unique(piece) * PIECE:  # more than one only in a long document
                    pick = piece == at // PIECE
                    # the windows of a stretch share its anchor, so it is shorter than two of them
                    yield cut(rows, data[at:at + PIECE + 2 * length], offsets - at, row[pick], start[pick] - at, stop[pick] - at - length, a[pick])

    def cut(rows, data, offsets, row, lo, hi, a):
        cum, p = prefix_hash(data), lo + a
        k0, k1 = (p - hi) // block, a // block
        n = k1 - k0 + 1
        of = np.repeat(np.arange(len(p)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + k0[of]
        low = np.maximum((p - hi)[of] - k * block, 0)
        high = np.minimum((p - lo)[of] - k * block, block - 1)
        begin = p[of] - k * block
        end = begin + length - block + 1
        core = mix(span_hash(cum, begin, end) + k.astype(_U) * _SALT)
        own = pa.array(row[of])
        return pa.RecordBatch.from_arrays([
            rows.column("doc_id").take(own), rows.column("th").take(own), _long(core), pa.array(low.astype(np.int32)),
            pa.array(high.astype(np.int32)), _cut(data, begin - high, begin), _cut(data, end, end + block - 1 - low),
            _long(begin - high - offsets[row[of]])], names=schema.names)

    return held.mapInArrow(run, schema)


def _symbols(batches):
    """Strings of the blocks: left bytes, the core, right bytes, and an end of their own."""
    for batch in batches:
        out = []
        for sid, core, left, right in zip(*(batch.column(c).to_pylist() for c in ("sid", "core", "left", "right"))):
            out.append([*(b + 1 for b in left), (1 << 62) + ((core & 0xFFFFFFFFFFFFFFFF) >> 2), *(b + 1 for b in right), -1 - sid])
        yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array(out, pa.list_(pa.int64()))], names=["sid", "syms"])


def _windows(block: int, names: list[str]):
    """(rank, two hashes of the window's symbols, place) of every window of the strings."""
    def run(batches):
        for batch in batches:
            arr = batch.column("syms")
            off = arr.offsets.to_numpy().astype(np.int64)
            v = arr.values.to_numpy().astype(np.int64).view(_U)[off[0]:off[-1]]
            off = off - off[0]
            n = np.diff(off) - block  # the end symbol is no part of a window
            of = np.repeat(np.arange(len(n)), n)
            q = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = off[of] + q
            rank = batch.column("ranks").values.to_numpy().astype(np.int64)[batch.column("ranks").offsets.to_numpy()[0]:][at]
            k1, k2 = np.zeros(len(at), _U), np.zeros(len(at), _U)
            for j in range(block):
                s = v[at + j] + _U(j + 1)
                k1 = mix(k1 * _U(3) + s)
                k2 = mix(k2 * _U(5) + s * _SALT)
            own = pa.array(of)
            yield pa.RecordBatch.from_arrays([_long(rank), _long(k1), _long(k2), batch.column("doc_id").take(own), batch.column("th").take(own),
                                              _long(batch.column("x").to_numpy()[of] + q)], names=names)
    return run


def _neighbours(names: list[str]):
    """Rows in suffix order: whether a neighbour has the same prefix; ``edge`` marks the first (1) and last (2) of a range."""
    def run(batches):
        pid, held, before, first = TaskContext.get().partitionId(), None, False, True

        def emit(part, same, edge):
            out = part.append_column("same", pa.array(same)).append_column("pid", pa.array(np.full(len(same), pid), pa.int64()))
            return out.append_column("edge", pa.array(edge, pa.int32())).select(names).combine_chunks().to_batches()

        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            n = part.num_rows
            if not n:
                continue
            k1, k2 = part.column("k1").to_numpy(), part.column("k2").to_numpy()
            same = np.zeros(n + 1, bool)
            same[1:-1] = (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])
            same[0] = before
            if n > 1:
                edge = np.zeros(n - 1, np.int32)
                edge[0] = 1 if first else 0
                first = False
                yield from emit(part.slice(0, n - 1), (same[:-1] | same[1:])[:-1], edge)
            held, before = part.slice(n - 1, 1), bool(same[n - 1])
        if held is not None:
            yield from emit(held, np.array([before]), np.array([3 if first else 2], np.int32))
    return run


def array_repeats(strings: DataFrame, block: int) -> DataFrame:
    """(doc_id, th, x) of the windows of ``strings`` that agree with a neighbour in the suffix array."""
    syms = save(strings.select("sid", "core", "left", "right").mapInArrow(_symbols, "sid long, syms array<bigint>"), "syms")
    joined = syms.join(suffix_ranks(syms), "sid").join(strings.select("sid", "doc_id", "th", "x"), "sid")
    schema = strings.select("doc_id", "th").schema
    names = ["rank", "k1", "k2", "doc_id", "th", "x"]
    full = joined.select(F.lit(0).cast("long").alias("rank"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), *schema.names, "x").schema
    rows = joined.select("syms", "ranks", "doc_id", "th", "x").mapInArrow(_windows(block, names), full)
    out_names = [*names[1:], "same", "pid", "edge"]
    out = full
    for name, kind in (("same", "boolean"), ("pid", "long"), ("edge", "integer")):
        out = out.add(name, kind)
    out = type(out)([f for f in out.fields if f.name != "rank"])
    seen = save(rows.repartitionByRange("rank").sortWithinPartitions("rank").mapInArrow(_neighbours(out_names), out), "order")
    edges = sorted((r.pid, r.edge, r.k1, r.k2) for r in seen.where("edge > 0").select("pid", "edge", "k1", "k2").collect())  # two a range
    ends: dict[int, list] = {}
    for pid, edge, k1, k2 in edges:
        ends.setdefault(pid, []).append((edge, (k1, k2)))
    over, order = [], sorted(ends)
    for p, q in zip(order, order[1:]):
        last, first = ends[p][-1], ends[q][0]
        if last[1] == first[1]:
            over += [p * 4 + last[0], q * 4 + first[0]]
    met = F.col("same") | (F.col("pid") * 4 + F.col("edge")).isin(over) & (F.col("edge") > 0) if over else F.col("same")
    return seen.where(met).select("doc_id", "th", "x")


def repeats(docs: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """(doc_id, th, start, stop): stretches of bytes that repeated windows cover; they may overlap.  ``docs`` needs doc_id,
    th (hash of the text) and text."""
    block = min(block, length)
    first = save(first_pass(docs, length), "stretches")
    met = save(resolve(first.where("h is not null"), ["h", "c"], ["doc_id", "th", "start", "stop", "a", "c"])
               .where("repeated or (mixed and ends)"), "met")
    out = first.where("h is null").select("doc_id", "th", "start", "stop")
    out = out.unionByName(met.where("repeated").select("doc_id", "th", "start", "stop"))
    # a task gives its sure stretches once; their other places are in the rows without h
    mixed = met.where("mixed and ends").select("doc_id", "th", "start", "stop", "a", "c")  # one place of each
    cut = blocks(docs, mixed, length, block).withColumn("sure", F.lit(False))
    known = save(resolve(cut, ["core", "low", "high", "left", "right"], ["core", "low", "high", "left", "right", "doc_id", "th", "x"])
                 .where("repeated or (mixed and ends)").withColumn("sid", F.monotonically_increasing_id()), "blocks")
    out = out.unionByName(known.where("repeated").select("doc_id", "th", F.col("x").alias("start"), (F.col("x") + F.col("high") - F.col("low") + length).alias("stop")))
    found = array_repeats(known.where("mixed and ends"), block)
    return out.unionByName(found.select("doc_id", "th", F.col("x").alias("start"), (F.col("x") + length).alias("stop")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the removed runs as (start, stop) and the remaining bytes of each document."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    spans = repeats(docs, length, block).groupBy(F.col("doc_id").alias("of_id"), F.col("th").alias("of_th")).agg(
        F.collect_list(F.struct("start", "stop")).alias("found"))
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(spans["of_id"]) & (docs["th"] == spans["of_th"]), "left").select("doc_id", "text", "found")
    schema = docs.sparkSession.createDataFrame([], "n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary").schema
    schema = type(schema)([docs.schema["doc_id"], *schema.fields])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for batch in batches:
            for rows, data, offsets in common.text_slices(batch):
                raw = data.tobytes()
                kept, spans = [], []
                for i, found in enumerate(rows.column("found")):
                    own = raw[offsets[i]:offsets[i + 1]]
                    if not found.is_valid:
                        kept.append(own), spans.append([])
                        continue
                    values = found.values
                    s, e = _merge(values.field("start").to_numpy(), values.field("stop").to_numpy())
                    spans.append([{"start": int(a), "stop": int(b)} for a, b in zip(s, e)])
                    kept.append(b"".join(own[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(own)])))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(offsets)), pa.array(spans, kind), pa.array(kept, pa.binary())],
                                                 names=schema.names)

    return joined.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
