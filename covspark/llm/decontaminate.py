"""Benchmark decontamination by SimHash over item-sized windows.

For an item of n words, windows of n words of each document are fingerprinted (64-bit SimHash of their five-word
shingles, weighted by how often each occurs).  A document of fewer words is one window as a whole.  A multi-index over eight 8-bit blocks guarantees every fingerprint
within ``RADIUS``: two such fingerprints differ by at most RADIUS // 8 bits in some block.  Candidates are then verified by
the exact weighted Jaccard similarity of the shingles, ``SIMILARITY`` or more.  A window without any shingle of an item
has similarity 0 with it and is not fingerprinted for it.

Words are runs of ASCII letters, digits and non-ASCII characters, lower-cased in A-Z, so punctuation and line breaks
don't matter.  Items are handled in blocks of about ``BLOCK_WORDS`` words, each broadcast in turn, over all documents.

Defined results: null or empty texts and items without words match nothing; an item of fewer than five words is one
shingle; repeated items, repeated documents and items with a null item_id are each reported; ties of a document's best window go to the earliest;
empty tables give no hits; extra columns are ignored by ``find_leaks`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import LOWER, _STEP, mix, prefix_hash, span_hash, table, text_slices, word_spans

WIDTH = 5
RADIUS = 22
SIMILARITY = 0.8
BLOCK_WORDS = 200_000

_U = np.uint64
_GAPS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_POP8 = np.array([bin(v).count("1") for v in range(256)], np.uint8)


def _words(data, offsets):
    begin, end, first = word_spans(data, offsets, _GAPS)
    return span_hash(prefix_hash(LOWER[data]), begin, end), first


def _shingles(w: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on."""
    n = max(0, len(w) - width + 1)
    s = np.full(n, width, _U)
    for k in range(width if n else 0):
        s += w[k:k + n] * _STEP[k]
    return mix(s)


def simhash(h: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` shingles from each start on; every occurrence of a shingle counts."""
    bits = (mix(h)[:, None] >> np.arange(64, dtype=_U)) & _U(1)
    cum = np.zeros((len(h) + 1, 64), np.int32)
    np.cumsum(bits.astype(np.int8) * 2 - 1, axis=0, out=cum[1:])
    on = (cum[starts + size] - cum[starts]) > 0
    return (on.astype(_U) << np.arange(64, dtype=_U)).sum(axis=1, dtype=_U)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two shingle bags; a shingle weighs as often as it occurs."""
    ka, na = np.unique(a, return_counts=True)
    kb, nb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    shared = int(np.minimum(na[ia], nb[ib]).sum())
    return shared / (len(a) + len(b) - shared)


class Items:
    """One block of items: shingles, fingerprints by window size, and the multi-index."""

    def __init__(self, ids: list, texts: list[str]):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        w, first = _words(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))
        self.ids, self.size, self.width, self.bags, prints = ids, np.diff(first), [], [], []
        for k in range(len(ids)):
            own = w[first[k]:first[k + 1]]
            width = min(WIDTH, len(own))
            self.width.append(width)
            self.bags.append(_shingles(own, width) if width else own)
            prints.append(simhash(self.bags[k], np.array([0]), len(self.bags[k]))[0] if width else _U(0))
        self.prints = np.array(prints, _U)
        pairs = [(h, k, width) for k, width in enumerate(self.width) for h in np.unique(self.bags[k])]
        self.tables = {}
        for width in sorted({x[2] for x in pairs}):
            h = np.array([x[0] for x in pairs if x[2] == width], _U)
            k = np.array([x[1] for x in pairs if x[2] == width])
            order = np.argsort(h, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[(h >> _U(44)).astype(np.int64)] = True
            self.tables[width] = (seen, h[order], k[order])

    def hits(self, h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, item) of every shingle of ``h`` that an item has."""
        seen, keys, owner = self.tables[width]
        at = np.flatnonzero(seen[(h >> _U(44)).astype(np.int64)])
        lo, hi = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
        n = hi - lo
        take = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else lo, n) + np.arange(n.sum())
        return np.repeat(at, n), owner[take]


def near(prints: np.ndarray, item_prints: np.ndarray) -> np.ndarray:
    """(window, item) pairs within RADIUS, by the multi-index: blocks first, then the whole distance."""
    reach = RADIUS // 8
    pairs = []
    for b in range(8):
        own = (prints >> _U(8 * b)).astype(np.uint8)
        index = _POP8[np.arange(256, dtype=np.uint8)[:, None] ^ (item_prints >> _U(8 * b)).astype(np.uint8)[None, :]] <= reach
        pairs.append(np.argwhere(index[own]))
    got = np.unique(np.concatenate(pairs), axis=0)
    apart = np.bitwise_count(prints[got[:, 0]] ^ item_prints[got[:, 1]])
    return np.column_stack([got, apart])[apart <= RADIUS]


def leaks_in(items: Items, w: np.ndarray, h_of: dict[int, np.ndarray], lo: int, hi: int, hits: dict) -> list[tuple]:
    """Leaks in the words lo..hi of one document: (item, first word, words, hamming, similarity), the best of each item.
    hits: width -> (positions, items) within the document."""
    out = []
    for width, (pos, item) in hits.items():
        h = h_of[width]
        whole = h[lo:hi - width + 1]  # the one window for items of more words; fewer shingles can't reach the similarity
        cand = np.unique(item[items.size[item] > hi - lo])
        cand = cand[len(whole) >= SIMILARITY * (items.size[cand] - width + 1)]
        if len(cand):
            for _, j, apart in near(simhash(whole, np.array([0]), len(whole)), items.prints[cand]):
                sim = similarity(whole, items.bags[cand[j]])
                if sim >= SIMILARITY:
                    out.append((int(cand[j]), 0, hi - lo, int(apart), sim))
        for size in np.unique(items.size[item]):
            own = items.size[item] == size
            if hi - lo < size:
                continue
            span = int(size) - width + 1  # shingles of a window
            marks = np.zeros(hi - lo + 1, np.int64)
            p = np.unique(pos[own]) - lo
            np.add.at(marks, np.maximum(p - span + 1, 0), 1)
            np.add.at(marks, p + 1, -1)
            starts = np.flatnonzero(np.cumsum(marks)[:hi - lo - int(size) + 1] > 0) + lo
            if not len(starts):
                continue
            cand = np.unique(item[own])
            best: dict[int, tuple] = {}
            breaks = np.flatnonzero(np.diff(starts) > 1) + 1
            for run in np.split(starts, breaks):
                for at in range(0, len(run), 20_000):  # a long run in pieces: 64 counters a shingle
                    part = run[at:at + 20_000]
                    prints = simhash(h[part[0]:part[-1] + span], part - part[0], span)
                    for i, j, apart in near(prints, items.prints[cand]):
                        s, k = int(part[i]), int(cand[j])
                        sim = similarity(h[s:s + span], items.bags[k])
                        if sim >= SIMILARITY and (k not in best or sim > best[k][4]):
                            best[k] = (k, s - lo, int(size), int(apart), sim)
            out += best.values()
    return out


def _leaks_of_slice(items: Items, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
    """(row, item, first word, words, hamming, similarity) of every leak in a slice of documents."""
    w, first = _words(data, offsets)
    h_of = {width: _shingles(w, width) for width in items.tables}
    by_doc: dict[int, dict] = {}
    for width, h in h_of.items():
        pos, item = items.hits(h, width)
        doc = np.searchsorted(first, pos, "right") - 1
        inside = pos + width <= first[doc + 1]
        pos, item, doc = pos[inside], item[inside], doc[inside]
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for p, i, d in zip(np.split(pos, cuts), np.split(item, cuts), np.split(doc, cuts)):
            if len(d):
                by_doc.setdefault(int(d[0]), {})[width] = (p, i)
    return [(d, *x) for d, hits in sorted(by_doc.items())
            for x in leaks_in(items, w, h_of, int(first[d]), int(first[d + 1]), hits)]


def item_blocks(benchmark: DataFrame, block_words: int):
    """Blocks of about ``block_words`` words of items, one after another on the driver: (ids, texts)."""
    items = benchmark.where("text is not null").select("item_id", "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / 6 / block_words))  # about six characters a word
    for b in range(blocks):
        got = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        yield [r.item_id for r in got], [r.text for r in got]


def _loader(docs: DataFrame, ids: list, texts: list[str]):
    """The block's items inside a task, built once."""
    shared = docs.sparkSession.sparkContext.broadcast((ids, texts))
    made: list[Items] = []

    def load() -> Items:
        if not made:
            made.append(Items(*shared.value))
        return made[0]
    return load


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): each item's best window in each document."""
    schema = docs.select("doc_id").schema.add("item_id", benchmark.schema["item_id"].dataType)
    for name, kind in (("start_word", "long"), ("n_words", "long"), ("hamming", "integer"), ("similarity", "double")):
        schema = schema.add(name, kind)
    id_type = to_arrow_type(benchmark.schema["item_id"].dataType)  # a block may have null ids only
    out = None
    for ids, texts in item_blocks(benchmark, block_words):
        load = _loader(docs, ids, texts)

        def run(batches, load=load):
            items = load()
            for batch in batches:
                for rows, data, offsets in text_slices(batch):
                    found = _leaks_of_slice(items, data, offsets)
                    if found:
                        k = [x[1] for x in found]
                        yield pa.RecordBatch.from_arrays([
                            rows.column("doc_id").take(pa.array([x[0] for x in found])),
                            pa.array([items.ids[i] for i in k], id_type), pa.array([x[2] for x in found], pa.int64()),
                            pa.array([x[3] for x in found], pa.int64()),
                            pa.array([x[4] for x in found], pa.int32()), pa.array([x[5] for x in found], pa.float64()),
                        ], names=schema.names)

        one = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = one if out is None else out.unionAll(one)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item."""
    for ids, texts in item_blocks(benchmark, block_words):
        load = _loader(docs, ids, texts)

        def run(batches, load=load):
            items = load()
            for batch in batches:
                for rows, data, offsets in text_slices(batch):
                    clean = np.ones(rows.num_rows, bool)
                    clean[[x[0] for x in _leaks_of_slice(items, data, offsets)]] = False
                    yield rows.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
