"""Language identification by multilingual mixture inference.

A document is taken as a mixture of languages: its text is cut into blocks of 64 bytes, each block written in one
language, and expectation-maximisation estimates the document's language proportions from the blocks' n-gram
likelihoods (hashed byte 4-grams, one multinomial for each learned language).  The set of languages is selected by
penalised likelihood: nested sets, taken in order of the full mixture's proportions, are each fitted again, and
every further language must gain more than half the log of the number of blocks.

The n-gram model is fitted on a bounded sample of labelled documents: the ``SAMPLE_PER_LANG`` of each language with
the smallest hash of the id.  Predictions use whole texts.

Defined results: a null text, a text without a letter, or an empty model gives ``und`` with score 0; ties go to the
language first in code point order; repeated rows are scored alike; an empty table gives an empty result; input
columns named like an added one are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import add_text_columns, crc_mod, table, text_slices

BITS = 16
BLOCK = 64
ROUNDS = 8
TEMPER = 0.25  # neighbouring n-grams overlap, so their likelihoods count in part
SAMPLE_PER_LANG = 1500
PARTS = 256
HELD_OUT = (4, 2)

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def gram_ids(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bucket of the 4 bytes from each position on; -1 where they'd leave the row."""
    if not len(data):
        return np.zeros(0, np.int64)
    d = np.concatenate([_FOLD[data], np.zeros(3, np.uint32)])
    v = d[:-3] | (d[1:-2] << 8) | (d[2:-1] << 16) | (d[3:] << 24)
    ids = ((v * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
    ends = offsets[1:][np.diff(offsets) > 0]
    for k in (1, 2, 3):
        ids[np.maximum(ends - k, 0)] = -1
    return ids


class Model:
    """Log-likelihoods (bucket + 1, language) less their mean over the languages; the last row is 0."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        p = (counts + 0.5) / (counts + 0.5).sum(axis=0) if langs else np.ones((1 << BITS, 0))
        ll = np.log(p)
        ll = ll - ll.mean(axis=1, keepdims=True) if langs else ll
        self.ll = np.vstack([ll, np.zeros((1, len(langs)))]).astype(np.float32)


def smallest(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows (doc_id, lang) of each language with the smallest hash of the id: ranked within ``PARTS`` parts of a
    language, then once more over the n rows left of each, so no task sorts a whole language."""
    def top(rows: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id")
        return rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n).drop("r")

    # by row and not by id, so that a repeated id is spread too; rows that tie are alike, so the parts don't matter
    parts = rows.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)))
    return top(top(parts, "lang", "part").drop("part"), "lang")


def fit(labelled: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on (doc_id, text, lang); rows with a null lang or text are left out."""
    spark = labelled.sparkSession
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    chosen = smallest(rows.select("doc_id", "lang"), sample_per_lang)
    sample = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")  # at most sample_per_lang a language

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                ids = gram_ids(data, offsets)
                langs = part.column("lang").to_pylist()
                for i, lang in enumerate(langs):
                    own = ids[offsets[i]:offsets[i + 1]]
                    total.setdefault(lang, np.zeros(1 << BITS, np.int64))
                    np.add.at(total[lang], own[own >= 0], 1)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                names=["lang", "bucket", "n"])

    got = (sample.mapInArrow(count, "lang string, bucket int, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(got["lang"].unique())
    counts = np.zeros((1 << BITS, len(langs)))
    for k, lang in enumerate(langs):
        own = got[got["lang"] == lang]
        counts[own["bucket"].to_numpy(), k] = own["n"].to_numpy()
    return Model(langs, counts)


def mixture(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Language proportions (row, language) of the selected set; rows without bytes get zeros."""
    n, k = len(offsets) - 1, len(model.langs)
    out = np.zeros((n, k))
    size = np.diff(offsets)
    full = np.flatnonzero(size > 0)
    if not len(full) or not k:
        return out
    blocks = (size[full] + BLOCK - 1) // BLOCK
    first = np.concatenate([[0], np.cumsum(blocks)])
    row = np.repeat(np.arange(len(full)), blocks)
    starts = offsets[full][row] + (np.arange(first[-1]) - first[row]) * BLOCK
    ll = TEMPER * np.add.reduceat(model.ll[gram_ids(data, offsets)], starts, axis=0)
    like = np.exp(ll - ll.max(axis=1, keepdims=True))

    def em(pi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(ROUNDS):
            r = pi[row] * like
            r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-300)
            pi = np.add.reduceat(r, first[:-1], axis=0) / blocks[:, None]
        seen = np.log(np.maximum((pi[row] * like).sum(axis=1), 1e-300))
        return pi, np.add.reduceat(seen, first[:-1])

    whole, _ = em(np.full((len(full), k), 1.0 / k))
    rank = np.argsort(np.argsort(-whole, axis=1, kind="stable"), axis=1)
    best, best_score = whole, np.full(len(full), -np.inf)
    for s in range(1, k + 1):
        pi, seen = em((rank < s) / float(s))
        score = seen - 0.5 * (s - 1) * np.log(blocks + 1.0)
        better = score > best_score + 1e-9
        best = np.where(better[:, None], pi, best)
        best_score = np.where(better, score, best_score)
    out[full] = best
    return out


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred, score (the share of lang_pred) and lang_mix (the selected languages' shares)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.langs, model.ll))
    flag = "__has_letter"
    names = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score", "lang_mix")]

    def score(rows, data, offsets):
        m = Model.__new__(Model)
        m.langs, m.ll = shared.value
        share = mixture(data, offsets, m)
        known = rows.column(flag).to_numpy(zero_copy_only=False).astype(bool) & (share.sum(axis=1) > 0)
        top = share.argmax(axis=1) if m.langs else np.zeros(len(known), int)
        pred = [m.langs[t] if ok else "und" for t, ok in zip(top, known)]
        value = [float(min(1.0, share[i, top[i]])) if ok else 0.0 for i, ok in enumerate(known)]
        mix = [[(m.langs[j], float(share[i, j])) for j in np.flatnonzero(share[i] > 0)] if ok else []
               for i, ok in enumerate(known)]
        return [pa.array(pred, pa.string()), pa.array(value, pa.float64()),
                pa.array(mix, pa.map_(pa.string(), pa.float64()))]

    marked = docs.withColumn(flag, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    limit = max(100_000, 8_000_000 // max(4, len(model.langs)))
    return add_text_columns(marked, "lang_pred string, score double, lang_mix map<string,double>", score,
                            keep=[*names, flag], limit=limit).drop(flag)


def train(docs: DataFrame) -> Model:
    """Learns from the documents that are not held out."""
    mod, out = HELD_OUT
    return fit(docs.where(crc_mod("doc_id", mod) != out))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mod, out = HELD_OUT
    found = predict(docs.select("doc_id", "text"), train(docs), keep=["doc_id"])
    return found.select("doc_id", (crc_mod("doc_id", mod) == out).alias("held_out"), "lang_pred", "score")
