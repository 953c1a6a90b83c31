"""The corpus pipeline: documents through five operators, each stage written as Parquet and read again.

Language identification drops documents without a language; line dedup cuts repeated lines and drops documents that lose
all their lines; the n-gram Jaccard join keeps one document of each group; decontamination drops documents that hold a
benchmark item; mixing repeats or leaves out documents to reach the sources' target weights.

Null texts go at the first stage (no language).  Empty tables pass through as empty tables; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covspark.llm import decontaminate, langid, line_dedup, mixing, ngram_join
from covspark.llm.common import save, table


def _aside(docs: DataFrame, work) -> DataFrame:
    """``work(docs)`` with the user's own columns under names that no operator uses, and back."""
    own = {c: f"__user_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang", "source", "n_chars")}
    return work(docs.withColumnsRenamed(own)).withColumnsRenamed({v: k for k, v in own.items()})


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language was found."""
    def work(d):
        return langid.predict(d, langid.train(d)).where("lang_pred <> 'und'").select(*d.columns)
    return _aside(docs, work)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; n_chars follows the text."""
    def work(d):
        left = line_dedup.dedup(d).where("n_lines = 0 or n_dropped < n_lines")
        return left.select(*[F.length("text").cast(d.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in d.columns])
    return _aside(docs, work)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group of near copies."""
    return _aside(docs, ngram_join.keep_first)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _aside(docs, lambda d: decontaminate.drop_contaminated(d, table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: each document as often as it is taken."""
    return mixing.emit(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("ngram_join", join_near_copies),
    ("decontaminate", drop_benchmark),
    ("mix", mix_sources),
]

# Mixture inference, edit distance and SimHash are no SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
