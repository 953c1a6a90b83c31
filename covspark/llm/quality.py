"""Quality classifier: a sparse rule ensemble over text statistics.

Boosted shallow trees are grown on the statistics of a bounded labelled sample (the ``SAMPLE`` labelled documents with
the smallest hash of the id); every path from the root is a conjunctive rule; lasso logistic regression keeps the few
rules that carry weight, and these are compiled into Spark column expressions.  Scoring is one native projection.

Defined results: null and empty texts have all statistics 0 and get the score that the rules give to zeros; without
labelled documents (or with one class only) no rule is kept and every score is the share of label 1 (0.5 without any
label); several labels of one document count as their mean, 1 from 0.5 on; repeated documents are scored alike; an
empty table gives an empty result; input columns named like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, table

SAMPLE = 20_000
TREES, DEPTH, RATE, BINS = 40, 3, 0.15, 32
LASSO = 0.002
HELD_OUT = (3, 1)


def statistics() -> dict[str, Column]:
    """Name and column of each statistic of ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return {
        "chars": F.length(text).cast("double"),
        "words": count(r"[^\x20\x09-\x0D]+"),
        "capitals": count(r"[A-Z]{2,}"),
        "symbols": count(r"[#$%&*!|<>{}=_~^\\]+"),
        "digits": count(r"[0-9]+"),
        "stops": count(r"[.?;:]"),
        "lines": F.size(F.split(text, "\n")).cast("double"),
        "own_lines": F.size(F.array_distinct(F.split(text, "\n"))).cast("double"),
        "own_words": F.size(F.array_distinct(F.split(text, r"[\x20\x09-\x0D]+"))).cast("double"),
    }


def features() -> dict[str, Column]:
    """What the trees see: sizes and shares of the statistics' columns."""
    c = F.col
    share = lambda a, b: c(a) / F.greatest(c(b), F.lit(1.0))
    return {
        "chars": c("chars"), "words": c("words"), "word_length": share("chars", "words"),
        "capitals": share("capitals", "words"), "symbols": share("symbols", "words"),
        "digits": share("digits", "words"), "stops": share("stops", "words"),
        "line_words": share("words", "lines"), "own_lines": share("own_lines", "lines"),
        "own_words": share("own_words", "words"),
    }


@dataclass(frozen=True)
class Rule:
    """All of feature > low and feature <= high."""
    bounds: tuple[tuple[str, float, float], ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = None
        for name, low, high in self.bounds:
            one = (x[name] > low) & (x[name] <= high)
            out = one if out is None else out & one
        return out

    def column(self) -> Column:
        out = None
        for name, low, high in self.bounds:
            for one in ([F.col(name) > F.lit(low)] if low > -np.inf else []) + ([F.col(name) <= F.lit(high)] if high < np.inf else []):
                out = one if out is None else out & one
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        """The score as a column over the features' names."""
        z = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            z = z + F.when(rule.column(), F.lit(float(weight))).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-z))


def _grow(binned, grad, hess, rows, depth, bounds, cuts, names, leaves, rules):
    """One tree by the best split of the second-order gain; collects leaf values and every path as bounds."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, None, None)
    if depth and len(rows) >= 20:
        for k in range(len(names)):
            n = len(cuts[k]) + 1
            gs = np.cumsum(np.bincount(binned[rows, k], grad[rows], n))[:-1]
            hs = np.cumsum(np.bincount(binned[rows, k], hess[rows], n))[:-1]
            if len(gs):
                gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g ** 2 / (h + 1)
                gain[(hs < 1) | (h - hs < 1)] = 0
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], k, at)
    if best[1] is None:
        leaves.append((rows, -g / (h + 1)))
        return
    _, k, at = best
    left = binned[rows, k] <= at
    for side, own in ((0, rows[left]), (1, rows[~left])):
        low, high = bounds.get(names[k], (-np.inf, np.inf))
        cut = float(cuts[k][at])
        inner = bounds | {names[k]: (low, min(high, cut)) if side == 0 else (max(low, cut), high)}
        rules.add(Rule(tuple((n, *inner[n]) for n in sorted(inner))))
        _grow(binned, grad, hess, own, depth - 1, inner, cuts, names, leaves, rules)


def extract_rules(x: dict[str, np.ndarray], y: np.ndarray) -> list[Rule]:
    names = list(x)
    cuts = [np.unique(np.quantile(x[n], np.linspace(0, 1, BINS + 1)[1:-1])) for n in names]
    binned = np.stack([np.searchsorted(c, x[n], "left") for n, c in zip(names, cuts)], axis=1)
    rules: set[Rule] = set()
    z = np.zeros(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        leaves: list = []
        _grow(binned, p - y, p * (1 - p), np.arange(len(y)), DEPTH, {}, cuts, names, leaves, rules)
        for rows, value in leaves:
            z[rows] += RATE * value
    return sorted(rules, key=lambda r: r.bounds)


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float = LASSO, rounds: int = 400):
    """Weights and intercept by accelerated proximal gradient over standardised columns."""
    mean, std = a.mean(axis=0), a.std(axis=0) + 1e-9
    s = (a - mean) / std
    step = 4.0 / (np.linalg.norm(s, 2) ** 2 / len(y) + 1)
    w = v = np.zeros(s.shape[1])
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    b = vb = float(np.log(share / (1 - share)))
    t = 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-(s @ v + vb))) - y
        w_new = v - step * (s.T @ r) / len(y)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * penalty, 0)
        b_new = vb - step * r.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w / std, b - float((w / std * mean).sum())


def fit_rules(x: dict[str, np.ndarray], y: np.ndarray) -> RuleEnsemble:
    if not len(y) or y.min() == y.max():
        share = min(max((y.sum() + 0.5) / (len(y) + 1), 1e-3), 1 - 1e-3)
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    rules, held, seen = [], [], set()
    for rule in extract_rules(x, y):
        h = rule.holds(x)
        sides = {h.tobytes(), (~h).tobytes()}
        if h.any() and not h.all() and not sides & seen:
            seen |= {h.tobytes()}
            rules.append(rule)
            held.append(h)
    if not rules:
        return RuleEnsemble(float(np.log(y.mean() / (1 - y.mean()))), ())
    w, b = lasso_logistic(np.stack(held, axis=1).astype(np.float64), y)
    return RuleEnsemble(b, tuple((r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-9))


def with_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns as one struct ``row``, and the features."""
    stats = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), *[c.alias(n) for n, c in statistics().items()])
    return stats.select("row", *[c.alias(n) for n, c in features().items()])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleEnsemble:
    """Fit on the labelled documents of ``labels`` (doc_id, quality)."""
    known = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most ``sample`` ids
    got = with_features(rows, ["y"]).select("row.y", *features()).toPandas()
    return fit_rules({n: got[n].to_numpy(dtype=float) for n in features()}, got["y"].to_numpy(dtype=float))


def score(docs: DataFrame, model: RuleEnsemble, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``quality_score``, the estimated chance of label 1."""
    keep = [c for c in (keep or docs.columns) if c != "quality_score"]
    return with_features(docs, keep).select("row.*", model.column().alias("quality_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    mod, out = HELD_OUT
    model = fit(docs, labels.where(crc_mod("doc_id", mod) != out))
    s = F.col("quality_score")
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", (crc_mod("doc_id", mod) == out).alias("held_out"), s.alias("score"), (s >= 0.5).cast("int").alias("predicted"))
