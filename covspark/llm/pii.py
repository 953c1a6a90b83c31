"""Personal data: base patterns, and a character BiLSTM-CRF trained in numpy that adds spans to them.

The model is a bidirectional LSTM over character classes with CRF transitions, trained on windows labelled by the
base spans: the ``TRAIN_WINDOWS`` windows with the smallest hash (a bounded sample).  Every kind needs a digit or an
``@``, so windows of 64 characters, 32 apart, cover each stretch within 32 characters of such a character: no other
text can hold a span.  Each window is decoded by Viterbi; where windows overlap, the one whose middle is nearest
decides a character's tag, and spans are read from the reconciled sequence of the whole document.  A decoded span is
added if it meets its kind's check and overlaps no base span.

Defined results: a null or empty text has no spans; very long texts are searched whole, in linear time; repeated rows
get equal results; an empty table (or one without labelled windows) gives base spans only; input columns named like
an added one are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_text_columns, table, text_slices

KINDS = ("email", "ip", "card", "phone")
WIDTH, STRIDE, REACH = 64, 32, 32
HIDDEN, TAGS = 12, 1 + 2 * len(KINDS)  # tag 0: outside; 1 + 2k: begin, 2 + 2k: inside
TRAIN_WINDOWS = 1200
STEPS = 800
DECODE_WINDOWS = 4096

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can't begin inside a digit run that has failed from its first digit: the look-behind keeps this linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")


def _digits(s: str) -> list[int]:
    return [ord(c) - 48 for c in s if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind: str, s: str) -> bool:
    if kind == "email":
        at = s.find("@")
        return at > 0 and _DOMAIN.fullmatch(s, at + 1) is not None
    if kind == "ip":
        parts = s.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and (len(q := p.lstrip("0")) < 3 or len(q) == 3 and q <= "255") for p in parts)
    if kind == "card":
        d = _digits(s)
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(_digits(s)) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind; failing ones are dropped.  Code points, end exclusive."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append(("email", begin, m.end()))
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", max(at + 1, last))
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m.group())]
    return out


# -- the model ------------------------------------------------------------------

_OWN = "@.-+() _%:/,\n"
CLASSES = 5 + len(_OWN)
_CLASS = np.full(128, 4, np.int64)
_CLASS[48:58], _CLASS[97:123], _CLASS[65:91] = 0, 1, 2
for _i, _c in enumerate(_OWN):
    _CLASS[ord(_c)] = 5 + _i


def char_classes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(cp < 128, _CLASS[np.minimum(cp, 127)], 3)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def init_params(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for d in "fb":
        p["x" + d] = rng.normal(0, 0.3, (CLASSES, 4 * HIDDEN)).astype(np.float32)
        p["h" + d] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
    p["o"] = rng.normal(0, 0.3, (2 * HIDDEN, TAGS)).astype(np.float32)
    p["ob"] = np.zeros(TAGS, np.float32)
    p["t"] = np.zeros((TAGS, TAGS), np.float32)
    return p


def _lstm(x: np.ndarray, wx, wh, reverse: bool):
    """x: classes (n, T).  Hidden states (n, T, H) and what the gradient needs."""
    n, steps = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    hs, tape = np.zeros((n, steps, HIDDEN), np.float32), []
    for t in (range(steps - 1, -1, -1) if reverse else range(steps)):
        z = wx[x[:, t]] + h @ wh
        i, f, o = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN:2 * HIDDEN] + 1), _sigmoid(z[:, 2 * HIDDEN:3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN:])
        c_old, h_old = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        hs[:, t] = h
        tape.append((t, i, f, o, g, c_old, h_old, tc))
    return hs, tape


def _lstm_back(x, wh, dhs, tape, dwx, dwh):
    n = x.shape[0]
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t, i, f, o, g, c_old, h_old, tc in reversed(tape):
        dh = dh + dhs[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c_old * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        np.add.at(dwx, x[:, t], dz)
        dwh += h_old.T @ dz
        dh, dc = dz @ wh.T, dc * f


def emissions(p, x):
    hf, tf = _lstm(x, p["xf"], p["hf"], False)
    hb, tb = _lstm(x, p["xb"], p["hb"], True)
    hs = np.concatenate([hf, hb], axis=2)
    return hs @ p["o"] + p["ob"], hs, tf, tb


def _lse(a, axis):
    m = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - m).sum(axis=axis)) + m.squeeze(axis)


def loss_grad(p, x, y):
    """Mean CRF negative log-likelihood and its gradient."""
    e, hs, tf, tb = emissions(p, x)
    n, steps, _ = e.shape
    a, b = np.zeros_like(e), np.zeros_like(e)
    a[:, 0] = e[:, 0]
    for t in range(1, steps):
        a[:, t] = e[:, t] + _lse(a[:, t - 1][:, :, None] + p["t"], 1)
    for t in range(steps - 2, -1, -1):
        b[:, t] = _lse(p["t"] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
    z = _lse(a[:, -1], 1)
    de = np.exp(a + b - z[:, None, None])
    dt = np.zeros_like(p["t"])
    for t in range(steps - 1):
        dt += np.exp(a[:, t][:, :, None] + p["t"] + (e[:, t + 1] + b[:, t + 1])[:, None, :] - z[:, None, None]).sum(axis=0)
    rows = np.arange(n)[:, None]
    gold = e[rows, np.arange(steps), y].sum(axis=1) + p["t"][y[:, :-1], y[:, 1:]].sum(axis=1)
    de[rows, np.arange(steps), y] -= 1
    np.subtract.at(dt, (y[:, :-1], y[:, 1:]), 1)
    de, dt = (de / n).astype(np.float32), (dt / n).astype(np.float32)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    flat = hs.reshape(-1, 2 * HIDDEN)
    grad["o"], grad["ob"], grad["t"] = flat.T @ de.reshape(-1, TAGS), de.sum(axis=(0, 1)), dt
    dhs = de @ p["o"].T
    _lstm_back(x, p["hf"], dhs[:, :, :HIDDEN], tf, grad["xf"], grad["hf"])
    _lstm_back(x, p["hb"], dhs[:, :, HIDDEN:], tb, grad["xb"], grad["hb"])
    return float((z - gold).mean()), grad


def train_model(x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = 64, rate: float = 0.02):
    """Adam over shuffled batches with a falling rate; no windows: no model (None)."""
    if not len(x):
        return None
    p, rng = init_params(), np.random.default_rng(11)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if not len(order):
            order = rng.permutation(len(x))
        own, order = order[:batch], order[batch:]
        _, g = loss_grad(p, x[own], y[own])
        now = rate * (1 - step / (steps + 1))
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
            p[k] -= (now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
    return p


def viterbi(p, x: np.ndarray) -> np.ndarray:
    e = emissions(p, x)[0]
    n, steps, _ = e.shape
    back, score = np.zeros((n, steps, TAGS), np.int8), e[:, 0]
    for t in range(1, steps):
        s = score[:, :, None] + p["t"]
        back[:, t] = s.argmax(axis=1)
        score = s.max(axis=1) + e[:, t]
    path = np.zeros((n, steps), np.int8)
    path[:, -1] = score.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        path[:, t - 1] = back[np.arange(n), t, path[:, t]]
    return path


def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows over every stretch near a digit or ``@``."""
    out, lo, hi = [], None, -1
    for m in _HINT.finditer(text):
        if lo is not None and m.start() - REACH <= hi:
            hi = m.start() + REACH
            continue
        if lo is not None:
            out += range(lo, max(lo + 1, hi - STRIDE), STRIDE)
        lo, hi = max(0, m.start() - REACH), m.start() + REACH
    if lo is not None:
        out += range(lo, max(lo + 1, hi - STRIDE), STRIDE)
    return out


def _window(classes: np.ndarray, start: int) -> np.ndarray:
    w = classes[start:start + WIDTH]
    return w if len(w) == WIDTH else np.concatenate([w, np.full(WIDTH - len(w), CLASSES - 1)])


def model_spans(p, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Decoded spans of each text, from the reconciled windows."""
    owner, starts, rows = [], [], []
    tags = [dict() for _ in texts]

    def flush():
        if not rows:
            return
        paths = viterbi(p, np.stack(rows))
        for k, s, path in zip(owner, starts, paths):
            near = np.abs(np.arange(WIDTH) - (WIDTH - 1) / 2)
            own = tags[k]
            for j in range(WIDTH):
                old = own.get(s + j)
                if old is None or near[j] < old[0]:
                    own[s + j] = (near[j], int(path[j]))
        owner.clear(), starts.clear(), rows.clear()

    for k, text in enumerate(texts):
        at = window_starts(text)
        if not at:
            continue
        classes = char_classes(text)
        for s in at:
            owner.append(k), starts.append(s), rows.append(_window(classes, s))
            if len(rows) >= DECODE_WINDOWS:
                flush()
    flush()
    out = []
    for text, own in zip(texts, tags):
        spans, kind, begin, last = [], -1, 0, -2
        for pos in sorted(own):
            tag = own[pos][1] if pos < len(text) else 0
            k = (tag - 1) // 2 if tag else -1
            if kind >= 0 and (k != kind or tag % 2 or pos != last + 1):
                spans.append((KINDS[kind], begin, last + 1))
                kind = -1
            if k >= 0 and kind < 0:
                kind, begin = k, pos
            last = pos
        if kind >= 0:
            spans.append((KINDS[kind], begin, last + 1))
        out.append(spans)
    return out


def add_spans(text: str, base: list[tuple[str, int, int]], decoded) -> list[tuple[str, int, int]]:
    """Base spans and the decoded ones that pass their kind's check and overlap none already there."""
    taken: list[list[int]] = []  # disjoint, in order
    for b, e in sorted((b, e) for _, b, e in base):
        if taken and b < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([b, e])
    ends = [e for _, e in taken]

    def free(b, e):
        k = bisect_right(ends, b)  # the first stretch that ends after b
        return k == len(taken) or taken[k][0] >= e

    extra = [(kind, b, e) for kind, b, e in decoded if free(b, e) and valid(kind, text[b:e])]
    return sorted([*base, *extra], key=lambda s: (KINDS.index(s[0]), s[1]))


def label(text: str, start: int, spans) -> str:
    tags = ["0"] * WIDTH
    for kind, b, e in spans:
        k = 1 + 2 * KINDS.index(kind)
        for pos in range(max(b, start), min(e, start + WIDTH)):
            tags[pos - start] = str(k if pos == b else k + 1)
    return "".join(tags)


def training_windows(docs: DataFrame, bound: int = TRAIN_WINDOWS) -> DataFrame:
    """Labelled windows: the ``bound`` with the smallest hash over the whole table."""
    def run(batches):
        for batch in batches:
            for rows, _, _ in text_slices(batch):
                hit = pc.match_substring_regex(rows.column("text").fill_null(""), "[0-9@]")
                xs, ys = [], []
                for text in rows.column("text").filter(hit).to_pylist():
                    spans = base_spans(text)
                    for s in window_starts(text):
                        xs.append("".join(chr(65 + c) for c in _window(char_classes(text[s:s + WIDTH]), 0)))
                        ys.append(label(text, s, spans))
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.string()), pa.array(ys, pa.string())], names=["x", "y"])

    return (docs.select("text").mapInArrow(run, "x string, y string").distinct()
            .orderBy(F.xxhash64("x", "y"), "x", "y").limit(bound))


def fit(docs: DataFrame, bound: int = TRAIN_WINDOWS):
    got = training_windows(docs, bound).toPandas()
    x = np.array([[ord(c) - 65 for c in s] for s in got["x"]], dtype=np.int64).reshape(-1, WIDTH)
    y = np.array([[int(c) for c in s] for s in got["y"]], dtype=np.int64).reshape(-1, WIDTH)
    return train_model(x, y)


def find(docs: DataFrame, model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with base and spans, arrays of "kind:start:end" by kind, then start."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows, data, offsets):
        p = shared.value
        column = rows.column("text").fill_null("")
        hit = np.flatnonzero(pc.match_substring_regex(column, "[0-9@]").to_numpy(zero_copy_only=False))
        texts = column.take(pa.array(hit)).to_pylist()
        base = [base_spans(t) for t in texts]
        decoded = model_spans(p, texts) if p is not None else [[]] * len(texts)
        bases, spans = [[]] * rows.num_rows, [[]] * rows.num_rows
        for i, t, b, d in zip(hit, texts, base, decoded):
            bases[i] = [f"{k}:{x}:{y}" for k, x, y in b]
            spans[i] = [f"{k}:{x}:{y}" for k, x, y in add_spans(t, b, d)]
        return [pa.array(bases, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.string()))]

    return add_text_columns(docs, "base array<string>, spans array<string>", run, keep=keep)


def mask(docs: DataFrame, model) -> DataFrame:
    """``docs`` with every span's characters in ``text`` replaced by its kind in angle brackets (overlaps: the
    earliest span, the longest first)."""
    def put(text, spans):
        out, at = [], 0
        for b, e, k in sorted((int(b), -int(e), k) for k, b, e in (s.split(":") for s in spans)):
            if b >= at:
                out += [text[at:b], f"<{k}>"]
                at = -e
        return "".join([*out, text[at:]])

    def run(rows, data, offsets):
        texts, spans = rows.column("text").to_pylist(), rows.column("spans").to_pylist()
        return [pa.array([t if t is None or not s else put(t, s) for t, s in zip(texts, spans)], pa.string())]

    found = find(docs, model)
    return add_text_columns(found, "masked string", run).withColumn("text", F.col("masked")).drop("masked", "base", "spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit(docs), keep=["doc_id"])
    # the counts are those of the contract's patterns, like base_sha256; added spans are in ``spans`` only.  The test
    # must take one argument: Spark would pass an element's position as a second one.
    def of_kind(kind):
        return lambda s: s.startswith(f"{kind}:")

    count = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *count, F.sha2(F.array_join("base", ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join("spans", ",").alias("spans"))
