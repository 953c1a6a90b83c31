"""Personal data: base patterns against plain regular expressions, the model's gradient, edge cases."""

import random
import re

import numpy as np
import pytest

from covspark.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            s = m.group()
            d = [int(c) for c in s if c.isdigit()]
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in s.split(".")),
                  "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_match_plain_patterns():
    rng = random.Random(5)
    parts = ["a.b@c.de", "x@y", "@", "10.0.0.256", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (407) 555-7710",
             "+1", " ", ".", "é", "9", "12", "@b.c", "a@b.c@d.e", "-", "+44 20 7946 0958 ", "%"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + "(" * 300_000):
        pii.base_spans(text)


def test_gradient():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in pii.init_params().items()}
    x, y = rng.integers(0, pii.CLASSES, (3, 6)), rng.integers(0, pii.TAGS, (3, 6))
    _, grad = pii.loss_grad(p, x, y)
    for name in p:
        at = tuple(rng.integers(0, s) for s in p[name].shape) if name not in ("xf", "xb") else (x[0, 2], 5)
        step = 1e-3
        p[name][at] += step
        up, _ = pii.loss_grad(p, x, y)
        p[name][at] -= 2 * step
        down, _ = pii.loss_grad(p, x, y)
        p[name][at] += step
        assert grad[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_windows_cover_every_hint():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("abc   7@") if rng.random() < .1 else "x" for _ in range(rng.randint(0, 400)))
        covered = {j for s in pii.window_starts(text) for j in range(s, s + pii.WIDTH)}
        for m in re.finditer("[0-9@]", text):
            lo, hi = max(0, m.start() - pii.REACH), min(len(text), m.start() + pii.REACH)
            assert set(range(lo, hi)) <= covered


def test_model_learns_and_base_spans_stay(spark):
    rng = random.Random(3)
    rows = [(i, f"word {rng.choice('abc')} mail{i}@host{i % 9}.example.com and +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} end",
             "clash") for i in range(150)]
    rows += [(900, None, ""), (901, "", ""), (902, rows[0][1], ""), (903, "x" * 50_000 + " a@b.cd " + "y" * 50_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    model = pii.fit(docs)
    x = pii.training_windows(docs).toPandas()
    tags = pii.viterbi(model, np.array([[ord(c) - 65 for c in s] for s in x["x"]]))
    gold = np.array([[int(c) for c in s] for s in x["y"]])
    assert (tags == gold).mean() > 0.9
    got = {r.doc_id: r for r in pii.find(docs, model).collect()}
    for doc_id, text, _ in rows:
        base = [f"{k}:{b}:{e}" for k, b, e in plain(text or "")]
        assert got[doc_id].base == base
        assert set(base) <= set(got[doc_id].spans)
    assert got[900].spans == [] and got[902].spans == got[0].spans
    hidden = {r.doc_id: r.text for r in pii.mask(docs.drop("spans"), model).collect()}
    assert hidden[900] is None and "@" not in hidden[0] and "<email>" in hidden[0]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.fit(docs) is None
    assert pii.find(docs, None).count() == 0


def test_long_digit_runs_and_linear_merging():
    zeros = "0" * 5000
    assert pii.base_spans(f"x {zeros}.1.1.1 y") == [("ip", 2, 5008)]
    assert not pii.base_spans(f"x {zeros}256.1.1.1 y") and not pii.valid("ip", "9" * 5000 + ".1.1.1")
    text = "+4912345678901 " * 4000
    spans = [("phone", k * 15, k * 15 + 14) for k in range(0, 4000, 2)]
    found = [("phone", k * 15, k * 15 + 14) for k in range(4000)]
    assert pii.add_spans(text, spans, found) == found
    assert pii.add_spans(text, spans, [("phone", 3, 14), ("phone", 15, 29)]) == sorted([*spans, ("phone", 15, 29)])


def test_query_counts_base_spans_only(spark, tmp_path, monkeypatch):
    """A span that the model adds is listed in ``spans``; the counts stay those of the contract's patterns."""
    text = "call 0301 2345678 or mail a@b.cd"
    spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    phone = text.index("0301")
    monkeypatch.setattr(pii, "fit", lambda docs: {})
    base, decoded = pii.base_spans(text), [("phone", phone, phone + 12)]
    assert pii.add_spans(text, base, decoded) != base
    monkeypatch.setattr(pii, "find", lambda docs, model, keep=None: docs.sparkSession.createDataFrame(
        [(1, [f"{k}:{b}:{e}" for k, b, e in base], [f"{k}:{b}:{e}" for k, b, e in pii.add_spans(text, base, decoded)]), (2, [], [])],
        "doc_id long, base array<string>, spans array<string>"))
    got = {r.doc_id: r for r in pii.query(spark, str(tmp_path)).collect()}
    assert (got[1].n_email, got[1].n_phone, got[1].n_ip, got[1].n_card) == (1, 0, 0, 0)
    assert got[1].spans.startswith("email:") and f"phone:{phone}:{phone + 12}" in got[1].spans
    assert (got[2].n_email, got[2].n_phone, got[2].spans) == (0, 0, "")
