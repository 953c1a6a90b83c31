"""Lyndon arrays and runs against their definitions, and the query's columns against a plain version."""

import hashlib
import random
import zlib

from covspark.llm import periodic


def plain_lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(s, least):
    n, out = len(s), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            b = i
            while i + q < n and s[i] == s[i + q]:
                i += 1
            e = i + q
            if i > b and e - b >= max(least, 2 * q) and not any(
                    all(s[x] == s[x + d] for x in range(b, e - d)) for d in range(1, q)):
                out.append((b, e - b, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_array():
    rng = random.Random(1)
    for _ in range(3000):
        s = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 16))]
        assert periodic.lyndon_array(s) == plain_lyndon(s)


def test_runs_of_words_and_texts():
    rng = random.Random(2)
    for _ in range(1500):
        s = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 36))]
        for least in (2, 5, 12):
            want = plain_runs(s, least)
            assert periodic.find_runs(s, least) == want
            text = " ".join("abc"[x] for x in s).encode()
            assert periodic.text_runs([text, b"a b", b"", text], least) == [want, [] if least > 2 else plain_runs([0, 1], 2), [], want]


def test_long_texts_stay_linear():
    assert periodic.find_runs([7] * 60_000) == [(0, 60_000, 1)]
    assert periodic.find_runs([0, 1] * 30_000) == [(0, 60_000, 2)]
    assert periodic.find_runs(list(range(60_000))) == []


def rows(seed):
    rng = random.Random(seed)
    out = [(None, None, 1), (None, "a b " * 9, 1), (1, "", 1), (2, " \n ", 1), (3, "one", 1), (3, "one", 1), (4, "é ü x " * 12, 1)]
    for k in range(10, 150):
        words = [rng.choice(["a", "b", "cc", "Ä"]) for _ in range(rng.randint(0, 60))]
        lines = words + [rng.choice("uvwxyz") + str(rng.random()) for _ in range(rng.randint(0, 30))] + words * rng.randint(0, 2)
        out.append((k, rng.choice([" ", "\n", " \t"]).join(lines), k))
    return out


def want(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 12)
    gone = {x for b, m, q in found for x in range(b + q, b + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{b},{m},{q}\n" for b, m, q in found).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query(spark, tmp_path):
    given = rows(3)
    df = spark.createDataFrame(given, "doc_id long, text string, runs int").selectExpr("*", "runs as key", "'x' as n_words")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = periodic.query(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == sorted((want(k, t) for k, t, _ in given), key=repr)
    assert sum(r[1] > 0 for r in got) > 20


def test_general_interface_and_empty_table(spark):
    df = spark.createDataFrame([("x", "go now " * 8 + "end", "y")], "id string, body string, text string")
    r = periodic.runs(df, key="id", column="body").first()
    assert (r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) == ("x", 17, [(0, 16, 2)], "go now end")
    assert periodic.runs(df.where("false"), "id", "body").count() == 0
