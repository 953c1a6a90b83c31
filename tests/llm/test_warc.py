"""Revisit resolution against a plain search."""

import random

from covspark.llm import warc

SCHEMA = "record_id string, kind string, url string, ts long, etag string, last_modified string, headers map<string,string>, bucket string"


def records():
    rng = random.Random(8)
    out = []
    for k in range(400):
        url = "http://Hot.example.com/a" if rng.random() < .4 else f"https://www.h{rng.randrange(6)}.com:443/p{rng.randrange(3)}/?utm_source=x#f"
        kind = rng.choice(["response", "revisit"])
        out.append((f"{k:04}", kind, url if rng.random() < .97 else None, rng.randrange(20_000), rng.choice(["a", "W/a", "b", None]),
                    rng.choice(["m1", "m2", None]), {"date": str(k), "etag": "e", "content-length": "7"} if kind == "response"
                    else rng.choice([None, {"date": f"r{k}", "content-length": "0", "vary": "v"}]), "clash"))
    return out + [out[0], out[1]]


def plain(rows, key):
    got = []
    for rid, kind, url, ts, tag, mod, head, _ in rows:
        if kind != "revisit":
            continue
        best = max(((r[3], r[0]) for r in rows if r[1] == "response" and url is not None and key(r[2]) == key(url) and r[3] < ts), default=None)
        of = next((r for r in rows if best and r[0] == best[1]), None)
        strip = lambda t: t[2:] if t.startswith("W/") else t
        if of is None:
            got.append((rid, "no_response", None, None))
            continue
        ok = strip(tag) == strip(of[4]) if tag is not None and of[4] is not None else mod is not None and mod == of[5]
        merged = {**of[6], **{k: v for k, v in (head or {}).items() if k in warc.PERMITTED}} if ok else None
        got.append((rid, "resolved" if ok else "mismatch", of[0] if ok else None, merged))
    return sorted(got, key=repr)


def test_resolve(spark):
    rows = records()
    df = spark.createDataFrame(rows, SCHEMA)
    names = {r.url: r.c for r in df.select("url", warc.canonical(df.url).alias("c")).distinct().collect()}
    assert names["http://Hot.example.com/a"] == "hot.example.com/a"
    assert all(c.startswith("h") and not c.endswith("/") and "utm" not in c and "#" not in c and ":" not in c for c in names.values() if c)
    for seconds in (100, 3600, 10**6):
        got = sorted(((r.record_id, r.state, r.response_id, r.headers) for r in warc.resolve(df, seconds).collect()), key=repr)
        assert got == plain(rows, lambda u: names.get(u))


def test_canonical(spark):
    urls = {"HTTP://WWW.A.com:80/x/?utm_a=1&utm_b=2&q=3&gclid=4#z": "a.com/x/?q=3", "a.com": "a.com", "": "", "https://B.org/Path/": "b.org/Path",
            "http://b.org?utm_source=1": "b.org"}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.c for r in df.select("url", warc.canonical(df.url).alias("c")).collect()} == urls


def test_empty(spark):
    assert warc.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_header_names_in_any_case(spark):
    rows = [("r1", "response", "http://a.b/c", 10, "t", None, {"Cache-Control": "max-age=1", "Content-Type": "x"}),
            ("v1", "revisit", "http://a.b/c", 20, "t", None, {"cache-control": "max-age=9", "DATE": "d", "X-Own": "no"})]
    df = spark.createDataFrame(rows, "record_id string, kind string, url string, ts long, etag string, last_modified string, headers map<string,string>")
    assert warc.resolve(df).first().headers == {"cache-control": "max-age=9", "DATE": "d", "Content-Type": "x"}
