"""Not-modified revisit resolution over web-archive records.

Each revisit (a 304 answer without a body) is joined, by canonical URL and as of its time, to the latest earlier full
response.  Its validators are checked (the entity tag if both have one, weak marks aside; else the modification date),
and if they hold, the response's headers are taken with the headers that a 304 may update laid over them.

The as-of join is two plain windows: within (URL, time bucket), and over one row per bucket of a URL for what the
earlier buckets hand on.  So a URL with a third of all records is spread over its buckets.

Defined results: a revisit without an earlier response is ``no_response``; one whose validators differ or are missing is
``mismatch``; both have null response fields; responses at the revisit's own second are not earlier; of several in one
second the largest record_id counts; null URLs resolve to nothing; repeated records each give a row; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

BUCKET_SECONDS = 3600
# The headers that a 304 answer may update (HTTP semantics).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that don't name content.
_TRACKING = r"([?&])(utm_[a-z]+|gclid|fbclid)=[^&]*"

# (pattern, replacement) in order; written for both Java's and RE2's syntax
_CANONICAL = [
    (r"#.*$", ""), (_TRACKING, "\\1"), (r"([?&])&+", "\\1"), (r"[?&]+$", ""),
    (r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), (r"^([^/?]*?):(80|443)([/?]|$)", "\\1\\3"), (r"^[Ww][Ww][Ww]\.", ""), (r"/+$", ""),
]


def canonical(url: Column) -> Column:
    """Host in lower case without scheme, www or default port; no fragment, tracking parameters or final slashes."""
    out = F.trim(url)
    for pattern, to in _CANONICAL:
        for _ in range(2 if pattern == _TRACKING else 1):  # neighbours share a separator
            out = F.regexp_replace(out, pattern, to.replace("\\", "$"))
    host = F.regexp_extract(out, r"^[^/?]*", 0)
    return F.concat(F.lower(host), F.substring(out, F.length(host) + 1, F.lit(1 << 30)))


def resolve(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Revisits of ``records`` (record_id, kind 'response' or 'revisit', url, ts seconds, etag, last_modified, headers)
    with canonical, state, response_id, response_ts and merged headers."""
    rows = records.select("record_id", "kind", "ts", "etag", "last_modified", "headers", canonical(F.col("url")).alias("canonical"),
                          F.floor(F.col("ts") / bucket_seconds).alias("bucket"))
    full = F.when(F.col("kind") == "response", F.struct("ts", "record_id", "etag", "last_modified", "headers"))
    rows = rows.withColumn("full", full)
    later = F.when(F.col("kind") == "response", 1).otherwise(0)  # at equal times revisits come first
    order = Window.partitionBy("canonical", "bucket").orderBy("ts", later, "record_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("near", F.last("full", ignorenulls=True).over(order))
    # the last response of each bucket by (ts, record_id), and what earlier buckets hand on
    ends = rows.where("kind = 'response' and canonical is not null").groupBy("canonical", "bucket").agg(
        F.max_by("full", F.struct("ts", "record_id")).alias("last"))
    asks = rows.where("kind = 'revisit' and near is null").select("canonical", "bucket").distinct()
    ends = asks.join(ends, ["canonical", "bucket"], "full")
    before = Window.partitionBy("canonical").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select("canonical", "bucket", F.last("last", ignorenulls=True).over(before).alias("far"))
    found = (rows.where("kind = 'revisit'").join(handed, ["canonical", "bucket"], "left")
             .withColumn("of", F.when(F.col("canonical").isNotNull(), F.coalesce("near", "far"))))
    tag = lambda c: F.regexp_replace(c, "^W/", "")
    by_tag = F.col("etag").isNotNull() & F.col("of.etag").isNotNull()
    holds = F.when(by_tag, tag(F.col("etag")) == tag(F.col("of.etag"))).otherwise(
        F.coalesce(F.col("last_modified") == F.col("of.last_modified"), F.lit(False)))
    state = F.when(F.col("of").isNull(), "no_response").when(holds, "resolved").otherwise("mismatch")
    found = found.withColumn("state", state)
    ok = F.col("state") == "resolved"
    none = F.create_map().cast("map<string,string>")
    # header names are compared without case and kept as they are spelt
    update = F.map_filter(F.coalesce("headers", none), lambda k, v: F.lower(k).isin(*PERMITTED))
    renewed = F.transform(F.map_keys(update), F.lower)
    merged = F.map_concat(F.map_filter(F.coalesce("of.headers", none), lambda k, v: ~F.array_contains(renewed, F.lower(k))), update)
    return found.select("record_id", "canonical", "ts", "state", F.when(ok, F.col("of.record_id")).alias("response_id"),
                        F.when(ok, F.col("of.ts")).alias("response_ts"), F.when(ok, merged).alias("headers"))


def _number(salt: str, digits: int = 6) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col("page_id").cast("string"))), 1, digits), 16, 10).cast("long")


def records_of(pages: DataFrame) -> DataFrame:
    """Archive records derived from crawled pages: for each page its full response and a later revisit, at times that
    its id gives.  Revisits spell the URL otherwise; one in eight holds a stale tag, one in eight only a date."""
    ts = F.lit(1_700_000_000) + _number("t") % 1_000_000
    tag = F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16)
    again = ts + 1 + _number("v") % 400_000
    pick = _number("k") % 8
    modified = F.concat(F.lit("d"), (ts - _number("m") % 100_000).cast("string"))
    text = lambda c: c.cast("string")
    first = F.struct(F.concat(F.lit("r"), text(F.col("page_id"))).alias("record_id"), F.lit("response").alias("kind"), F.col("url").alias("url"),
                     ts.alias("ts"), tag.alias("etag"), modified.alias("last_modified"),
                     F.create_map(F.lit("content-length"), text(F.octet_length(F.coalesce("html", F.lit("")))), F.lit("content-type"), F.lit("text/html"),
                                  F.lit("date"), text(ts), F.lit("etag"), tag).alias("headers"))
    own = F.when(pick == 0, F.lit("stale")).when(pick == 1, F.lit(None).cast("string")).when(pick == 2, F.concat(F.lit("W/"), tag)).otherwise(tag)
    second = F.struct(F.concat(F.lit("v"), text(F.col("page_id"))).alias("record_id"), F.lit("revisit").alias("kind"),
                      F.concat("url", F.lit("#again")).alias("url"), again.alias("ts"), own.alias("etag"), modified.alias("last_modified"),
                      F.create_map(F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.concat(F.lit("max-age="), text(pick * 60)),
                                   F.lit("date"), text(again)).alias("headers"))
    return pages.select(F.explode(F.array(first, second)).alias("r")).select("r.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve(records_of(table(spark, sf_dir, "pages")))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.select("record_id", "canonical", "ts", "state", "response_id", "response_ts", text.alias("headers"))


def _sql_canonical(url: str) -> str:
    out = f"trim({url})"
    for pattern, to in _CANONICAL:
        for _ in range(2 if pattern == _TRACKING else 1):
            out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return out


def _sql_number(salt: str) -> str:
    return f"cast('0x' || substr(md5('{salt}' || page_id::varchar), 1, 6) as bigint)"


ORACLE = f"""
with p as (select page_id, url, coalesce(html, '') as html, 1700000000 + {_sql_number("t")} % 1000000 as ts,
    {_sql_number("v")} % 400000 + 1 as gap, {_sql_number("k")} % 8 as pick, {_sql_number("m")} % 100000 as age,
    {_sql_canonical("url")} as raw from pages),
q as (select *, substr(md5(html), 1, 16) as tag, 'd' || (ts - age)::varchar as modified,
    lower(regexp_extract(raw, '^[^/?]*')) || substr(raw, length(regexp_extract(raw, '^[^/?]*')) + 1) as canonical from p),
resp as (select canonical, ts, max_by(struct_pack(id := 'r' || page_id::varchar, tag := tag, modified := modified,
    n := octet_length(encode(html))::varchar), 'r' || page_id::varchar) as r from q group by canonical, ts),
rev as (select 'v' || page_id::varchar as record_id, canonical, ts + gap as ts, pick, modified,
    case pick when 0 then 'stale' when 1 then null when 2 then tag else tag end as tag from q),
j as (select rev.*, resp.ts as r_ts, resp.r, case when resp.r is null then 'no_response'
    when coalesce(rev.tag = resp.r.tag, rev.modified = resp.r.modified) then 'resolved' else 'mismatch' end as state
  from rev asof left join resp on rev.canonical = resp.canonical and rev.ts > resp.ts)
select record_id, canonical, ts::bigint as ts, state,
  case when state = 'resolved' then r.id end as response_id,
  case when state = 'resolved' then r_ts::bigint end as response_ts,
  case when state = 'resolved' then 'cache-control=max-age=' || (pick * 60)::varchar || ';content-length=' || r.n
    || ';content-type=text/html;date=' || ts::varchar || ';etag=' || r.tag end as headers
from j
"""
