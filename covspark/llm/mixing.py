"""Mixing sources to target weights by systematic sampling.

Each source has a target number of words.  A document's expected copies are target / source size; they are
prefix-summed within the source, one random offset is added, and a document is emitted once per integer
boundary that its stretch of the sum crosses.  So copies are the expected number rounded down or up, and since
the order within a source is by size, the words taken come near the target.

The prefix sum runs on three levels (sizes of a source, 256 hashed parts of a size, rows of a part), so no
source, however hot, is ever one window partition.

Defined results: a null text has size 0; null sources are one source, last in order; sources without words have
target 0 and their documents are taken 0 times; repeated rows are each a document of their own; an empty table
gives an empty result; other columns of the input pass through ``emit`` untouched and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import source_key

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(skey, source_size, target): weights repeat over the sources in code point order, null last.  A target
    stops at ``max_copies`` times the source's size and its excess is shared anew by weight.  The level at which
    the sharing settles is the largest of the levels found when sources are capped in order of cap / weight."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_ratio = Window.orderBy("ratio", "pos")
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    per = (sized.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
           .withColumn("pos", F.row_number().over(order) - 1)
           .withColumn("w", w).withColumn("cap", F.col("source_size") * max_copies)
           .withColumn("ratio", F.col("cap") / F.col("w")))
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    per = per.withColumn("level", left / F.sum("w").over(rest))
    per = per.withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("w"))
    return per.select("skey", "source_size", target.alias("target"))


def offset(skey: Column, seed: str) -> Column:
    """One random offset in [0, 1) for each source."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), skey)), 1, 8), 16, 10).cast("double") / float(16 ** 8)


def mix_counts(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies (and the columns named in ``keep``)."""
    part = F.coalesce(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 2), 16, 10).cast("int"), F.lit(0))
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), part.alias("part"),
                        source_key().alias("skey"), *[F.col(c) for c in keep])
    counts = sized.groupBy("skey", "size", "part").agg(F.first("source").alias("source"), F.count("*").alias("n"))
    per_size = counts.groupBy("skey", "size").agg(F.sum("n").alias("n_size"))
    ahead = Window.partitionBy("skey").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    per_size = per_size.select("skey", "size", F.coalesce(F.sum("n_size").over(ahead), F.lit(0)).alias("before_size"))
    ahead = Window.partitionBy("skey", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("before_part", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
              .join(per_size, ["skey", "size"])
              .select("skey", "size", "part", (F.col("before_part") + F.col("before_size")).alias("before")))
    per = targets(counts.select("skey", "source", (F.col("size") * F.col("n")).alias("size")), weights, max_copies)
    starts = starts.join(per, "skey")
    rank = F.row_number().over(Window.partitionBy("skey", "size", "part").orderBy("doc_id")) + F.col("before")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = offset(F.col("skey"), seed)
    copies = F.floor(u + F.col("rate") * F.col("rank")) - F.floor(u + F.col("rate") * (F.col("rank") - 1))
    return (sized.join(starts, ["skey", "size", "part"]).withColumn("rank", rank).withColumn("rate", rate)
            .select("doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"), *keep))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with ``mix_copy`` from 1 on.  The whole row rides
    along as one struct, so clashing column names do no harm."""
    if "mix_copy" in docs.columns:
        docs = docs.withColumnRenamed("mix_copy", "mix_copy_in")
    row = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = mix_counts(row, keep=("row",), **options).where("copies > 0")
    return taken.select("row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("mix_copy"))


def query(spark, sf_dir):
    from .common import table
    out = mix_counts(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = f"""
with d as (
  select doc_id, source, coalesce('=' || source, '') as skey,
         cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
         coalesce(cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 2) as bigint), 0) as part
  from documents),
s as (select skey, source, cast(sum(size) as bigint) as source_size from d group by all),
p as (select *, row_number() over (order by source is null, source) - 1 as pos from s),
w as (select *, case pos % 3 when 0 then 5 when 1 then 2 else 1 end as w, source_size * 3 as cap from p),
l as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / w, pos
        rows between unbounded preceding and 1 preceding), 0))::double
        / (sum(w) over (order by cap / w, pos rows between current row and unbounded following))::double as level from w),
t as (select skey, source_size, least(cap::double, max(level) over () * w) as target,
        cast('0x' || substr(md5('{SEED}' || skey), 1, 8) as bigint)::double / 4294967296.0 as u from l),
r as (select d.doc_id, d.size, t.source_size, t.target, t.u,
        case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
        row_number() over (partition by skey order by d.size, d.part, d.doc_id) as rank
      from d join t using (skey))
select doc_id, size, source_size, target,
  cast((floor(u + rate * rank) - floor(u + rate * (rank - 1))) * size as bigint) as taken
from r
"""
