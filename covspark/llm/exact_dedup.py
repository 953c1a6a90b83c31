"""Exact dedup by deterministic block naming, in DataFrame functions only.

A text's runs of white space become one space and its UTF-8 bytes are cut into blocks of ``BLOCK`` bytes (the last is
shorter; an empty text is one empty block).  The distinct blocks of all documents are sorted, and a block's place (its
range, then its place there) is its integer name.  Then adjacent names are taken in pairs, a last odd one with -1; the
distinct pairs are sorted and named likewise, until each document has one name.  Names are given to contents, not to
hashes: two documents get the same (level, name) if and only if they have the same blocks, so the identity has no
collisions.  A document of n blocks takes ceil(log2 n) levels and leaves as soon as it has one name.

Each level is a distinct (partial aggregation first, so that a block of a third of all documents is one row a task), a
sort, and an equi-join of the names back to the pairs, whose hot keys AQE splits.  Block texts are shuffled once: names
come back by a 64-bit hash of the block, and by the block itself where two blocks share their hash.  Every level is
written to the shared folder, so a lost executor costs one step.

Defined results: null counts as empty; of equal texts the row with the smallest doc_id stays, null ids last, and of rows
that repeat it any one (by its row number); group sizes count rows; ``text`` of any length; an empty table gives an empty
result; ``identities`` numbers rows and keeps no other columns than asked for, so names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save, table

BLOCK = 1024
GAPS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAPS, " ")


def number_rows(docs: DataFrame, column: str = "text") -> DataFrame:
    """(row, doc_id, body, text_sha256), written: row numbers hold from here on."""
    body = docs.select("doc_id", normalised(F.col(column)).cast("binary").alias("body"))
    return save(body.select(F.monotonically_increasing_id().alias("row"), "doc_id", "body", F.sha2("body", 256).alias("text_sha256")), "xd-rows")


def _blocks(rows: DataFrame, block: int, hashed) -> DataFrame:
    """(row, n, i, h, block): the blocks of each body, numbered from 0, n of them."""
    n = F.greatest(F.ceil(F.length("body") / block).cast("int"), F.lit(1))
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring("body", i * block + 1, F.lit(block)))
    out = rows.withColumn("n", n).select("row", "n", F.posexplode(cut).alias("i", "block"))
    return out.select("row", "n", "i", hashed(F.col("block")).alias("h"), "block")


def _name_blocks(rows: DataFrame, block: int, hashed) -> DataFrame:
    """(row, n, i, name): every block of every row under its integer name."""
    given = _blocks(rows, block, hashed)
    found = given.groupBy("h").agg(F.collect_set("block").alias("same"))  # one block, but where hashes collide
    found = found.select("h", F.size("same").alias("k"), F.explode("same").alias("block")).sortWithinPartitions("h", "block")
    names = save(found.select("h", F.when(F.col("k") > 1, F.col("block")).alias("block"), F.monotonically_increasing_id().alias("name")), "xd-names")
    shared = names.where("block is not null").select("h", F.lit(True).alias("shared")).distinct()
    if shared.isEmpty():  # no two blocks have one hash: names come back by the hash alone
        return save(given.select("row", "n", "i", "h").join(names.select("h", "name"), "h").select("row", "n", "i", "name"), "xd-level")
    plain = F.lit(b"\0")
    given = given.join(shared, "h", "left").withColumn("key", F.when(F.col("shared"), F.concat(F.lit(b"\1"), F.col("block"))).otherwise(plain))
    names = names.withColumn("key", F.coalesce(F.concat(F.lit(b"\1"), F.col("block")), plain))
    return save(given.join(names.select("h", "key", "name"), ["h", "key"]).select("row", "n", "i", "name"), "xd-level")


def _name_pairs(named: DataFrame) -> DataFrame:
    """The next level: adjacent names as pairs, the distinct pairs sorted and named."""
    even = F.col("i") % 2 == 0
    pairs = (named.where("n > 1").groupBy("row", F.expr("i div 2").cast("int").alias("i"))
             .agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
                  F.expr("any_value(n + 1) div 2").cast("int").alias("n")))
    names = pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
    names = save(names.select("a", "b", F.monotonically_increasing_id().alias("name")), "xd-names")
    return save(pairs.join(names, ["a", "b"]).select("row", "n", "i", "name"), "xd-level")


def identities(rows: DataFrame, block: int = BLOCK, hashed=F.xxhash64) -> DataFrame:
    """(row, level, name) of ``rows`` (row, body): equal (level, name) mean equal bodies, and the other way round."""
    single = lambda named, level: named.where("n = 1").select("row", F.lit(level).alias("level"), "name")
    named = _name_blocks(rows, block, hashed)
    out = single(named, 0)
    longest = named.agg(F.max("n")).first()[0] or 1
    for level in range(1, (longest - 1).bit_length() + 1):
        named = _name_pairs(named)
        out = out.unionByName(single(named, level))
    return out


def groups(docs: DataFrame, column: str = "text", block: int = BLOCK, hashed=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and the identity (level, name)."""
    rows = number_rows(docs, column)
    member = save(rows.select("row", "doc_id", "text_sha256").join(identities(rows, block, hashed), "row"), "xd-member")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    groups = save(member.groupBy("level", "name").agg(F.count("*").alias("group_size"), first.alias("first")), "xd-groups")
    return member.join(groups, ["level", "name"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256", "level", "name")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents)
select doc_id, min(doc_id) over (partition by body) as keep_id, count(*) over (partition by body) as group_size,
  doc_id = min(doc_id) over (partition by body) as kept, sha256(body) as text_sha256
from d
"""
