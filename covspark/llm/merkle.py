"""Document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame functions only.

Sections are divided by blank lines and paragraphs by line ends.  A paragraph's digest covers its text, a section's the
digests of its paragraphs, the root's those of the sections: equal roots mean equal texts, and where roots differ only
differing sections, then paragraphs, need a look (``locate_edits``).  Beneath each paragraph stand short digests of its
pieces of ``PIECE`` characters, so that edits inside long paragraphs show too.

Likeness of two fingerprints is the larger of two shares of common pieces: as sets (moved text counts) and place by
place (repeated text counts).

The next document is found on ids alone: they are range-partitioned, ``lead`` runs within a range, and the first id of
the following range closes the gap.  Each document then sends only as many characters as its predecessor needs.

Defined results: a null text counts as empty; null doc_ids come first; rows that repeat a doc_id and its text share one
place in the order, rows that repeat a doc_id with other text follow each other by the text's hash; a single document
is its own next; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .common import save, table

PIECE = 16


def sections(text: Column) -> Column:
    return F.split(text, r"\n[ \t]*\n")


def pieces(paragraph: Column) -> Column:
    """24-bit digests of the paragraph's pieces; an empty paragraph is one empty piece."""
    cut = F.regexp_extract_all(paragraph, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    cut = F.when(F.size(cut) > 0, cut).otherwise(F.array(F.lit("")))
    return F.transform(cut, lambda x: F.shiftrightunsigned(F.xxhash64(x), 40).cast("int"))


def tree(text: Column) -> Column:
    """Sections as (digest, paragraphs (digest, pieces)); the parent digests are added by ``fingerprint``."""
    return F.transform(sections(text), lambda s: F.transform(
        F.split(s, "\n"), lambda p: F.struct(F.md5(p.cast("binary")).alias("digest"), pieces(p).alias("pieces"))))


def _section_digest(paragraphs: Column) -> Column:
    return F.md5(F.array_join(F.transform(paragraphs, lambda p: p["digest"]), "").cast("binary"))


def root(nodes: Column) -> Column:
    return F.sha2(F.array_join(F.transform(nodes, _section_digest), "").cast("binary"), 256)


def fingerprint(nodes: Column) -> Column:
    """root|section:paragraph,pieces;paragraph,pieces|section:... with digests in hex: root 64, section 16, paragraph 8
    and piece 6 digits."""
    digits = lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")
    paragraph = lambda p: F.concat(F.substring(p["digest"], 1, 8), F.lit(","), F.array_join(F.transform(p["pieces"], digits), ""))
    section = lambda s: F.concat(F.substring(_section_digest(s), 1, 16), F.lit(":"),
                                 F.array_join(F.transform(s, paragraph), ";"))
    return F.concat(root(nodes), F.lit("|"), F.array_join(F.transform(nodes, section), "|"))


def likeness(fp_a: Column, pieces_a: Column, fp_b: Column, pieces_b: Column) -> Column:
    """0 to 1; 1 if the roots are equal."""
    both = F.size(pieces_a) + F.size(pieces_b)
    own = F.size(F.array_distinct(pieces_a)) + F.size(F.array_distinct(pieces_b))
    sets = 2.0 * F.size(F.array_intersect(pieces_a, pieces_b)) / own
    placed = 2.0 * F.size(F.filter(F.zip_with(pieces_a, pieces_b, lambda x, y: x == y), lambda same: same)) / both
    return F.when(F.substring(fp_a, 1, 64) == F.substring(fp_b, 1, 64), 1.0).otherwise(F.greatest(sets, placed))


def locate_edits(pairs: DataFrame, a: str = "text_a", b: str = "text_b") -> DataFrame:
    """``pairs`` with ``edits``: (section, paragraph) numbers from 1 where the trees of two texts differ.  Sections
    with equal digests are passed over whole."""
    nodes = lambda c: tree(F.coalesce(F.col(c), F.lit("")))
    none = F.array().cast("array<struct<digest:string,pieces:array<int>>>")

    def inside(pair: Column, i: Column) -> Column:
        left, right = F.coalesce(pair["x"], none), F.coalesce(pair["y"], none)
        differ = F.transform(F.zip_with(left, right, lambda p, q: ~p["digest"].eqNullSafe(q["digest"])),
                             lambda d, j: F.when(d, F.struct((i + 1).alias("section"), (j + 1).alias("paragraph"))))
        return F.when(pair["x"].isNotNull() & pair["y"].isNotNull() & (_section_digest(left) == _section_digest(right)),
                      F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(F.filter(differ, lambda d: d.isNotNull()))

    zipped = F.zip_with(nodes(a), nodes(b), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    return pairs.withColumn("edits", F.flatten(F.transform(zipped, inside)))


def next_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, id, th, n, next): each document's follower (id, th) in ascending order, the first after the last."""
    ids = docs.select("doc_id", "id", "th", F.length("text").cast("long").alias("n")).distinct()
    ids = save(ids.repartitionByRange("doc_id", "th").withColumn("part", F.spark_partition_id()), "ids")
    me = F.struct("doc_id", "th", "id")
    led = ids.withColumn("next", F.lead(me).over(Window.partitionBy("part").orderBy("doc_id", "th")))
    heads = ids.groupBy("part").agg(F.min(me).alias("head"))  # one row per range
    heads = heads.select("part", F.lead("head").over(Window.orderBy("part")).alias("follows"),
                         F.min("head").over(Window.partitionBy()).alias("top"))
    return led.join(F.broadcast(heads), "part").select("doc_id", "id", "th", "n", F.coalesce("next", "follows", "top").alias("next"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, head, next_root, next_pieces): the first floor(n / 4) characters of the next document, and its
    fingerprint's root and pieces.  Documents are keyed by (id, th), without nulls, so that both joins and the removal
    of repeated rows share one partitioning of the texts."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    numeric = isinstance(docs.schema["doc_id"].dataType, NumericType)
    known = F.coalesce("doc_id", F.lit(0)) if numeric else F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = docs.select("doc_id", known.alias("id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("th"), "text")
    wanted = next_documents(docs).select(F.col("next.id").alias("id"), F.col("next.th").alias("th"), F.col("id").alias("to_id"),
                                         F.col("th").alias("to_th"), F.col("doc_id").alias("to_doc"), F.floor(F.col("n") / 4).cast("int").alias("k"))
    texts = docs.select("id", "th", "text")
    sent = (texts.join(wanted.hint("merge"), ["id", "th"])
            .select(F.col("to_id").alias("id"), F.col("to_th").alias("th"), F.col("to_doc").alias("doc_id"), F.substring("text", F.lit(1), F.col("k")).alias("head"),
                    tree(F.col("text")).alias("nodes"))
            .select("id", "th", "doc_id", "head", root(F.col("nodes")).alias("next_root"),
                    F.flatten(F.transform(F.flatten("nodes"), lambda p: p["pieces"])).alias("next_pieces"))
            .dropDuplicates(["id", "th"]))
    return texts.join(sent.hint("merge"), ["id", "th"]).select("doc_id", "text", "head", "next_root", "next_pieces")


def compare(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the likenesses to this and to the next document's."""
    rows = with_next(docs)
    n = F.length("text")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), F.col("head")))
    rows = rows.withColumn("own", tree(F.col("text"))).withColumn("other", tree(F.col("edited")))
    flat = lambda c: F.flatten(F.transform(F.flatten(c), lambda p: p["pieces"]))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"),
                       flat("own").alias("own"), flat("other").alias("other"), "next_root", "next_pieces")
    rows = rows.withColumnRenamed("next_root", "next_fp")
    near = lambda fp, p: likeness(F.col("fingerprint"), F.col("own"), F.col(fp), F.col(p)).cast("double")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       near("edited_fingerprint", "other").alias("near_edited"), near("next_fp", "next_pieces").alias("near_next"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(table(spark, sf_dir, "documents"))
