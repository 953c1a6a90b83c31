"""N-gram Jaccard join by a prefix filter on inverted lists.

Documents with equal shingle sets are one set, named by a 64-bit fingerprint.  A set of n shingles can link (Jaccard
0.8 or more) only with sets that share at least T = ceil(0.8 n) of them, so, as in DivideSkip, its T - 1 longest inverted
lists needn't be merged: a partner is on one of the n - T + 1 shortest.  List lengths come from a count sketch of the
whole corpus; lists are ordered by (sketched length, hash), an order that all sets share, so both partners have a
common shingle among their short lists.  The short lists are merged by one sorted shuffle.  Long lists aren't built or
probed: one common short-list shingle can make a candidate, which is verified on its two whole sets.

Components, not all pairs, are wanted, so each set is first compared with a single pivot (a star): the one that it meets
most often over all its lists, occurrences being counted on the merged lists.  After the links found so far have joined
components, only lists that still hold members of several components are compared further: member against member, across
components, in blocks, with the length and position filters of the join.  So a group of thousands of near copies of one
text costs one pair each, and no link between components is lost.

Candidate pairs pass two bitmap filters before their whole sets meet: the distance of two parity bitmaps is at most the
number of shingles not shared.  The first bitmap has 1024 bits, the second four or more for each shingle.

Defined results: null texts and texts without words have an empty set and no link; repeated rows are one set; ties don't
arise (the threshold is exact integer arithmetic); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .common import bit_filter, in_filter, mix, save, shingle_hashes, table, text_slices
from .components import components

WIDTH = 5
PERCENT = 80
SKETCH_BITS = 22
FILTER_BITS = 20
BITMAP_WORDS = 16
BLOCK = 4096  # members of one list that meet in one task

_U = np.uint64


def sketch(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (sorted) and counts of the shingles that occur far more often than the mean bucket."""
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, data, offsets in text_slices(batch):
                h, _ = shingle_hashes(data, offsets, width)
                total += np.bincount((h >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total > 8 + 8 * total.mean())
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    got = (docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
           .toPandas().sort_values("bucket"))  # at most 2 ** SKETCH_BITS rows
    return got["bucket"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


def set_key(s: np.ndarray) -> int:
    """Fingerprint of a set of hashes."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) + _U(len(s))], _U)).view(np.int64)[0])


def _sets(rows, data, offsets, width):
    h, first = shingle_hashes(data, offsets, width)
    for i in range(rows.num_rows):
        yield i, np.unique(h[first[i]:first[i + 1]])


def bitmap(s: np.ndarray, words: int = BITMAP_WORDS) -> np.ndarray:
    """Parity bitmap: bit b is the parity of the shingles that fall on it.  Halving it is xor of its halves."""
    bits = np.bincount((mix(s) >> _U(34)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def fine_words(n: int) -> int:
    """Words of the second bitmap: a power of two with four bits or more for each shingle."""
    return max(BITMAP_WORDS, 1 << max(0, (n // 16).bit_length()))


def short_lists(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, th, n, key, short, bits, fine): text hash, set size, fingerprint, the set's shingles on short lists,
    shortest first, and its parity bitmaps.  Within a task the last three are given once for equal sets."""
    buckets, counts = sketch(docs, width)
    shared = docs.sparkSession.sparkContext.broadcast((buckets, counts))
    schema = docs.select("doc_id").schema.add("th", "long").add("n", "long").add("key", "long").add("short", ArrayType(LongType())).add("bits", ArrayType(LongType())).add("fine", ArrayType(LongType()))

    def run(batches):
        buckets, counts = shared.value
        heavy = np.zeros(1 << SKETCH_BITS, np.int64)
        heavy[buckets] = counts
        seen = set()
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                n, key, short, sizes, bits, fine = [], [], [], [], [], []
                for _, s in _sets(rows, data, offsets, width):
                    k = set_key(s)
                    n.append(len(s)), key.append(k)
                    if not len(s) or k in seen:
                        sizes.append(0), bits.append(None), fine.append(None)
                        continue
                    seen.add(k)
                    need = (percent * len(s) + 99) // 100
                    length = heavy[(s >> _U(64 - SKETCH_BITS)).astype(np.int64)]
                    own = s[np.argsort(length, kind="stable")[:len(s) - need + 1]]
                    short.append(own.view(np.int64)), sizes.append(len(own))
                    bits.append(bitmap(s)), fine.append(bitmap(s, fine_words(len(s))))
                flat = np.concatenate(short) if short else np.zeros(0, np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), rows.column("th"), pa.array(n, pa.int64()), pa.array(key, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(bits, pa.list_(pa.int64())),
                    pa.array(fine, pa.list_(pa.int64()))], names=schema.names)

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, schema)


def merged_lists(short: DataFrame) -> DataFrame:
    """(hash, key, n, pos): members of the short lists that hold two sets or more.  One sorted shuffle; lists of any
    length stream through."""
    postings = (short.where("size(short) > 0").select("key", "n", F.posexplode("short").alias("pos", "hash"))
                .repartition("hash").sortWithinPartitions("hash", "key"))
    cols = ["hash", "key", "n", "pos"]

    def run(batches):
        held, held_before = None, False  # the last row, and whether its list had one before it
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in cols])
            if held is not None:
                rows = np.concatenate([held, rows], axis=1)
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
            rows = rows[:, new]
            if not rows.shape[1]:
                continue
            same = np.zeros(rows.shape[1] + 1, bool)  # whether a row's list has one before it
            same[1:-1] = rows[0, 1:] == rows[0, :-1]
            same[0] = held is not None and held_before
            keep = (same[:-1] | same[1:])[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep]) for x in rows], names=cols)
            held, held_before = rows[:, -1:], bool(same[rows.shape[1] - 1])
        if held is not None and held_before:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=cols)

    return postings.select("hash", "key", F.col("n").cast("long"), F.col("pos").cast("long")).mapInArrow(run, "hash long, key long, n long, pos long")


def whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(key, whole) of the sets named in ``wanted`` (key); a fixed-size filter of the keys' top bits spares most others
    the shuffle, the join decides."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted, "key", FILTER_BITS))  # 2 ** FILTER_BITS bits

    def run(batches):
        some, seen = shared.value, set()
        for batch in batches:
            for rows, data, offsets in text_slices(batch):
                key, whole = [], []
                for _, s in _sets(rows, data, offsets, width):
                    k = set_key(s)
                    if not len(s) or k in seen or not in_filter(some, np.array([k]).view(_U), FILTER_BITS)[0]:
                        continue
                    seen.add(k)
                    key.append(k), whole.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(whole, pa.binary())], names=["key", "whole"])

    made = docs.select("text").mapInArrow(run, "key long, whole binary")
    return made.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])


def verify(pairs: DataFrame, bits: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link: bitmap filter first, then the intersection of the whole sets of those left."""
    def passing(pairs: DataFrame, column: str, apart: Column) -> DataFrame:
        side = lambda x: bits.select(F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col(column).alias(f"bits_{x}"))
        total = F.col("n_a") + F.col("n_b")
        return (pairs.join(side("a"), "a").join(side("b"), "b")
                .where((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
                       & ((100 + percent) * (total - apart) >= 2 * percent * total)).select("a", "b"))

    def distance(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda i, j: F.bit_count(i.bitwiseXOR(j))), F.lit(0), lambda s, i: s + i)

    def folded(x: Column, y: Column) -> Column:
        """``x`` at the size of ``y``, if it has twice as many words."""
        half = F.size(y)
        return F.when(F.size(x) == 2 * half, F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda i, j: i.bitwiseXOR(j))).otherwise(x)

    a, b = F.col("bits_a"), F.col("bits_b")
    likely = save(passing(pairs, "bits", distance(a, b)), "likely")
    likely = save(passing(likely, "fine", distance(folded(a, b), folded(b, a))), "likely")
    sets = whole_sets(docs, save(likely.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "wanted"), width)
    whole = lambda x: sets.select(F.col("key").alias(x), F.col("whole").alias(f"whole_{x}"))
    both = likely.join(whole("b"), "b").join(whole("a"), "a")

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("whole_a"), batch.column("whole_b")):
                x, y = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
                few, many = (x, y) if len(x) <= len(y) else (y, x)
                shared = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
                ok.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "whole_a", "whole_b").mapInArrow(run, "a long, b long")


def star(lists: DataFrame) -> DataFrame:
    """Pairs (a, b): each member with one pivot.  A list's pivot in a length class is the member whose own lists are shared
    most often for its size: of a group of near copies that is the text they come from, as their changes are on lists of
    one set.  Of the pivots of its lists a member takes the one that occurs most often."""
    length = F.floor(F.log(F.col("n").cast("double")) / math.log(1.25) + 1e-9).cast("long")
    shared = lists.groupBy("key").agg((F.count("*") / F.first("n")).alias("shared"))
    named = save(lists.select("hash", "key", length.alias("length")).join(shared, "key"), "shared")
    heads = save(named.groupBy("hash", "length").agg(F.max(F.struct("shared", -F.col("key"), "key"))["key"].alias("pivot")), "heads")
    times = named.join(heads, ["hash", "length"]).where("key <> pivot").groupBy("key", "pivot").agg(F.count("*").alias("times"))
    best = times.groupBy("key").agg(F.max_by("pivot", F.struct("times", -F.col("pivot"))).alias("pivot"))
    return best.select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).distinct()


def across(lists: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one list that are in different components and pass the length and position filters."""
    named = (lists.select("hash", "key", "n", "pos").join(labels.withColumnRenamed("node", "key"), "key", "left")
             .withColumn("component", F.coalesce("component", "key")))
    mixed = (named.groupBy("hash").agg(F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo <> hi").select("hash", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    members = (named.join(mixed, "hash").withColumn("own", own)
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("hash", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                       "key", "n", "pos", "component")
               .repartition("hash", "i", "j").sortWithinPartitions("hash", "i", "j", "n", "key"))
    cols = ["hash", "i", "j", "own", "key", "n", "pos", "component"]

    def emit(part: np.ndarray):
        _, i, j, own, key, n, pos, comp = part
        for at in range(0, len(key), 256):
            s = slice(at, at + 256)
            ok = (comp[s, None] != comp[None, :]) & (key[s, None] < key[None, :])
            if i[0] != j[0]:
                ok &= own[s, None] != own[None, :]
            ok &= 100 * np.minimum(n[s, None], n[None, :]) >= percent * np.maximum(n[s, None], n[None, :])
            left = 1 + np.minimum((n - 1 - pos)[s, None], (n - 1 - pos)[None, :])
            ok &= (100 + percent) * left >= percent * (n[s, None] + n[None, :])
            x, y = np.nonzero(ok)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(key[s][x]), pa.array(key[y])], names=["a", "b"])

    def run(batches):
        rest = np.zeros((len(cols), 0), np.int64)
        for batch in batches:
            rest = np.concatenate([rest, np.stack([batch.column(c).to_numpy().astype(np.int64) for c in cols])], axis=1)
            cuts = np.flatnonzero((rest[:3, 1:] != rest[:3, :-1]).any(axis=0)) + 1
            parts = np.split(rest, cuts, axis=1)
            for part in parts[:-1]:
                yield from emit(part)
            rest = parts[-1]
        if rest.shape[1]:
            yield from emit(rest)

    return members.select(*cols).mapInArrow(run, "a long, b long").distinct()


def grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, th, n, c): text hash, set size and component, for each row of ``docs``."""
    short = save(short_lists(docs, width, percent), "short")
    lists = save(merged_lists(short), "lists")
    bits = save(short.where("bits is not null").select("key", "n", "bits", "fine").dropDuplicates(["key"]), "bits")
    links = save(verify(star(lists), bits, docs, width, percent), "links")
    labels = components(links)
    more = verify(across(lists, labels, percent), bits, docs, width, percent)
    # the first components are stars already, so few rows and steps remain
    stars = labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    labels = components(save(stars.unionByName(more), "links"))
    return (short.select("doc_id", "th", "n", "key").join(labels.withColumnRenamed("node", "key"), "key", "left")
            .select("doc_id", "th", "n", F.coalesce("component", "key").alias("c")))


def join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): the set's size and the smallest doc_id that links reach."""
    named = grouped(docs, width, percent)
    first = named.where("n > 0").groupBy("c").agg(F.min("doc_id").alias("first"))
    return named.join(first, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, that are the first of their component, decided row by row: the smallest
    doc_id (null last), then the smallest text hash, and one of the rows that repeat both."""
    rows = grouped(docs, width, percent).where("n > 0").groupBy("c", "doc_id", "th").agg(F.count("*").alias("m"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")
    first = rows.groupBy("c").agg(F.min(place).alias("first"))
    marks = (rows.join(first, "c").select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"),
                                          (~place.eqNullSafe(F.col("first"))).alias("__gone"), "m")
             .where("__gone or m > 1").drop("m"))
    marks = save(marks, "marks")
    same = lambda m: docs["doc_id"].eqNullSafe(m["__id"]) & (F.xxhash64(docs["text"]) == m["__th"])
    tied = marks.where("not __gone")
    rest = docs.join(marks, same(marks), "left_anti")
    if tied.isEmpty():
        return rest
    # partial aggregates: a task hands on one row of each repeated one
    once = docs.join(tied, same(tied), "left_semi").withColumn("__th", F.xxhash64("text")).dropDuplicates(["doc_id", "__th"])
    return rest.unionByName(once.drop("__th"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
