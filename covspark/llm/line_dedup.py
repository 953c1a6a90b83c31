"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line goes if the same line stands earlier (in order of doc_id, then text hash, then line number), or if some earlier line is within
``EDITS`` edits (insert, delete, substitute a code point) of it and both have at least ``MIN_CHARS`` characters.

Two lines within t edits share one of the t + 1 segments of the shorter line, unchanged and shifted by a bounded
amount.  So each distinct line gives t + 1 index rows, keyed by its length, the segment's number and its hash, and
probes the lengths from its own down to t less with the substrings at the few starts where such a segment can lie.
Pairs that meet on a key and pass a letter-count filter are verified by a banded bit-parallel edit distance: for each
number of errors one bit set over the 2t + 1 diagonals of the band, advanced a character at a time.

Equal lines go first: only hashes are aggregated (with partial minima) and the documents are cut once, so a line that
a third of all documents hold is one row in the join, and the text is shuffled once.  Segment rows whose key no other
line has are dropped after a single sort.  Cutting a document at its dropped line numbers takes linear time.

Defined results: blank lines are never dropped; a null text stays null with 0 lines; rows that repeat a doc_id and its
text are one document and share one result, rows that repeat a doc_id with other text are told apart by the text; null
doc_ids come first and name no document, so of rows with a null doc_id and the same text one keeps its lines;
an empty table gives an empty result; extra columns stay, columns named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save, table

EDITS = 2
MIN_CHARS = 32
BROADCAST_ROWS = 500_000
_LETTERS = "entairsodluchmgb"  # counted by the filter; 4 bits each


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, th, pos, line, h1, h2): the non-blank lines, numbered from 1."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    return (rows.where(F.trim("line") != "")
            .select("doc_id", "th", (F.col("pos") + 1).alias("pos"), "line",
                    F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")))


def letter_counts(line: Column) -> Column:
    """Counts of sixteen frequent letters modulo 16, packed in a long."""
    out = F.lit(0).cast("long")
    for k, c in enumerate(_LETTERS):
        n = (F.length(line) - F.length(F.replace(line, F.lit(c), F.lit("")))).bitwiseAND(F.lit(15)).cast("long")
        out = out.bitwiseOR(F.shiftleft(n, 4 * k))
    return out


def counts_near(a: str, b: str, edits: int) -> Column:
    """An edit changes at most two letter counts by one, so their distance is at most twice the edits."""
    total = None
    for k in range(len(_LETTERS)):
        own = [F.shiftright(F.col(x), 4 * k).bitwiseAND(F.lit(15)) for x in (a, b)]
        apart = F.abs(own[0] - own[1])
        apart = F.least(apart, F.lit(16) - apart)
        total = apart if total is None else total + apart
    return total <= 2 * edits


def _plan(edits: int) -> list[tuple[int, int, int]]:
    """(less, i, shift): segment i of a line ``less`` characters shorter, met ``shift`` further right."""
    parts = edits + 1
    return [(less, i, shift) for less in range(edits + 1) for i in range(1, parts + 1)
            for shift in range(max(1 - i, less - (parts - i)), min(i - 1, less + (parts - i)) + 1)]


def segment_rows(lines: DataFrame, edits: int) -> DataFrame:
    """(key, id, probe): index rows (probe 0) and probes (1) of distinct lines (h1, line).  Segments are even, the
    longer ones last."""
    steps = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("less", "i", "shift"), x)]) for x in _plan(edits)])
    parts = edits + 1
    rows = (lines.select(F.col("h1").alias("id"), "line")
            .withColumn("n", F.length("line")).where(F.col("n") >= MIN_CHARS)
            .select("*", F.inline(steps)))
    rows = rows.withColumn("m", F.col("n") - F.col("less"))
    base = F.expr(f"m div {parts}").cast("int")
    short = parts - F.col("m") % parts  # so many segments have the base length
    start = (F.col("i") - 1) * base + F.greatest(F.col("i") - 1 - short, F.lit(0)) + 1 + F.col("shift")
    size = base + (F.col("i") > short).cast("int")
    # at the same length an unshifted probe is the line's own index row
    probe = F.when((F.col("less") == 0) & (F.col("shift") == 0), 0).otherwise(1)
    return rows.select(F.xxhash64(F.substring("line", start, size), "m", "i").alias("key"), "id", probe.cast("byte").alias("probe"))


def shared_segments(lines: DataFrame, edits: int) -> DataFrame:
    """The segment rows whose key two lines or more have, one of them as an index row.  The aggregate that finds these
    keys, three numbers each, and the rows themselves read one shuffle by key: both ask for the same columns, and an inner
    join, unlike a semi-join, isn't pushed below it."""
    rows = segment_rows(lines, edits).repartition("key")
    several = rows.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.min("probe").alias("least"))
    several = several.where("lo <> hi and least = 0").select("key")
    return save(rows.join(several.hint("merge"), "key"), "segments")


def candidates(rows: DataFrame, edits: int) -> DataFrame:
    """(a, b) ids of lines that share a segment and nearly the letters; ``rows`` (key, id, letters, probe)."""
    a = rows.select("key", F.col("id").alias("a"), F.col("letters").alias("la"), F.col("probe").alias("pa"))
    b = rows.select("key", F.col("id").alias("b"), F.col("letters").alias("lb"), F.col("probe").alias("pb"))
    pairs = a.where("pa = 0").join(b, "key").where(((F.col("pb") == 1) | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b"))
                                                   & counts_near("la", "lb", edits))
    return save(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _shared_ends(a: Column, b: Column, at_end: bool) -> Column:
    """Length of the common prefix (or suffix) of two strings, by doubling steps."""
    most = F.least(F.length(a), F.length(b))

    def grow(known: Column, step: Column) -> Column:
        part = lambda x: F.substring(x, F.length(x) - known - step + 1, step) if at_end else F.substring(x, known + 1, step)
        return F.when((known + step <= most) & (part(a) == part(b)), known + step).otherwise(known)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(29, -1, -1)]), F.lit(0), grow)


def _banded(a: Column, b: Column, edits: int) -> Column:
    """Whether two strings are within ``edits``: bit d + edits of set k says that the prefixes of lengths j + d (of a)
    and j (of b) are within k edits.  Once all sets are empty nothing more is computed."""
    full = (1 << (2 * edits + 1)) - 1
    chars = lambda x: F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0))
    # the characters ride in the state, so they are split once and not at each step
    begin = F.struct(*[F.lit(sum(1 << (d + edits) for d in range(0, k + 1))).alias(f"r{k}") for k in range(edits + 1)],
                     chars(a).alias("left"), chars(b).alias("right"))

    def step(state: Column, j: Column) -> Column:
        left, c = state["left"], F.get(state["right"], j - 1)
        match = F.lit(0)
        for d in range(-edits, edits + 1):
            same = F.when(F.get(left, j + d - 1) == c, 1 << (d + edits)).otherwise(0)  # outside of left: null
            match = match.bitwiseOR(same)

        def advance(match: Column) -> Column:
            new = [state["r0"].bitwiseAND(match)]
            for k in range(1, edits + 1):
                old = state[f"r{k - 1}"]
                new.append(state[f"r{k}"].bitwiseAND(match).bitwiseOR(old).bitwiseOR(F.shiftright(old, 1))
                           .bitwiseOR(F.shiftleft(new[k - 1], 1)).bitwiseAND(F.lit(full)))
            return F.struct(*[x.alias(f"r{k}") for k, x in enumerate(new)], left.alias("left"), state["right"].alias("right"))

        return F.when(state[f"r{edits}"] == 0, state).otherwise(_let(match, advance))

    apart = F.length(a) - F.length(b)
    last = F.aggregate(F.sequence(F.lit(1), F.length(b)), begin, step)[f"r{edits}"]
    at = F.element_at(F.array(*[F.lit(1 << k) for k in range(2 * edits + 1)]), apart + edits + 1)
    return F.when(F.abs(apart) > edits, F.lit(False)).when(F.length(b) == 0, F.lit(True)).otherwise(
        last.bitwiseAND(at) != 0)


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether two strings are within ``edits``: common ends are cut off, the rest is compared banded and bit-parallel."""
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def cut_front(s: Column) -> Column:
        return _let(_shared_ends(s["x"], s["y"], False), lambda n: pair(*(F.substring(s[c], n + 1, F.length(s[c]) - n) for c in "xy")))

    def cut_back(s: Column) -> Column:
        return _let(_shared_ends(s["x"], s["y"], True), lambda n: pair(*(F.substring(s[c], F.lit(1), F.length(s[c]) - n) for c in "xy")))

    return _let(cut_front(pair(a, b)), lambda s: _let(cut_back(s), lambda m: _banded(m["x"], m["y"], edits)))


def _small(df: DataFrame) -> DataFrame:
    """A saved table, broadcast if its rows are counted few; else it is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def near_earlier(docs: DataFrame, edits: int) -> DataFrame:
    """(doc_id, th, cuts) of the lines that have an earlier line within ``edits``; no line of ``docs`` may stand twice."""
    lines = occurrences(docs)
    rows = shared_segments(lines, edits)
    ids = save(rows.select(F.col("id").alias("h1")).distinct(), "ids")
    found = lines.join(_small(ids), "h1").dropDuplicates(["doc_id", "th", "pos", "h1"])
    found = save(found.withColumn("letters", letter_counts(F.col("line"))), "found")
    pairs = candidates(rows.join(found.select(F.col("h1").alias("id"), "letters"), "id"), edits)
    side = lambda x: found.select(F.col("h1").alias(x), F.struct("doc_id", "th", "pos", "line").alias(f"row_{x}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(
        within_edits(F.col("row_a.line"), F.col("row_b.line"), edits) & (F.col("row_a.line") != F.col("row_b.line")))
    place = lambda x: F.struct(*[F.col(f"row_{x}.{c}").alias(c) for c in ("doc_id", "th", "pos")])
    later = near.select(F.greatest(place("a"), place("b")).alias("x")).select("x.*")
    return later.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("pos")).alias("cuts"))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, th, cuts) of the lines that stand earlier."""
    lines = occurrences(docs).select("doc_id", "th", "pos", "h1", "h2")
    first = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th", "pos")).alias("first"))
    gone = lines.join(first, ["h1", "h2"]).where(F.struct("doc_id", "th", "pos") > F.col("first"))
    return gone.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("pos")).alias("cuts"))


def cut(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` (with n_dropped) less the lines whose numbers ``gone`` (doc_id, th, cuts) has."""
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("cuts").alias("__cuts"))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__th"]), "left")
    lines, cuts = split_lines(F.col("text")), F.col("__cuts")
    kept = F.flatten(F.zip_with(F.concat(F.array(F.lit(0)), cuts), F.concat(cuts, F.array(F.size(lines) + 1)),
                                lambda x, y: F.slice(lines, x + 1, y - x - 1)))
    text = F.when(cuts.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    new = {"text": text, "n_dropped": F.col("n_dropped") + F.when(cuts.isNull(), 0).otherwise(F.size(cuts))}
    return joined.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def cut_twins(docs: DataFrame) -> DataFrame:
    """``docs`` (saved, with a row number) less all lines of rows without a doc_id whose text an earlier such row has."""
    some = docs.where("doc_id is null and n_dropped < n_lines").select(F.xxhash64("text").alias("__th"), "__row")
    twins = save(some.groupBy("__th").agg(F.min("__row").alias("__keep"), F.count("*").alias("m")).where("m > 1").drop("m"), "twins")
    if twins.isEmpty():
        return docs
    joined = docs.join(_small(twins), docs["doc_id"].isNull() & (F.xxhash64(docs["text"]) == twins["__th"]), "left")
    later = F.col("__row") > F.col("__keep")
    blank = F.array_join(F.filter(split_lines(F.col("text")), lambda x: F.trim(x) == ""), "\n")
    new = {"text": F.when(later, blank).otherwise(F.col("text")), "n_dropped": F.when(later, F.col("n_lines")).otherwise(F.col("n_dropped"))}
    return joined.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def dedup(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``docs`` with the dropped lines cut from ``text``, and n_lines and n_dropped (of the lines that aren't blank)."""
    full = F.coalesce(F.size(F.filter(split_lines(F.col("text")), lambda x: F.trim(x) != "")), F.lit(0))
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")],
                       F.when(F.col("text").isNull(), 0).otherwise(full).cast("long").alias("n_lines"),
                       F.lit(0).cast("long").alias("n_dropped"))
    once = cut_twins(save(cut(docs, repeated(docs)).withColumn("__row", F.monotonically_increasing_id()), "lines"))
    return cut(once, _small(save(near_earlier(once, edits), "near"))).drop("__row")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("doc_id", "n_lines", "n_dropped",
                              F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))
