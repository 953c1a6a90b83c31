"""Vector code compression: product codes whose assignments walk a lexicographic trie over the distinct parts.

Components become integers, floor(SCALE * x).  Vectors are cut into ``PARTS`` consecutive parts, and each part position
has a codebook of ``ENTRIES`` entries, which starts as that part of the smallest vec_ids.  A round assigns every part to
its nearest entry and replaces each entry by the componentwise floor of the mean of its parts.  All sums are integers, so
the result doesn't depend on order or partitioning.

The parts are reduced to distinct ones with counts (partial aggregation first, so a vector that a third of all rows hold
is one row a task) and sorted by (position, components), written once and read by every round.  A task's sorted parts
are the leaves of a trie whose levels are the dimensions.  It is walked depth first, a block of ``LEAVES`` leaves at a
time: each node takes its parent's accumulated distances to all entries and adds its own dimension's, so what parts share
as a prefix is computed once, and the path to a block's last leaf is handed to the next block.  Leaves take the argmin
and add their counts and weighted components to the entry's sums.  A task sends one row per (position, entry); the driver
gets the summed codebooks, PARTS x ENTRIES rows, whatever the input's size.

The last pass needs a code for each row: the trie is built over the distinct parts of each Arrow batch, in place, without
a shuffle.

Defined results: rows whose vector is null or holds null, NaN or infinite components are dropped, so are rows whose
length isn't a positive multiple of PARTS, and of the rest those that haven't the length of the smallest vec_id's.  Components beyond +-2**27 (x beyond 32,768) are held there, which keeps squared distances in 64 bits.  Null
vec_ids come last among the starts; of rows that repeat a vec_id the smaller vector comes first; repeated rows each
count.  With fewer rows than ENTRIES the codebooks are shorter.  Null labels are one label.  An empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save, source_key, table

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LEAVES = 8192
_LIMIT = float(1 << 27)


def whole_vectors(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, v): the rows that count, components as integers."""
    given = vectors.select("vec_id", "label", F.col("embedding").alias("x")).where("x is not null")
    good = ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    scaled = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(_LIMIT)), F.lit(-_LIMIT))).cast("int")
    return given.where(good).where(F.size("x") % parts == 0).where("size(x) > 0").select("vec_id", "label", F.transform("x", scaled).alias("v"))


def first_entries(rows: DataFrame, entries: int, parts: int) -> np.ndarray:
    """Codebooks (parts, entries, width) of the smallest vec_ids; ``entries`` rows come to the driver."""
    ordered = rows.select("vec_id", "v").orderBy(F.col("vec_id").isNull(), "vec_id", "v")
    least = ordered.first()
    if least is None:
        return np.zeros((parts, 0, 0), np.int64)
    first = [r.v for r in ordered.where(F.size("v") == len(least.v)).limit(entries).collect()]
    return np.ascontiguousarray(np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2))


def distinct_parts(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """(pos, part, n): the distinct parts of each position and how often they occur, in order, written."""
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("v", p * width + 1, F.lit(width)))
    found = rows.select(F.posexplode(cut).alias("pos", "part")).groupBy("pos", "part").agg(F.count("*").alias("n"))
    return save(found.repartitionByRange("pos", "part").sortWithinPartitions("pos", "part"), "vc-parts")


def walk(leaves: np.ndarray, book: np.ndarray, block: int = LEAVES):
    """(first leaf, distances (leaves, entries)) of each block of ``leaves``, distinct and in order, depth first.

    ``path[d]``: the distances that the last leaf's prefix of d components has accumulated."""
    n, width = leaves.shape
    path = [np.zeros(book.shape[0], np.int64) for _ in range(width + 1)]
    for at in range(0, n, block):
        rows = leaves[at:at + block]
        before = np.concatenate([leaves[at - 1:at] if at else rows[:1], rows[:-1]])
        branch = np.logical_or.accumulate(rows != before, axis=1)  # a new node at this depth
        if not at:
            branch[0] = True
        node = np.zeros(len(rows), np.int64)  # of each leaf at the depth above; node 0 is the path's own
        above = path[0][None, :]
        carried = path
        path = [path[0]]
        for d in range(width):
            new = np.flatnonzero(branch[:, d])
            mine = np.empty((len(new) + 1, book.shape[0]), np.int64)
            mine[0] = carried[d + 1]
            step = rows[new, d, None] - book[None, :, d]
            mine[1:] = above[node[new]] + step * step
            node = np.cumsum(branch[:, d])
            above = mine
            path.append(mine[node[-1]])
        yield at, above[node]


def nearest(leaves: np.ndarray, book: np.ndarray, block: int = LEAVES):
    """Code and squared distance of each leaf; ties go to the lower entry."""
    code, error = np.empty(len(leaves), np.int64), np.empty(len(leaves), np.int64)
    for at, distances in walk(leaves, book, block):
        best = distances.argmin(axis=1)
        code[at:at + len(best)] = best
        error[at:at + len(best)] = distances[np.arange(len(best)), best]
    return code, error


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def update(parts: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: the codebooks after assigning all parts and averaging."""
    n_pos, n_entries, width = books.shape

    def run(batches):
        total = np.zeros((n_pos, n_entries, width + 1), np.int64)
        for batch in batches:
            pos = batch.column("pos").to_numpy()
            leaves, n = _matrix(batch.column("part"), width), batch.column("n").to_numpy()
            for p in np.unique(pos).tolist():
                mine = np.flatnonzero(pos == p)
                code, _ = nearest(leaves[mine], books[p])
                weighted = np.concatenate([leaves[mine], np.ones((len(mine), 1), np.int64)], axis=1) * n[mine, None]
                np.add.at(total[p], code, weighted)
        p, e = np.nonzero(total[:, :, width])
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
                                         names=["pos", "entry", "total"])

    sums = parts.mapInArrow(run, "pos int, entry int, total array<long>").groupBy("pos", "entry")
    books = books.copy()
    for r in sums.agg(*[F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"t{k}") for k in range(width + 1)]).collect():
        n = int(r[f"t{width}"])
        books[r.pos, r.entry] = [int(r[f"t{k}"]) // n for k in range(width)]
    return books


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) of ``rows`` (vec_id, v)."""
    books = first_entries(rows, entries, parts)
    if books.size:
        same = rows.where(F.size("v") == books.shape[0] * books.shape[2])
        leaves = distinct_parts(same, books.shape[2], parts)
        for _ in range(rounds):
            books = update(leaves, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, codes array, error): every row's entries in part order, and its squared distances summed."""
    n_pos, n_entries, width = books.shape
    schema = "vec_id {}, label {}, codes array<int>, error long".format(*(rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")))

    def run(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), n_pos * width)
            codes, error = np.empty((len(v), n_pos), np.int32), np.zeros(len(v), np.int64)
            for p in range(n_pos):
                leaves, leaf = np.unique(v[:, p * width:(p + 1) * width], axis=0, return_inverse=True)
                code, distance = nearest(leaves, books[p])
                codes[:, p] = code[leaf.ravel()]
                error += distance[leaf.ravel()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(list(codes), pa.list_(pa.int32())), pa.array(error)],
                                             names=["vec_id", "label", "codes", "error"])

    return rows.where(F.size("v") == n_pos * width).where(F.lit(bool(n_entries))).mapInArrow(run, schema)


def decode(coded: DataFrame, books: np.ndarray, column: str = "codes") -> DataFrame:
    """``coded`` with ``decoded``: the entries' components as numbers of the vectors' scale."""
    each = F.array(*[F.array(*[F.array(*[F.lit(int(c) / SCALE) for c in entry]) for entry in book]) for book in books])
    return coded.withColumn("decoded", F.flatten(F.transform(column, lambda code, p: each[p][code])))


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whole_vectors(table(spark, sf_dir, "embeddings"))
    books = train(rows)
    coded = save(encode(rows, books).withColumn("lkey", source_key("label")), "vc-codes")
    per_label = save(coded.groupBy("lkey").agg(F.sum("error").alias("label_error")), "vc-labels")
    out = coded.join(per_label, "lkey")
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def oracle(rounds: int = ROUNDS) -> str:
    """The same in SQL, a common table for each step of each round."""
    steps = [f"""
kept as (select vec_id, label, embedding as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or isnan(c) or isinf(c))) = 0),
c as materialized (select vec_id, i // (len(x) // {PARTS}) as pos, i % (len(x) // {PARTS}) as d,
    cast(floor({SCALE} * x[i + 1]::double) as bigint) as q
  from kept, unnest(range(len(x))) as u(i)),
b0 as materialized (select pos, d, dense_rank() over (order by vec_id) - 1 as entry, q from c
  where vec_id in (select vec_id from kept order by vec_id limit {ENTRIES}))"""]
    for k in range(rounds + 1):
        steps.append(f"""
a{k} as materialized (select vec_id, pos, entry, dist from (
    select c.vec_id, c.pos, b.entry, cast(sum((c.q - b.q) * (c.q - b.q)) as bigint) as dist
    from c join b{k} b on c.pos = b.pos and c.d = b.d group by all)
  qualify row_number() over (partition by vec_id, pos order by dist, entry) = 1)""")
        if k < rounds:
            steps.append(f"""
b{k + 1} as materialized (select b.pos, b.d, b.entry, coalesce(m.q, b.q) as q from b{k} b left join (
    select a.pos, a.entry, c.d, cast(floor(sum(c.q) / count(*)) as bigint) as q
    from a{k} a join c on a.vec_id = c.vec_id and a.pos = c.pos group by all) m
  on m.pos = b.pos and m.entry = b.entry and m.d = b.d)""")
    return "with " + ",".join(steps) + f""",
v as (select vec_id, string_agg(printf('%02x', entry), '' order by pos) as code, cast(sum(dist) as bigint) as error from a{rounds} group by vec_id)
select v.vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(q::varchar, ',' order by pos, entry, d)) from b{rounds}) as codebooks_sha256
from v join kept on v.vec_id = kept.vec_id"""


ORACLE = oracle()
