"""Suffix array of a collection of strings by the difference-cover algorithm (modulo 3), as Spark sorts.

A level sorts the triples at the sampled places (1 and 2 modulo 3) and names them in order.  If two names agree, the
sequences of names are themselves strings and their suffixes are ranked by the next level.  The remaining suffixes
(0 modulo 3) are merged by two sorts: by (symbol, rank of the next) against those of 1 modulo 3, and by (two symbols,
rank of the one after) against those of 2 modulo 3; the counts of what stands before give every suffix its rank.

Every step is a range partitioning with a sort inside the ranges; ranges hand on only their counts.  Each level's sorted
rows are written to the shared folder, so a lost executor costs one step.  Strings must end with a symbol that occurs
nowhere else, which keeps suffixes apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

_I = np.int64


def _flat(batch: pa.RecordBatch, column: str):
    arr = batch.column(column)
    off = arr.offsets.to_numpy().astype(_I)
    values = arr.values.to_numpy(zero_copy_only=False).astype(_I)[off[0]:off[-1]]
    off = off - off[0]
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return values, off, row, np.arange(len(values)) - off[row]


def _after(values, off, row, step):
    """The symbol ``step`` places on in the same string, 0 beyond its end."""
    at = np.arange(len(values)) + step
    out = np.zeros(len(values), _I)
    ok = at < off[row + 1]
    out[ok] = values[at[ok]]
    return out


def _batch(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(v), pa.int64()) for v in cols.values()], names=list(cols))


def _sorted(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _before(parts) -> dict[int, tuple]:
    """Sums over the earlier ranges of what each range counted: {range: sums}."""
    out, total = {}, None
    for pid, *counts in sorted(tuple(r) for r in parts):
        total = total or [0] * len(counts)
        out[pid] = tuple(total)
        total = [a + b for a, b in zip(total, counts)]
    out[-1] = tuple(total or ())
    return out


def _add_before(df: DataFrame, before: dict[int, tuple], k: int):
    """The column of the sum that the row's range starts from."""
    spark = df.sparkSession
    table = spark.createDataFrame([(p, int(v[k])) for p, v in before.items() if p >= 0] or [(-1, 0)], "pid long, start long")
    return df.join(F.broadcast(table), "pid")  # one row per range


def _triples(batches):
    for batch in batches:
        v, off, row, i = _flat(batch, "syms")
        sid = batch.column("sid").to_numpy().astype(_I)[row]
        take = i % 3 != 0
        yield _batch(a=v[take], b=_after(v, off, row, 1)[take], c=_after(v, off, row, 2)[take], sid=sid[take], i=i[take])


def _name(batches):
    pid, last, name = TaskContext.get().partitionId(), None, -1
    for batch in batches:
        abc = np.stack([batch.column(c).to_numpy() for c in "abc"], axis=1)
        if not len(abc):
            continue
        new = np.ones(len(abc), bool)
        new[1:] = (abc[1:] != abc[:-1]).any(axis=1)
        new[0] = last is None or tuple(abc[0]) != last
        names = name + np.cumsum(new)
        name, last = int(names[-1]), tuple(abc[-1])
        yield _batch(pid=np.full(len(abc), pid), sid=batch.column("sid").to_numpy(), i=batch.column("i").to_numpy(), name=names)


def _gather(rows: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """One array per key, in order of ``i``."""
    return (rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", value))).alias("x"))
            .select(*keys, F.transform("x", lambda s: s[value]).alias(alias)))


def _merge_rows(second: bool):
    """Rows of the first sort (0 and 1 modulo 3) or the second (0 and 2)."""
    def run(batches):
        for batch in batches:
            v, off, row, i = _flat(batch, "syms")
            sid = batch.column("sid").to_numpy().astype(_I)[row]
            rank = np.zeros(len(v), _I)  # from 1; 0: beyond the end
            for res in (1, 2):
                r, roff, rrow, k = _flat(batch, f"r{res}")
                rank[off[rrow] + 3 * k + res] = r + 1
            res = i % 3
            take = res != (1 if second else 2)
            kind = (res != 0).astype(_I)
            after = _after(rank, off, row, 2 if second else 1)
            cols = {"t": v, "u": _after(v, off, row, 1)} if second else {"t": v}
            cols |= {"r": after, "kind": kind, "sid": sid, "i": i, "own": rank - 1}
            yield _batch(**{k: x[take] for k, x in cols.items()})
    return run


def _count(batches):
    """Per row how many rows of each kind stand before it in its range."""
    pid, zero, one = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        if not len(kind):
            continue
        ones = np.cumsum(kind)
        zeros = np.cumsum(1 - kind)
        yield _batch(pid=np.full(len(kind), pid), sid=batch.column("sid").to_numpy(), i=batch.column("i").to_numpy(), kind=kind,
                     own=batch.column("own").to_numpy(), zeros=zero + zeros - (1 - kind), ones=one + ones - kind)
        zero, one = zero + int(zeros[-1]), one + int(ones[-1])


def _counted(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(sid, i, kind, own, zeros, ones) with the counts over all ranges."""
    out = save(_sorted(rows, keys).mapInArrow(_count, "pid long, sid long, i long, kind long, own long, zeros long, ones long"), name)
    parts = out.groupBy("pid").agg(F.sum(1 - F.col("kind")), F.sum("kind")).collect()  # one row per range
    before = _before(parts)
    out = _add_before(out, before, 0).withColumn("zeros", F.col("zeros") + F.col("start")).drop("start")
    return _add_before(out, before, 1).withColumn("ones", F.col("ones") + F.col("start")).drop("start")


def suffix_ranks(strings: DataFrame) -> DataFrame:
    """(sid, ranks): the rank, from 0, of every suffix of ``strings`` (sid, syms array<bigint>)."""
    strings = strings.select("sid", "syms")
    named = save(_sorted(strings.mapInArrow(_triples, "a long, b long, c long, sid long, i long"), ["a", "b", "c"])
                 .mapInArrow(_name, "pid long, sid long, i long, name long"), "names")
    parts = named.groupBy("pid").agg(F.max("name") + 1, F.count("*")).collect()  # one row per range
    before = _before(parts)
    if not parts:  # no string has two symbols
        r = strings.select("sid", F.array().cast("array<bigint>").alias("r1"), F.array().cast("array<bigint>").alias("r2"))
    else:
        named = _add_before(named, before, 0).select("sid", "i", (F.col("name") + F.col("start")).alias("name"))
        inner = _gather(named.withColumn("sid", F.col("sid") * 2 + F.col("i") % 3 - 1), ["sid"], "name", "syms")
        distinct, total = before[-1]
        if distinct < total:
            inner = suffix_ranks(save(inner, "inner")).withColumnRenamed("ranks", "syms")
        side = lambda res: F.max(F.when(F.col("sid") % 2 == res - 1, F.col("syms"))).alias(f"r{res}")
        none = F.array().cast("array<bigint>")
        r = inner.groupBy(F.floor(F.col("sid") / 2).alias("of")).agg(side(1), side(2)).select(
            F.col("of").alias("sid"), F.coalesce("r1", none).alias("r1"), F.coalesce("r2", none).alias("r2"))
    joined = strings.join(r, "sid", "left")
    none = F.array().cast("array<bigint>")
    joined = save(joined.select("sid", "syms", F.coalesce("r1", none).alias("r1"), F.coalesce("r2", none).alias("r2")), "ranked")
    first = _counted(joined.mapInArrow(_merge_rows(False), "t long, r long, kind long, sid long, i long, own long"), ["t", "r"], "merge")
    second = _counted(joined.mapInArrow(_merge_rows(True), "t long, u long, r long, kind long, sid long, i long, own long"), ["t", "u", "r"], "merge")
    one = F.col("kind") == 1
    given = first.select("sid", "i", F.when(one, F.col("own") + F.col("zeros")).otherwise(F.col("zeros") + F.col("ones")).alias("v"))
    given = given.unionByName(second.select("sid", "i", F.when(one, F.col("own") + F.col("zeros")).otherwise(F.col("ones")).alias("v")))
    rank = given.repartition("sid").groupBy("sid", "i").agg(F.sum("v").alias("v"))
    return save(_gather(rank, ["sid"], "v", "ranks"), "ranks")
