"""Nested results: nest, unnest, complete (list-column equivalents)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def nest(df: DataFrame, keys, payload: list[Column], name: str, sort_key: list[Column] | None = None,
         place: str | None = None, whole: Column | None = None) -> DataFrame:
    """Rows -> ARRAY<STRUCT> per key, sorted by ``sort_key`` then payload.

    One hash aggregate; the group is the key's own rows (bounded by the
    caller, e.g. n_days x bands x stats per request).

    ``place`` is a column by which the rows are dealt already, and ``whole``
    tells the keys that have one value of it: their rows are grouped where they
    lie, without a shuffle, and only those of other keys are shuffled.  Without
    such a dealing the result is the same.
    """
    keys = list(keys)
    if place is not None:
        one = nest(df.where(whole), [place, *keys], payload, name, sort_key).drop(place)
        return one.unionByName(nest(df.where(~whole), keys, payload, name, sort_key))
    sort_key = sort_key or []
    names = [f"_k{i}" for i in range(len(sort_key))]
    fields = [k.alias(n) for k, n in zip(sort_key, names)] + [F.struct(*payload).alias("_p")]
    collected = F.collect_list(F.struct(*fields))
    if names:
        # compare on the sort keys only (the payload may hold unorderable maps)
        def cmp(a, b):
            out = F.lit(0)
            for n in reversed(names):
                out = (F.when(a[n] < b[n], F.lit(-1)).when(a[n] > b[n], F.lit(1)).otherwise(out))
            return out
        collected = F.array_sort(collected, cmp)
    return df.groupBy(*keys).agg(F.transform(collected, lambda e: e["_p"]).alias(name))


def unnest(df: DataFrame, name: str, outer: bool = True) -> DataFrame:
    """ARRAY<STRUCT> column -> one row per element (``inline_outer`` keeps
    rows whose array is empty or NULL, with NULL fields)."""
    rest = [c for c in df.columns if c != name]
    fn = F.inline_outer if outer else F.inline
    return df.select(*rest, fn(F.col(name)))


def is_nested(df: DataFrame, name: str) -> bool:
    """True when ``name`` is an ARRAY<STRUCT> column (schema check, no job)."""
    if name not in df.columns:
        return False
    t = df.schema[name].dataType
    return isinstance(t, ArrayType) and isinstance(t.elementType, StructType)


def missing_rows(arr: Column, domain: list[dict], match_fields: list[str], make_row) -> Column:
    """Elements of the literal ``domain`` not present in ``arr`` (compared on
    ``match_fields``), each turned into a struct by ``make_row``.

    Completion happens per row with higher-order functions, so no global
    cross join of every key with every band and stat is ever built.
    """
    dom = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in d.items()]) for d in domain])

    def present(d):
        return F.coalesce(F.exists(arr, lambda x: _all_eq(x, d, match_fields)), F.lit(False))

    return F.transform(F.filter(dom, lambda d: ~present(d)), make_row)


def _all_eq(x, d, fields) -> Column:
    cond = F.lit(True)
    for f in fields:
        cond = cond & (x[f] == d[f])
    return cond


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """``df`` with a row id that recomputation doesn't change: a hash of the row and, among equal rows, a number.  Equal
    rows can't be told apart, so it doesn't matter which of them has which number.  The copies of one row are numbered in one task (a
    sort that spills), so this is for tables whose rows aren't repeated without bound."""
    h = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    number = F.row_number().over(Window.partitionBy("_h").orderBy("_h"))
    return df.withColumn("_h", h).withColumn(name, F.concat_ws("-", F.lower(F.hex("_h")), number.cast("string"))).drop("_h")


def with_group_count(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """``df`` with the number of rows that share its ``keys`` (NULLs together).  Counted with partial aggregation and joined
    back on a hash of the keys and the keys themselves, so a key that very many rows hold is a skewed join that AQE splits."""
    keys = list(keys)
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_count"))
    found = found.select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_count").withColumn("_gh", F.xxhash64(*[f"_g_{k}" for k in keys]))
    same = F.col("_gh_of") == F.col("_gh")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    out = df.withColumn("_gh_of", F.xxhash64(*keys)).join(found, same, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_count").alias(name))
