"""Temporal summary of nested zonal statistics.

Each event's statistics live in its own array, so the summary is computed in
place with higher-order functions: no unnest, no shuffle, no row id and no
join back.  The wide passthrough columns never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from covspark.operators.reshape import is_nested

# The supported temporal statistics and NULL policies.
TEMPORAL_STATS = ("min", "max", "mean", "sum", "prod")
NULL_POLICIES = ("reference", "skip")
_NOT_KEYS = {"date", "value", "hist"}


def _group_fields(df: DataFrame, col: str) -> list[str]:
    t = df.schema[col].dataType
    assert isinstance(t, ArrayType) and isinstance(t.elementType, StructType)
    return [f.name for f in t.elementType.fields if f.name not in _NOT_KEYS]


def _acc_init() -> Column:
    return F.struct(
        F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("nn"),
        F.lit(0.0).alias("s"), F.lit(1.0).alias("p"),
        F.lit(None).cast("double").alias("mn"), F.lit(None).cast("double").alias("mx"),
        F.lit(None).cast("date").alias("d0"), F.lit(None).cast("date").alias("d1"))


def _acc_merge(acc: Column, x: Column) -> Column:
    v = x["value"]
    ok = v.isNotNull()
    dated = ok & x["date"].isNotNull()
    return F.struct(
        (acc["n"] + 1).alias("n"),
        (acc["nn"] + F.when(ok, 1).otherwise(0)).alias("nn"),
        (acc["s"] + F.coalesce(v, F.lit(0.0))).alias("s"),
        (acc["p"] * F.coalesce(v, F.lit(1.0))).alias("p"),
        F.when(ok, F.least(acc["mn"], v)).otherwise(acc["mn"]).alias("mn"),
        F.when(ok, F.greatest(acc["mx"], v)).otherwise(acc["mx"]).alias("mx"),
        F.when(dated, F.least(acc["d0"], x["date"])).otherwise(acc["d0"]).alias("d0"),
        F.when(dated, F.greatest(acc["d1"], x["date"])).otherwise(acc["d1"]).alias("d1"))


def _dates(rows: Column) -> Column:
    """Number of distinct dates with a value."""
    dated = F.filter(rows, lambda x: x["value"].isNotNull() & x["date"].isNotNull())
    return F.size(F.array_distinct(F.transform(dated, lambda x: x["date"]))).cast("bigint")


def _stat(a: Column, stat: str, nulls: str) -> Column:
    any_null = a["n"] > a["nn"]
    has = a["nn"] > 0
    raw = {"min": a["mn"], "max": a["mx"], "sum": a["s"], "prod": a["p"]}
    if stat == "mean":  # skips NULLs under both policies
        return F.when(has, a["s"] / a["nn"])
    if nulls == "reference":
        return F.when(~any_null & has, raw[stat])
    return F.when(has, raw[stat])


def check_temporal_stats(stats) -> list[str]:
    stats = [stats] if isinstance(stats, str) else list(stats)
    bad = [x for x in stats if x not in TEMPORAL_STATS]
    if bad:
        raise ValueError(f"unknown temporal_stats {bad}; options: {', '.join(TEMPORAL_STATS)}")
    return stats


def summarise_zonal_statistics(df: DataFrame, temporal_stats=("min", "max", "mean"),
                               nulls: str = "reference", input_col: str = "zonal_statistics",
                               output_col: str = "summary_zonal_statistics") -> DataFrame:
    """Add ``output_col``: per (covariate, band, [band_name], spatial_stat) and
    temporal stat, the summary value plus the coverage (first and last date
    and number of distinct dates with a value; NULL, NULL, 0 when none).

    ``nulls="reference"``: min / max / sum / prod are NULL when any value is
    NULL, mean skips NULLs.  ``nulls="skip"``: every stat skips NULLs.
    """
    if not is_nested(df, input_col):
        raise ValueError(f"column {input_col!r} must hold nested zonal statistics")
    stats = [temporal_stats] if isinstance(temporal_stats, str) else list(temporal_stats)
    bad = [s for s in stats if s not in TEMPORAL_STATS]
    if bad or not stats:
        raise ValueError(f"unsupported temporal_stats {bad}; options: {', '.join(TEMPORAL_STATS)}")
    if nulls not in NULL_POLICIES:
        raise ValueError(f"nulls must be one of {NULL_POLICIES}")
    keys = _group_fields(df, input_col)
    arr = F.col(input_col)

    def key_of(x):
        return F.struct(*[x[k].alias(k) for k in keys])

    def same(x, k):
        cond = F.lit(True)
        for f in keys:
            cond = cond & x[f].eqNullSafe(k[f])
        return cond

    groups = F.array_sort(F.array_distinct(F.transform(arr, key_of)))
    # each group's rows are picked once; an array of one group is taken as it is
    own = F.transform("_group_keys", lambda k: F.struct(
        k.alias("k"), F.when(F.size("_group_keys") == 1, arr).otherwise(F.filter(arr, lambda x: same(x, k))).alias("rows")))
    per_group = F.transform(own, lambda g: F.struct(
        g["k"].alias("k"), F.aggregate(g["rows"], _acc_init(), _acc_merge).alias("a"), _dates(g["rows"]).alias("n_dates")))

    def element(g, stat):
        k, a = g["k"], g["a"]
        fields = [k["covariate"].alias("covariate") if "covariate" in keys else None,
                  a["d0"].alias("start_date"), a["d1"].alias("end_date"),
                  g["n_dates"].alias("n_dates")]
        fields += [k[f].alias(f) for f in keys if f != "covariate"]
        fields += [F.lit(stat).alias("temporal_stat"), _stat(a, stat, nulls).alias("value")]
        return F.struct(*[f for f in fields if f is not None])

    out = df.withColumn("_group_keys", groups).withColumn("_groups", per_group)
    def for_stat(stat):
        return lambda g: element(g, stat)

    summary = F.flatten(F.array(*[F.transform("_groups", for_stat(s)) for s in stats]))
    return out.withColumn(output_col, summary).drop("_groups", "_group_keys")


def is_trivial_summary(df: DataFrame, input_col: str = "zonal_statistics") -> DataFrame:
    """One row: whether every (event, group) holds a single value, i.e. the
    summary would change nothing.  Lazy; the caller decides to run it."""
    keys = _group_fields(df, input_col)

    def key_of(x):
        return F.struct(*[x[k].alias(k) for k in keys])

    def same(x, k):
        cond = F.lit(True)
        for f in keys:
            cond = cond & x[f].eqNullSafe(k[f])
        return cond

    arr = F.col(input_col)
    sizes = F.transform(F.array_distinct(F.transform(arr, key_of)),
                        lambda k: F.size(F.filter(arr, lambda x: same(x, k))))
    per_row = df.select(F.array_max(sizes).alias("_m"))
    return per_row.agg(
        (F.coalesce(F.max("_m"), F.lit(1)) == 1).alias("trivial"),
        F.max("_m").cast("bigint").alias("max_values_per_group"),
        F.count(F.lit(1)).alias("n_rows"))
