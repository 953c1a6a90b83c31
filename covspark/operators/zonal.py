"""Zonal statistics: aggregate the cells within a disc round each location.

Definitions (the statistics service is not part of the reference, so these
are ours, following common raster-statistics tools): only valid (non-NULL)
cells count unless noted; ``std`` is the population standard deviation;
``majority`` / ``minority`` break ties towards the smallest value; ``area`` is
the summed area of valid cells in square metres; ``nodata`` counts cells in
the disc without a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the statistic names, in the reference's documented order.
SPATIAL_STATS = ("min", "max", "mean", "count", "sum", "std", "median", "majority",
                 "minority", "unique", "range", "nodata", "area", "freq_hist")
SCALAR_STATS = tuple(s for s in SPATIAL_STATS if s != "freq_hist")
# statistics that the count of each (group, value) answers
_BY_VALUE = {"median", "majority", "minority", "unique", "freq_hist"}


def check_stats(stats) -> list[str]:
    stats = [stats] if isinstance(stats, str) else list(stats)
    bad = [s for s in stats if s not in SPATIAL_STATS]
    if bad:
        raise ValueError(f"unknown spatial_stats {bad}; options: {', '.join(SPATIAL_STATS)}")
    if len(set(stats)) != len(stats):
        raise ValueError("spatial_stats must not repeat")
    return stats


def _one_pass(stat: str) -> Column:
    v = F.col("value")
    valid = v.isNotNull()
    exprs = {
        "min": F.min(v),
        "max": F.max(v),
        "mean": F.avg(v),
        "count": F.count(v).cast("double"),
        "sum": F.sum(v),
        "std": F.stddev_pop(v),
        "median": F.percentile_approx(v, 0.5, 10000).cast("double"),
        "range": F.max(v) - F.min(v),
        "nodata": F.count_if(~valid).cast("double"),
        "area": F.sum(F.when(valid, F.col("cell_area_m2"))),
    }
    return exprs[stat]


def _from_counts(stat: str) -> Column:
    """A statistic of a group from its rows (value, _n, _area), one per distinct value; a NULL value holds the
    cells without data."""
    v, n = F.col("value"), F.col("_n")
    valid = v.isNotNull()
    some = F.when(valid, n)
    total = F.sum(v * n)
    mean = total / F.sum(some)
    # the second moment needs the mean: two folds over the group's distinct values
    pairs = F.collect_list(F.when(valid, F.struct(v.alias("v"), n.alias("n"))))
    spread = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + p["n"] * F.pow(p["v"] - mean, 2))
    exprs = {
        "min": F.min(v),
        "max": F.max(v),
        "mean": mean,
        "count": F.coalesce(F.sum(some), F.lit(0)).cast("double"),
        "sum": total,
        "std": F.when(F.count(v) > 0, F.sqrt(spread / F.sum(some))),
        "median": F.percentile(v, F.lit(0.5), F.coalesce(some, F.lit(0))),
        "majority": F.max_by(v, F.when(valid, F.struct(n.alias("n"), (-v).alias("v")))),
        "minority": F.min_by(v, F.when(valid, F.struct(n.alias("n"), v.alias("v")))),
        "unique": F.count(v).cast("double"),
        "range": F.max(v) - F.min(v),
        "nodata": F.coalesce(F.sum(F.when(~valid, n)), F.lit(0)).cast("double"),
        "area": F.coalesce(F.sum(F.when(valid, F.col("_area"))), F.lit(0.0)),
        "freq_hist": F.map_from_entries(F.array_sort(F.collect_list(F.when(valid, F.struct(v.alias("value"), n.alias("_cnt")))))),
    }
    return exprs[stat]


def zonal_aggregate(hits: DataFrame, keys, stats, approx_stats: bool = False) -> DataFrame:
    """Wide statistics: one row per group of ``keys``, one column per stat.

    ``hits`` holds one row per (group, cell) with ``value`` and ``cell_area_m2``, and is read once.  Without
    median, majority, minority, unique or freq_hist all is one partial + final hash aggregate.  With any of them
    the cells are first counted per (group, value), which map-side combine shrinks, and every statistic is made
    of that table by a second aggregate on the same keys.  ``approx_stats`` takes a median that needs no counts
    otherwise from a quantile summary instead.  ``area`` of a group with no valid cell is 0.
    """
    stats = check_stats(stats)
    keys = list(keys)
    hits = hits.withColumn("value", F.col("value").cast("double"))
    if not set(stats) & (_BY_VALUE - {"median"} if approx_stats else _BY_VALUE):
        out = hits.groupBy(*keys).agg(*[_one_pass(s).alias(s) for s in stats])
        return out.withColumn("area", F.coalesce("area", F.lit(0.0))) if "area" in stats else out
    counts = hits.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_n"), F.sum("cell_area_m2").alias("_area"))
    return counts.groupBy(*keys).agg(*[_from_counts(s).alias(s) for s in stats])


def band_number(band) -> Column:
    """Number of a band given as text, ``"band_3"`` or ``"3"`` -> 3.0; other text gives NULL."""
    return F.regexp_replace(band.cast("string"), "^band_", "").try_cast("double")


def stats_long(wide: DataFrame, keys, stats) -> DataFrame:
    """Wide -> long: (keys..., spatial_stat, value); NULL values kept.
    ``freq_hist`` rides along as a ``hist`` map column (NULL on other rows)."""
    hist_t = "map<double,bigint>"
    rows = [F.struct(F.lit(s).alias("spatial_stat"),
                     (F.lit(None) if s == "freq_hist" else F.col(s)).cast("double").alias("value"),
                     (F.col(s) if s == "freq_hist" else F.lit(None)).cast(hist_t).alias("hist")) for s in stats]
    out = wide.select(*keys, F.inline(F.array(*rows)))
    return out if "freq_hist" in stats else out.drop("hist")
