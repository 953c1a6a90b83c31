"""Temporal summaries of lookback windows straight from the flat daily statistics, without unfolding any window.

The calendar is cut into blocks of ``n_days`` days, so a window of ``n_days`` reaches into two blocks at most: it is a suffix of
the first and a prefix of the second.  The flat table (location, date, band, statistic) and two marker rows per request
(its first and its last day) are sorted by day within (location, band, statistic, block); running aggregates over the
prefix, and over the suffix, give each marker its part, and the two parts of a request are combined.  Every aggregate in
use can be combined: min, max, sum, product, counts, first and last date.  Prefixes and suffixes are made apart, so a task
sorts for one of them at a time.  So the rows are those of the days plus two
per request, whatever the length of the window, each is looked at a constant number of times, and a window partition
holds one block of one location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covspark.operators.summarise import check_temporal_stats
from covspark.operators.zonal import stats_long
from covspark.plans.enrichment import Request, event_key, matched

_KEY = ["_lat", "_lon", "_day"]
# how two parts of a window are combined, and the running aggregate that makes a part
_PARTS = {"n": F.sum, "n_valid": F.sum, "n_dates": F.sum, "start_date": F.min, "end_date": F.max, "min": F.min, "max": F.max, "sum": F.sum, "prod": F.product}


def window_parts(flat: DataFrame, asked: DataFrame, n_days: int, series: list[str], place: list[str]) -> DataFrame:
    """Per row of ``asked`` (place, day number ``d``; distinct) and series: n, n_valid, n_dates, start_date, end_date, min,
    max, sum, prod of the values dated [d - n_days + 1, d].  ``flat``: place, series, item_date, value; ``asked`` has every
    series it wants as a row."""
    at = [*place, *series]
    day, v = F.unix_date("item_date"), F.col("value")
    valid = v.isNotNull()
    per_day = flat.groupBy(*at, day.alias("day")).agg(
        F.count("*").alias("n"), F.count(v).alias("n_valid"), F.max(valid.cast("long")).alias("n_dates"),
        F.min(F.when(valid, F.col("item_date"))).alias("start_date"), F.max(F.when(valid, F.col("item_date"))).alias("end_date"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.sum(v).alias("sum"), F.product(v).alias("prod"))
    block = lambda d: F.floor(d / F.lit(n_days)).cast("long")
    first = F.col("d") - (n_days - 1)
    names = list(_PARTS)
    own = Window.partitionBy(*at, "block")

    def side(marks: DataFrame, order) -> DataFrame:
        """The running aggregates at ``marks`` (at, d, day): a task sorts the days and the marks of one side."""
        rows = per_day.withColumn("mark", F.lit(0)).unionByName(marks.withColumn("mark", F.lit(1)), allowMissingColumns=True)
        upto = own.orderBy(order, "mark").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("block", block(F.col("day")))
        return rows.select(*at, "d", "mark", *[f(n).over(upto).alias(n) for n, f in _PARTS.items()]).where("mark > 0").select(*at, "d", *names)

    ends = side(asked.select(*at, "d", F.col("d").alias("day")), F.col("day").asc())
    # a window that begins with its block is that block's prefix alone
    begins = side(asked.where(block(first) != block(F.col("d"))).select(*at, "d", first.alias("day")), F.col("day").desc())
    return ends.unionByName(begins).groupBy(*at, "d").agg(*[f(n).alias(n) for n, f in _PARTS.items()])


def summarise_windows(se: DataFrame, items: DataFrame, cells: DataFrame, *, covariate_id: str, n_days: int, temporal_stats=("min", "max", "mean"),
                      nulls: str = "reference", covariate: str | None = None, spatial_stats=("mean",), radius: float = 100.0, bands=(1,),
                      date_col: str = "sample_date", cell_deg: float = 0.0, output_col: str = "summary_zonal_statistics") -> DataFrame:
    """``se`` with the temporal summary of a daily covariate's zonal statistics, as ``summarise_zonal_statistics`` of
    ``zonal_statistics`` gives it: ARRAY<STRUCT<covariate, start_date, end_date, n_dates, band, spatial_stat, temporal_stat, value>>.
    The windows are never nested or exploded, so ``n_days`` may be a year or more."""
    names = check_temporal_stats(temporal_stats)
    if nulls not in ("reference", "skip"):
        raise ValueError("nulls must be 'reference' or 'skip'")
    request = Request(covariate_id, "daily", {int(b): None for b in bands}, title=covariate, stats=list(spatial_stats), radius=float(radius),
                      n_days=n_days, cell_deg=cell_deg)
    if "freq_hist" in request.stats:
        raise ValueError("freq_hist has no temporal summary")
    m = matched(se, [request], items, cells, date_col=date_col)
    flat = stats_long(m.wide, ["_lat", "_lon", "item_date", "band"], m.stats).withColumn("band", F.col("band").cast("int"))
    series = F.array(*[F.struct(F.lit(int(b)).alias("band"), F.lit(s).alias("spatial_stat")) for b in request.bands for s in m.stats])
    ev = event_key(se, date_col)
    asked = ev.select(*_KEY).distinct().select("_lat", "_lon", F.unix_date("_day").alias("d"), F.inline(series))
    parts = window_parts(flat, asked, n_days, ["band", "spatial_stat"], ["_lat", "_lon"])
    per_key = parts.groupBy(F.struct("_lat", "_lon", F.date_from_unix_date("d").alias("_day")).alias("k")).agg(F.collect_list(F.struct(
        "band", "spatial_stat", *_PARTS)).alias("parts")).select("k.*", "parts")
    out = ev.join(per_key, _KEY, "left")

    def value(stat, p):
        v = {"mean": p["sum"] / p["n_valid"]}.get(stat, p[stat] if stat in ("min", "max", "sum", "prod") else None)
        whole = p["n_valid"] > 0 if stat == "mean" or nulls == "skip" else (p["n_valid"] > 0) & (p["n"] == p["n_valid"])
        return F.when(whole, v)

    def rows(s):
        p = F.get(F.filter("parts", lambda x: (x["band"] == s["band"]) & (x["spatial_stat"] == s["spatial_stat"])), F.lit(0))
        return F.array(*[F.struct(
            F.lit(request.title).alias("covariate"), p["start_date"].alias("start_date"), p["end_date"].alias("end_date"),
            F.coalesce(p["n_dates"], F.lit(0)).cast("bigint").alias("n_dates"), s["band"].cast("double").alias("band"),
            s["spatial_stat"].alias("spatial_stat"), F.lit(t).alias("temporal_stat"), value(t, p).cast("double").alias("value")) for t in names])

    return out.withColumn(output_col, F.flatten(F.transform(series, rows))).drop("parts", *_KEY)
