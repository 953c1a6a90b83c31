"""Zonal statistics and temporal summaries over the raster fixture."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covspark.functions import sqltext as sq
from covspark.operators import temporal
from covspark.operators.reshape import unnest
from covspark.plans.zonal_statistics import zonal_statistics
from covspark.sources import fixtures as fx
from covspark.sources.fixtures import with_fixtures
from covspark.queries.common import register, r6, RADIUS_M, N_DAYS, CELL_HALF_DEG

def _zonal(spark, sf, stats, bands=(1,), cadence="daily", items=None, n_days=N_DAYS,
           radius=RADIUS_M, band_names=None):
    ev = fx.f_events(spark, sf)
    cells = fx.f_cells(spark, sf)
    if items is None:
        items = fx.sst_items(cells)
    return zonal_statistics(ev, items, cells, covariate_id=fx.SST_COVARIATE, cadence=cadence,
                            spatial_stats=stats, radius=radius, n_days=n_days, bands=bands,
                            band_names=band_names, cell_deg=2 * CELL_HALF_DEG)


def _zonal_flat(zs: DataFrame) -> DataFrame:
    flat = unnest(zs.select("event_key", "zonal_statistics"), "zonal_statistics", outer=False)
    return flat.select(*[r6(c) if c == "value" else F.col(c) for c in flat.columns if c != "hist"])


def _zonal_ctes(stats_sql: dict, bands=(1,), window="daily", n_days=N_DAYS,
                radius=RADIUS_M, st_sql: str | None = None, label: str = "sst") -> str:
    """Brute-force oracle CTEs: every (location, item) against every cell of
    that date with the exact distance, aggregates, completion by NOT EXISTS.
    Ends with ``allrows`` (event_key, covariate, date, band, spatial_stat, value)."""
    dist = sq.cell_distance("li.lat", "li.lon", "c.cy", "c.cx", "c.half_deg")
    band_list = ", ".join(str(b) for b in bands)
    if st_sql is None:
        stat_cols = ",\n      ".join(f'{expr} as "{name}"' for name, expr in stats_sql.items())
        st_sql = f"""st as (select lat, lon, item_date, band,
      {stat_cols}
    from hits group by lat, lon, item_date, band)"""
    unions = "\n    union all ".join(
        f"select lat, lon, item_date, band, '{s}' as spatial_stat, cast(\"{s}\" as double) as value from st"
        for s in stats_sql)
    if window == "daily":
        ri = f"""select distinct r.lat, r.lon, r.d, i.item_date from req r
      join items i on i.item_date between r.d - {n_days - 1} and r.d"""
    elif window == "periodic":
        ri = """select r.lat, r.lon, r.d, i.item_date from req r
      asof left join items i on r.d >= i.item_date"""
    else:  # once: the one (latest) item for everyone
        ri = """select r.lat, r.lon, r.d, (select max(item_date) from items) as item_date from req r"""
    dom = "\n    union all ".join(
        f"select cast({b} as double) as band, '{s}' as spatial_stat"
        for b in bands for s in stats_sql)
    return f"""
cells as (select * from f_cells where band in ({band_list})),
items as (select distinct item_date from f_cells),
req as (select distinct latitude as lat, longitude as lon, sample_date as d from f_events),
ri as ({ri}),
li as (select distinct lat, lon, item_date from ri where item_date is not null),
hits as (select li.lat, li.lon, li.item_date, c.band, c.value,
           {sq.cell_area('c.cy', 'c.half_deg')} as cell_area_m2
    from li join cells c on c.item_date = li.item_date
    where {dist} <= {radius}),
{st_sql},
lng as ({unions}),
dated as (select e.event_key, '{label}' as covariate, l.item_date as date, cast(l.band as double) as band,
           l.spatial_stat, l.value
    from f_events e join ri on ri.lat = e.latitude and ri.lon = e.longitude and ri.d = e.sample_date
    join lng l on l.lat = ri.lat and l.lon = ri.lon and l.item_date = ri.item_date),
dom as ({dom}),
fill as (select e.event_key, '{label}' as covariate, cast(null as date) as date, dom.band, dom.spatial_stat,
           cast(null as double) as value
    from f_events e cross join dom
    where not exists (select 1 from dated x where x.event_key = e.event_key
                      and x.band = dom.band and x.spatial_stat = dom.spatial_stat)),
allrows as (select * from dated union all select * from fill)"""


def _zonal_oracle(stats_sql: dict, bands=(1,), window="daily", n_days=N_DAYS,
                  radius=RADIUS_M, band_names=None, st_sql=None, final: str | None = None,
                  label: str = "sst") -> str:
    names_sql = ""
    if band_names:
        cases = " ".join(f"when {float(b)} then '{n}'" for b, n in band_names.items())
        names_sql = f", case band {cases} end as band_name"
    final = final or (f"select event_key, covariate, date, band{names_sql}, spatial_stat, "
                      f"round(value, 6) as value from allrows")
    ctes = _zonal_ctes(stats_sql, bands, window, n_days, radius, st_sql, label)
    sep = "" if final.lstrip().startswith(",") else "\n"
    return with_fixtures(f"with {ctes}{sep}{final}", "f_events", "f_cells")


ZONAL_SQL = {
    "min": "min(value)", "max": "max(value)", "mean": "avg(value)",
    "count": "count(value)", "sum": "sum(value)", "std": "stddev_pop(value)",
    "median": "median(value)", "range": "max(value) - min(value)",
    "unique": "count(distinct value)", "nodata": "count(*) - count(value)",
    "area": "coalesce(sum(case when value is not null then cell_area_m2 end), 0)",
}


@register("zonal_daily", _zonal_oracle({"mean": ZONAL_SQL["mean"]}))
def q_zonal_daily(spark, sf):
    """Flagship: daily covariate, 30-day lookback, mean within 250 km."""
    return _zonal_flat(_zonal(spark, sf, ["mean"]))


@register("band_numbers", with_fixtures("""
select band_text, cast(replace(band_text, 'band_', '') as double) as band, n
from (select 'band_' || band as band_text, count(*) as n from f_cells group by band)""", "f_cells"))
def q_band_numbers(spark, sf):
    """Band texts as a statistics service names them, and their numbers."""
    from covspark.operators.zonal import band_number
    texts = fx.f_cells(spark, sf).select(F.concat(F.lit("band_"), F.col("band").cast("string")).alias("band_text"))
    return texts.groupBy("band_text").agg(F.count("*").alias("n")).select("band_text", band_number(F.col("band_text")).alias("band"), "n")


@register("zonal_default_radius", _zonal_oracle({"mean": ZONAL_SQL["mean"]}, radius=100.0))
def q_zonal_default_radius(spark, sf):
    """The default radius, without any tuning argument."""
    cells = fx.f_cells(spark, sf)
    return _zonal_flat(zonal_statistics(fx.f_events(spark, sf), fx.sst_items(cells), cells, covariate_id=fx.SST_COVARIATE,
                                        cadence="daily", n_days=N_DAYS))


@register("zonal_date_col", _zonal_oracle({"max": ZONAL_SQL["max"]}))
def q_zonal_date_col(spark, sf):
    """A date column of another name."""
    cells = fx.f_cells(spark, sf)
    ev = fx.f_events(spark, sf).withColumnRenamed("sample_date", "collected_on")
    return _zonal_flat(zonal_statistics(ev, fx.sst_items(cells), cells, covariate_id=fx.SST_COVARIATE, cadence="daily", n_days=N_DAYS,
                                        spatial_stats=["max"], radius=RADIUS_M, date_col="collected_on", cell_deg=2 * CELL_HALF_DEG))


BASIC = ["min", "max", "mean", "count", "sum", "std", "range"]


@register("zonal_basic", _zonal_oracle({s: ZONAL_SQL[s] for s in BASIC}))
def q_zonal_basic(spark, sf):
    return _zonal_flat(_zonal(spark, sf, BASIC))


@register("zonal_median", _zonal_oracle({"median": ZONAL_SQL["median"]}))
def q_zonal_median(spark, sf):
    return _zonal_flat(_zonal(spark, sf, ["median"]))


@register("zonal_unique", _zonal_oracle({"unique": ZONAL_SQL["unique"]}))
def q_zonal_unique(spark, sf):
    return _zonal_flat(_zonal(spark, sf, ["unique"]))


@register("zonal_nodata", _zonal_oracle({"nodata": ZONAL_SQL["nodata"], "count": ZONAL_SQL["count"]}))
def q_zonal_nodata(spark, sf):
    return _zonal_flat(_zonal(spark, sf, ["nodata", "count"]))


def _st_counts(order: str, name: str) -> str:
    """Oracle `st` for majority / minority: value counts, then row_number."""
    return f"""vc as (select lat, lon, item_date, band, value, count(*) as n from hits
      where value is not null group by lat, lon, item_date, band, value),
g as (select distinct lat, lon, item_date, band from hits),
pick as (select * from (select *, row_number() over (
      partition by lat, lon, item_date, band order by {order}) as rn from vc) where rn = 1),
st as (select g.lat, g.lon, g.item_date, g.band, pick.value as "{name}"
    from g left join pick on pick.lat = g.lat and pick.lon = g.lon
      and pick.item_date = g.item_date and pick.band = g.band)"""


@register("zonal_majority", _zonal_oracle({"majority": None}, st_sql=_st_counts("n desc, value asc", "majority")))
def q_zonal_majority(spark, sf):
    return _zonal_flat(_zonal(spark, sf, ["majority"]))


@register("zonal_minority", _zonal_oracle({"minority": None}, st_sql=_st_counts("n asc, value asc", "minority")))
def q_zonal_minority(spark, sf):
    return _zonal_flat(_zonal(spark, sf, ["minority"]))


@register("zonal_area", _zonal_oracle({"area": f"round({ZONAL_SQL['area']} / 1e6, 6)"}))
def q_zonal_area(spark, sf):
    """Summed area of valid cells, reported in km2 (rounded, so both engines agree)."""
    zs = _zonal(spark, sf, ["area"])
    flat = _zonal_flat(zs)
    return flat.withColumn("value", F.round(F.round(F.col("value") / 1e6, 6), 6))


@register("zonal_freq_hist", _zonal_oracle({"count": ZONAL_SQL["count"]}, final="""
select e.event_key, ri.item_date as date, cast(vc.band as double) as band,
       vc.value as hist_value, vc.n as hist_count
from f_events e join ri on ri.lat = e.latitude and ri.lon = e.longitude and ri.d = e.sample_date
join (select lat, lon, item_date, band, value, count(*) as n from hits
      where value is not null group by lat, lon, item_date, band, value) vc
  on vc.lat = ri.lat and vc.lon = ri.lon and vc.item_date = ri.item_date"""))
def q_zonal_freq_hist(spark, sf):
    zs = _zonal(spark, sf, ["freq_hist"])
    flat = unnest(zs.select("event_key", "zonal_statistics"), "zonal_statistics")
    return (flat.where(F.col("date").isNotNull())
            .select("event_key", "date", "band", F.explode("hist").alias("hist_value", "hist_count")))


BAND_NAMES = {1: "line one", 2: "line two", 3: "line three"}


@register("zonal_multiband_complete", _zonal_oracle(
    {"mean": ZONAL_SQL["mean"], "count": ZONAL_SQL["count"]}, bands=(1, 2, 3), band_names=BAND_NAMES))
def q_zonal_multiband_complete(spark, sf):
    """Three named bands, two stats; every band x stat present per event."""
    return _zonal_flat(_zonal(spark, sf, ["mean", "count"], bands=(1, 2, 3), band_names=BAND_NAMES))


ONCE_RADIUS_M = 1500000.0


@register("zonal_once", _zonal_oracle({"mean": ZONAL_SQL["mean"]}, window="once", radius=ONCE_RADIUS_M))
def q_zonal_once(spark, sf):
    """A single-edition covariate (the newest item) attached to every event."""
    cells = fx.f_cells(spark, sf)
    one = temporal.first_item(fx.sst_items(cells)).withColumn("covariate_id", F.lit(fx.SST_COVARIATE))
    return _zonal_flat(_zonal(spark, sf, ["mean"], cadence="once", items=one, radius=ONCE_RADIUS_M))


@register("zonal_periodic", _zonal_oracle({"mean": ZONAL_SQL["mean"], "max": ZONAL_SQL["max"]},
                                          window="periodic"))
def q_zonal_periodic(spark, sf):
    """As-of matching: the latest edition on or before each sample date."""
    return _zonal_flat(_zonal(spark, sf, ["mean", "max"], cadence="periodic"))


@register("zonal_nested_roundtrip", _zonal_oracle({"mean": ZONAL_SQL["mean"]}, bands=(1, 2), final="""
select event_key, count(*) as n_rows, count(date) as n_dated, max(date) as latest_date
from allrows group by event_key"""))
def q_zonal_nested_roundtrip(spark, sf):
    """Nest -> unnest -> nest again; sizes and the leading (newest) date survive.  The rows of a key with one event are
    nested where their event lies; events that share a key are gathered."""
    from covspark.operators.reshape import nest, with_group_count
    cells = fx.f_cells(spark, sf)
    ev = with_group_count(fx.f_events(spark, sf), ["event_key"], "_n")
    zs = zonal_statistics(ev, fx.sst_items(cells), cells, covariate_id=fx.SST_COVARIATE, cadence="daily", spatial_stats=["mean"],
                          radius=RADIUS_M, n_days=N_DAYS, bands=(1, 2), cell_deg=2 * CELL_HALF_DEG, place="_place")
    flat = unnest(zs.select("event_key", "_n", "_place", "zonal_statistics"), "zonal_statistics")
    again = nest(flat, ["event_key"], [F.col(c) for c in flat.columns if c not in ("event_key", "_n", "_place")],
                 "zonal_statistics", sort_key=[F.col("date").isNull(), -F.datediff("date", F.lit("1970-01-01")),
                                               F.col("band")], place="_place", whole=F.col("_n") == 1)
    arr = F.col("zonal_statistics")
    return again.select(
        "event_key", F.size(arr).cast("bigint").alias("n_rows"),
        F.size(F.filter(arr, lambda x: x["date"].isNotNull())).cast("bigint").alias("n_dated"),
        F.element_at(arr, 1)["date"].alias("latest_date"))


@register("cells_in_radius", with_fixtures(f"""
with req as (select distinct latitude as lat, longitude as lon, sample_date as d from f_events),
items as (select distinct item_date from f_cells),
li as (select distinct r.lat, r.lon, i.item_date from req r
       join items i on i.item_date between r.d - {N_DAYS - 1} and r.d)
select li.lat as latitude, li.lon as longitude, li.item_date, c.band, c.cx, c.cy,
       c.value, round({sq.cell_area('c.cy', 'c.half_deg')} / 1e6, 6) as area_km2
from li join f_cells c on c.item_date = li.item_date
where {sq.cell_distance('li.lat', 'li.lon', 'c.cy', 'c.cx', 'c.half_deg')} <= {RADIUS_M}""",
                                           "f_events", "f_cells"))
def q_cells_in_radius(spark, sf):
    """Cells touching the 250 km disc of every event location, for each
    edition in the location's 30-day windows (all bands)."""
    from covspark.operators.spatial import cells_in_radius
    ev = fx.f_events(spark, sf)
    cells = fx.f_cells(spark, sf)
    req = (ev.select("latitude", "longitude", "sample_date").distinct()
           .withColumn("covariate_id", F.lit(fx.SST_COVARIATE)))
    ri = temporal.lookback_items(req, fx.sst_items(cells), "sample_date", N_DAYS, keep_unmatched=False)
    li = ri.select("latitude", "longitude", "item_date", "covariate_id").distinct()
    hits = cells_in_radius(li, cells, RADIUS_M, cell_deg=2 * CELL_HALF_DEG)
    return hits.select("latitude", "longitude", "item_date", "band", "cx", "cy", "value",
                       F.round(F.col("cell_area_m2") / 1e6, 6).alias("area_km2"))


RELEVANT_DAYS = 10


@register("relevance_filter", _zonal_oracle({"mean": ZONAL_SQL["mean"]}, final=f"""
select a.event_key, a.covariate, a.date, a.band, a.spatial_stat, round(a.value, 6) as value
from allrows a join f_events e on e.event_key = a.event_key


where a.date is null or (a.date between e.sample_date - {RELEVANT_DAYS - 1} and e.sample_date)"""))
def q_relevance_filter(spark, sf):
    """Keep only nested rows inside each event's own (shorter) window."""
    zs = _zonal(spark, sf, ["mean"])
    kept = zs.withColumn("zonal_statistics", temporal.relevant_only(
        F.col("zonal_statistics"), F.col("sample_date"), RELEVANT_DAYS))
    return _zonal_flat(kept)



def _summary_oracle(stats: list[str], nulls: str = "reference", spatial=("mean",), bands=(1,)) -> str:
    def expr(s):
        if s == "mean":
            return "avg(value)"
        agg = {"min": "min(value)", "max": "max(value)", "sum": "sum(value)",
               "prod": "product(value)"}[s]
        if nulls == "reference":
            return f"case when count(*) = count(value) and count(value) > 0 then {agg} end"
        return f"case when count(value) > 0 then {agg} end"

    sels = "\n  union all ".join(
        f"""select event_key, covariate, min(date) filter (where value is not null) as start_date,
         max(date) filter (where value is not null) as end_date,
         count(distinct date) filter (where value is not null) as n_dates,
         band, spatial_stat, '{s}' as temporal_stat, round({expr(s)}, 6) as value
  from allrows group by event_key, covariate, band, spatial_stat"""
        for s in stats)
    return _zonal_oracle({k: ZONAL_SQL[k] for k in spatial}, bands=bands, final=sels)


def _summary(spark, sf, temporal_stats, nulls="reference", spatial=("mean",), bands=(1,)):
    from covspark.operators.summarise import summarise_zonal_statistics
    zs = _zonal(spark, sf, list(spatial), bands=bands)
    sm = summarise_zonal_statistics(zs.select("event_key", "zonal_statistics"), temporal_stats, nulls=nulls)
    flat = unnest(sm.select("event_key", "summary_zonal_statistics"), "summary_zonal_statistics")
    return flat.select(*[r6(c) if c == "value" else F.col(c) for c in flat.columns])


@register("summarise_temporal", _summary_oracle(["min", "max", "mean"]))
def q_summarise_temporal(spark, sf):
    """Flagship chain: 30-day daily zonal mean, then min / max / mean over time."""
    return _summary(spark, sf, ["min", "max", "mean"])


YEAR_DAYS = 365


@register("summarise_window_365", with_fixtures(f"""
with {_zonal_ctes({"mean": ZONAL_SQL["mean"], "nodata": ZONAL_SQL["nodata"]}, n_days=YEAR_DAYS)}
select event_key, covariate, min(date) filter (where value is not null) as start_date, max(date) filter (where value is not null) as end_date,
  count(distinct date) filter (where value is not null) as n_dates, band, spatial_stat, t.stat as temporal_stat,
  round(case t.stat when 'mean' then avg(value) when 'min' then case when count(*) = count(value) then min(value) end
    when 'max' then case when count(*) = count(value) then max(value) end else case when count(*) = count(value) then sum(value) end end, 6) as value
from allrows cross join (select unnest(['min', 'max', 'mean', 'sum']) as stat) t
group by event_key, covariate, band, spatial_stat, t.stat""", "f_events", "f_cells"))
def q_summarise_window_365(spark, sf):
    """A year's window of daily statistics, summarised over prefix and suffix frames of the flat table."""
    from covspark.plans.window_summary import summarise_windows
    cells = fx.f_cells(spark, sf)
    sm = summarise_windows(fx.f_events(spark, sf), fx.sst_items(cells), cells, covariate_id=fx.SST_COVARIATE, n_days=YEAR_DAYS,
                           temporal_stats=["min", "max", "mean", "sum"], spatial_stats=["mean", "nodata"], radius=RADIUS_M, cell_deg=2 * CELL_HALF_DEG)
    flat = unnest(sm.select("event_key", "summary_zonal_statistics"), "summary_zonal_statistics")
    return flat.select(*[r6(c) if c == "value" else F.col(c) for c in flat.columns])


ALL_STATS = ["min", "max", "mean", "count", "sum", "std", "median", "majority", "minority", "unique", "range", "nodata", "area"]
WIDE_RADIUS_M = 600000.0


@register("zonal_all_stats", _zonal_oracle({s: None for s in ALL_STATS}, radius=WIDE_RADIUS_M, n_days=5, st_sql=f"""
vc as (select lat, lon, item_date, band, value, count(*) as n from hits where value is not null group by all),
most as (select lat, lon, item_date, band, arg_max(value, n * 1000000.0 - value) as majority, arg_min(value, n * 1000000.0 + value) as minority from vc group by all),
st as (select lat, lon, item_date, band, {", ".join(f'{ZONAL_SQL[x]} as "{x}"' for x in ALL_STATS if x in ZONAL_SQL and x != "area")},
    round({ZONAL_SQL["area"]} / 1e6, 6) as area, any_value(majority) as majority, any_value(minority) as minority
  from hits left join most using (lat, lon, item_date, band) group by lat, lon, item_date, band)"""))
def q_zonal_all_stats(spark, sf):
    """All scalar statistics of a 600 km disc from one table of value counts (areas in km2)."""
    flat = _zonal_flat(_zonal(spark, sf, ALL_STATS, n_days=5, radius=WIDE_RADIUS_M))
    return flat.withColumn("value", F.round(F.when(F.col("spatial_stat") == "area", F.round(F.col("value") / 1e6, 6)).otherwise(F.col("value")), 6))


@register("zonal_same_day_editions", with_fixtures(f"""
with k as (select distinct latitude as lat, longitude as lon, sample_date as d from f_events),
e as (select c.*, 'sst_' || strftime(item_date, '%Y%m%d') || '_' || (cast(floor(c.cx) as bigint) % 3)::varchar as item_id, cast(floor(c.cx) as bigint) % 3 as part from f_cells c where band = 1),
f as (select k.lat, k.lon, k.d, e.item_id, e.item_date, avg(e.value) as value from k join e on e.part in (0, 1, -1) and e.item_date between k.d - 9 and k.d
  and {sq.cell_distance('k.lat', 'k.lon', 'e.cy', 'e.cx', 'e.half_deg')} <= {RADIUS_M} group by all)
select x.event_key, f.item_date as date, cast(count(*) as bigint) as n_editions, round(sum(f.value), 6) as total
from f_events x join f on f.lat = x.latitude and f.lon = x.longitude and f.d = x.sample_date group by all""", "f_events", "f_cells"))
def q_zonal_same_day_editions(spark, sf):
    """Several editions of one date: only cells of listed items count, and each edition has its own row."""
    part = F.floor("cx").cast("bigint") % 3
    cells = fx.f_cells(spark, sf).withColumn("item_id", F.concat(F.lit("sst_"), F.date_format("item_date", "yyyyMMdd"), F.lit("_"), part.cast("string")))
    items = cells.where(part.isin(0, 1, -1)).select("covariate_id", "item_date", "item_id").distinct()  # part 2 and -2 aren't listed
    zs = zonal_statistics(fx.f_events(spark, sf), items, cells, covariate_id=fx.SST_COVARIATE, cadence="daily", n_days=10, radius=RADIUS_M,
                          cell_deg=2 * CELL_HALF_DEG)
    flat = unnest(zs.select("event_key", "zonal_statistics"), "zonal_statistics").where("date is not null")
    return flat.groupBy("event_key", "date").agg(F.count("*").alias("n_editions"), F.round(F.sum("value"), 6).alias("total"))


@register("summarise_null_policy", _summary_oracle(["min", "max", "sum"], nulls="skip",
                                                   spatial=("mean", "nodata")))
def q_summarise_null_policy(spark, sf):
    """NULL-skipping variant over two spatial stats."""
    return _summary(spark, sf, ["min", "max", "sum"], nulls="skip", spatial=("mean", "nodata"))


@register("summarise_coverage", _summary_oracle(["mean", "prod"], bands=(1, 2)))
def q_summarise_coverage(spark, sf):
    """Coverage dates and counts across two bands, with product."""
    return _summary(spark, sf, ["mean", "prod"], bands=(1, 2))


@register("trivial_summary", _zonal_oracle({"mean": ZONAL_SQL["mean"]}, final="""
select (max(m) = 1) as trivial, max(m) as max_values_per_group, count(*) as n_rows from (
  select event_key, max(n) as m from (
    select event_key, band, spatial_stat, count(*) as n from allrows
    group by event_key, band, spatial_stat) g group by event_key) t"""))
def q_trivial_summary(spark, sf):
    from covspark.operators.summarise import is_trivial_summary
    zs = _zonal(spark, sf, ["mean"]).select("event_key", "zonal_statistics")
    return is_trivial_summary(zs)



@register("zonal_unmatched", _zonal_oracle({"mean": ZONAL_SQL["mean"]}, final="""
select e.event_key, e.site from f_events e
where not exists (select 1 from allrows a where a.event_key = e.event_key and a.date is not null)"""))
def q_zonal_unmatched(spark, sf):
    """Events whose 30-day window found no cell at all (anti check)."""
    zs = _zonal(spark, sf, ["mean"])
    dated = F.exists("zonal_statistics", lambda x: x["date"].isNotNull())
    return zs.where(~dated).select("event_key", "site")


PYRAMID_RADIUS_M = 4000000.0
PYRAMID_STATS = ["min", "max", "mean", "count", "sum", "std", "range", "nodata", "area"]


@register("zonal_pyramid", with_fixtures(f"""
with li as (select distinct latitude, longitude, sample_date as item_date from f_events)
select li.latitude, li.longitude, li.item_date, c.band, {", ".join(f'round({ZONAL_SQL[s]}, 6) as "{s}"' for s in PYRAMID_STATS if s != "area")},
  round(coalesce(sum(case when value is not null then {sq.cell_area('c.cy', 'c.half_deg')} end), 0) / 1e6, 4) as area
from li join f_cells c on c.item_date = li.item_date
where {sq.cell_distance('li.latitude', 'li.longitude', 'c.cy', 'c.cx', 'c.half_deg')} <= {PYRAMID_RADIUS_M}
group by all""", "f_events", "f_cells"))
def q_zonal_pyramid(spark, sf):
    """Statistics of 4,000 km discs on the sample date: inner tiles from the pyramid, cells on the rim only."""
    from covspark.operators.pyramid import build_pyramid, zonal_from_pyramid
    cells = fx.f_cells(spark, sf)
    li = (fx.f_events(spark, sf).select("latitude", "longitude", F.col("sample_date").alias("item_date")).distinct()
          .withColumn("covariate_id", F.lit(fx.SST_COVARIATE)))
    out = zonal_from_pyramid(li, build_pyramid(cells), cells, PYRAMID_RADIUS_M, PYRAMID_STATS, cell_deg=2 * CELL_HALF_DEG)
    return out.select("latitude", "longitude", "item_date", "band", *[r6(s) for s in PYRAMID_STATS if s != "area"],
                      F.round(F.col("area") / 1e6, 4).alias("area"))


SKETCH_DAYS = 60
SKETCH_RADIUS_M = 1500000.0
# Slots of a window's length in an era, by which the windows are dealt.
ERA_SLOTS = 4


@register("zonal_window_quantiles", with_fixtures(f"""
with r as (select distinct latitude, longitude, sample_date from f_events)
select r.latitude, r.longitude, r.sample_date, c.band, count(c.value) as n, true as median_in_bound, true as unique_in_bound
from r join f_cells c on c.item_date between r.sample_date - {SKETCH_DAYS - 1} and r.sample_date and c.value is not null
where {sq.cell_distance('r.latitude', 'r.longitude', 'c.cy', 'c.cx', 'c.half_deg')} <= {SKETCH_RADIUS_M} group by all""", "f_events", "f_cells"))
def q_zonal_window_quantiles(spark, sf):
    """Approximate median and distinct count of a 60-day window from daily sketches, checked against the exact ranks:
    whether each lies within its error bound."""
    from covspark.operators.sketches import RANK_ERROR, daily_sketches, slot_of, window_quantiles
    from covspark.operators.spatial import cells_in_radius, deal_regions
    cells = fx.f_cells(spark, sf)
    req = fx.f_events(spark, sf).select("latitude", "longitude", "sample_date").distinct()
    place = ["latitude", "longitude"]
    # a window ends in an era and may begin in the last slot of the one before
    era, slot = F.floor(slot_of("sample_date", SKETCH_DAYS) / ERA_SLOTS), slot_of("item_date", SKETCH_DAYS)
    eras = F.array_distinct(F.array(F.floor(slot / ERA_SLOTS), F.floor((slot + 1) / ERA_SLOTS)))
    asked, near, by = deal_regions(req.where("sample_date is not null and latitude is not null and longitude is not null"), cells,
                                   SKETCH_RADIUS_M, 2 * CELL_HALF_DEG, era, eras)
    isl = temporal.window_islands(asked, SKETCH_DAYS, "sample_date", [*by, *place])
    wanted = isl.select(*by, *place, F.date_sub("start_date", SKETCH_DAYS - 1).alias("_lo"), F.col("end_date").alias("_hi"), F.lit(fx.SST_COVARIATE).alias("covariate_id"))
    hits = cells_in_radius(wanted, near, SKETCH_RADIUS_M, keys=(*by, "covariate_id"), cell_deg=2 * CELL_HALF_DEG, repeat_points=True)
    dealt = ["_at", "_era"]
    daily = daily_sketches(hits.where("item_date between _lo and _hi"), [*dealt, *place, "item_date", "band"], with_values=True)
    both = window_quantiles(asked.select(*dealt, *place, "sample_date"), daily, "sample_date", SKETCH_DAYS, place, dealt=dealt, keep=["values"])
    both = both.withColumn("_v", F.sort_array(F.flatten(F.transform("_days", lambda x: x["values"]))))
    n, exact = F.size("_v"), F.size(F.array_distinct("_v"))
    # the median is one of the values: its first and last place in their order tell how many are below and above
    first, last = F.array_position("_v", F.col("q50")), F.array_position(F.reverse("_v"), F.col("q50"))
    return both.select(
        *place, "sample_date", "band", n.cast("long").alias("n"),
        ((first > 0) & ((first - 1) / n <= 0.5 + RANK_ERROR) & ((n - last + 1) / n >= 0.5 - RANK_ERROR)).alias("median_in_bound"),
        (F.abs(exact - F.col("unique")) <= F.greatest(F.lit(1.0), 0.02 * exact)).alias("unique_in_bound"))


@register("zonal_from_store", _zonal_oracle({"mean": ZONAL_SQL["mean"], "count": ZONAL_SQL["count"]}))
def q_zonal_from_store(spark, sf):
    """The daily job over cells written in Z-order and read back by the stretches of the curve that the events touch."""
    from covspark.session import ensure_checkpoint_dir
    from covspark.sources.catalog import read_curve_store, write_curve_store
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cells-{uuid.uuid4().hex}"
    cells = fx.f_cells(spark, sf)
    write_curve_store(cells, path)
    ev = fx.f_events(spark, sf)
    stored = read_curve_store(spark, path, ev.select("latitude", "longitude").distinct(), RADIUS_M, 2 * CELL_HALF_DEG)
    return _zonal_flat(zonal_statistics(ev, fx.sst_items(stored), stored, covariate_id=fx.SST_COVARIATE, cadence="daily", n_days=N_DAYS,
                                        spatial_stats=["mean", "count"], radius=RADIUS_M, cell_deg=2 * CELL_HALF_DEG))
