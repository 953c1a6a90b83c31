"""The catalogue-driven public job end to end: resolve covariates by title
or id, validate dataset and bands, infer the cadence from the item count,
and compute several requests in one run (enrich)."""

from __future__ import annotations

from pyspark.sql import functions as F

from covspark.operators.reshape import unnest
from covspark.queries.common import CELL_HALF_DEG, RADIUS_M, r6, register
from covspark.queries.zonal import ZONAL_SQL, _zonal_oracle
from covspark.sources import fixtures as fx

SST_TITLE = "Sea surface temperature"
SST_BANDS = {b: f"line {b}" for b in range(1, 8)}
REQUESTS = [
    {"name": "mean30", "covariate": SST_TITLE, "n_days": 30, "bands": [1], "spatial_stats": ["mean"]},
    {"name": "max10", "covariate": "sst", "n_days": 10, "bands": ["line 2"], "spatial_stats": ["max"]},
]


def _catalog(spark, cells):
    """The raster covariate's catalogue entry: one collection row and one
    asset with its seven named bands; the items are the dates of its cells."""
    import covspark
    coll = spark.createDataFrame([(fx.SST_COVARIATE, SST_TITLE)], "id string, title string")
    assets = spark.createDataFrame(
        [(fx.SST_COVARIATE, "data", "image/tiff; application=geotiff", "sst.tif",
          [{"name": n} for n in SST_BANDS.values()])],
        "covariate_id string, dataset string, mime string, href string, bands array<struct<name:string>>")
    return covspark.Catalog(coll, fx.sst_items(cells), assets)


def _oracle() -> str:
    parts = []
    for r, band, stat in (("mean30", 1, "mean"), ("max10", 2, "max")):
        n_days = 30 if r == "mean30" else 10
        final = (f"select event_key, '{r}' as request, covariate, date, band, "
                 f"case band when {float(band)} then '{SST_BANDS[band]}' end as band_name, "
                 f"spatial_stat, round(value, 6) as value from allrows")
        parts.append(_zonal_oracle({stat: ZONAL_SQL[stat]}, bands=(band,), n_days=n_days,
                                   final=final, label=SST_TITLE))
    return "select * from (" + ") union all select * from (".join(parts) + ")"


@register("enrich_catalogue", _oracle())
def q_enrich_catalogue(spark, sf):
    """Two requests for the daily raster covariate, named by title and by id,
    with bands chosen by number and by name, in one enrich run."""
    import covspark
    cells = fx.f_cells(spark, sf)
    reqs = [dict(r, radius=RADIUS_M, cell_deg=2 * CELL_HALF_DEG) for r in REQUESTS]
    out = covspark.enrich(fx.f_events(spark, sf), _catalog(spark, cells), cells, reqs)
    both = F.array(*[F.struct(F.lit(r["name"]).alias("request"), F.col(f"zonal_statistics_{r['name']}").alias("rows")) for r in REQUESTS])
    flat = unnest(out.select("event_key", F.inline(both)), "rows", outer=False)
    return flat.select("event_key", "request", "covariate", "date", "band", "band_name", "spatial_stat", r6("value"))


# -- three cadences from the catalogue's own tables -----------------------------

# The requests, over f_collections, f_items and f_assets: a covariate with one edition, one with some and a daily one.
PERIODIC_ID = "cov_p3"
CADENCE_REQUESTS = [
    {"name": "depth", "covariate": "Depth", "radius": 1000000.0, "spatial_stats": ["max", "count"]},
    {"name": "part", "covariate": PERIODIC_ID, "dataset": "data", "bands": [1], "radius": 400000.0, "spatial_stats": ["mean"]},
    {"name": "sst30", "covariate": SST_TITLE, "n_days": 30, "bands": [1, "line 2"], "radius": RADIUS_M, "spatial_stats": ["mean"]},
    {"name": "sst10", "covariate": "sst", "n_days": 10, "bands": ["2"], "radius": RADIUS_M, "spatial_stats": ["max"]},
]


def f_catalog(spark, sf):
    """The catalogue of f_collections, f_items and f_assets with the raster covariate and a single edition of it
    ("depth"), and the cells of all: the periodic covariate has the raster's cells of its own editions' dates."""
    import covspark
    cells = fx.f_cells(spark, sf)
    sst = fx.sst_items(cells)
    newest = sst.agg(F.max("item_date").alias("item_date")).withColumn("covariate_id", F.lit("depth"))
    extra = fx.table(spark, sf, "region").where("r_regionkey < 2").select(
        F.when(F.col("r_regionkey") == 0, F.lit(fx.SST_COVARIATE)).otherwise("depth").alias("id"),
        F.when(F.col("r_regionkey") == 0, F.lit(SST_TITLE)).otherwise("Depth").alias("title"))
    coll = fx.f_collections(spark, sf).select("id", "title").unionByName(extra)
    items = (fx.f_items(spark, sf).select("covariate_id", "item_date", "item_id").unionByName(sst.select("covariate_id", "item_date", "item_id"))
             .unionByName(newest.select("covariate_id", "item_date", F.lit("depth_0").alias("item_id"))))
    names = F.when(F.col("id") == "sst", F.array(*[F.struct(F.lit(n).alias("name")) for n in SST_BANDS.values()]))
    assets = fx.f_assets(spark, sf).select("covariate_id", "dataset", "mime", "href", "bands").unionByName(extra.select(
        F.col("id").alias("covariate_id"), F.lit("data").alias("dataset"), F.lit("image/tiff; application=geotiff").alias("mime"),
        F.concat("id", F.lit(".tif")).alias("href"), names.alias("bands")))
    own = fx.f_items(spark, sf).where(F.col("covariate_id") == PERIODIC_ID).select("item_date")
    part = cells.join(own, "item_date", "left_semi").withColumn("covariate_id", F.lit(PERIODIC_ID))
    depth = cells.join(newest.select("item_date"), "item_date", "left_semi").withColumn("covariate_id", F.lit("depth")).where("band = 1")
    return covspark.Catalog(coll, items, assets), cells.unionByName(part.select(*cells.columns)).unionByName(depth.select(*cells.columns))


def _three_oracle() -> str:
    from covspark.functions import sqltext as sq
    near = lambda radius: f"{sq.cell_distance('k.lat', 'k.lon', 'c.cy', 'c.cx', 'c.half_deg')} <= {radius}"
    part = f"(select distinct item_date from f_items where covariate_id = '{PERIODIC_ID}')"
    daily = lambda name, days, bands, agg, stat: f"""
select k.lat, k.lon, k.d, '{name}' as request, '{SST_TITLE}' as covariate, c.item_date as date, c.band,
  case c.band when 1 then 'line 1' when 2 then 'line 2' end as band_name, '{stat}' as spatial_stat, {agg}(c.value) as value
from k join f_cells c on c.item_date between k.d - {days - 1} and k.d and c.band in ({bands}) and {near(RADIUS_M)}
group by all"""  # noqa: E731
    found = " union all ".join([
        *[f"""select k.lat, k.lon, k.d, 'depth' as request, 'Depth' as covariate, c.item_date as date, c.band, cast(null as varchar) as band_name,
  '{stat}' as spatial_stat, {stat}(c.value) as value
from k join f_cells c on c.item_date = (select max(item_date) from f_cells) and c.band = 1 and {near(1000000.0)}
group by all""" for stat in ("max", "count")],
        f"""select k.lat, k.lon, k.d, 'part', (select min(title) from f_collections where id = '{PERIODIC_ID}'), c.item_date, c.band,
  (select case when n_bands > 1 and named then 'data_b1' end from f_assets where covariate_id = '{PERIODIC_ID}' and dataset = 'data'), 'mean', avg(c.value)
from (select * from k asof join {part} i on k.d >= i.item_date) k join f_cells c on c.item_date = k.item_date and c.band = 1 and {near(400000.0)}
group by all""",
        daily("sst30", 30, "1, 2", "avg", "mean"), daily("sst10", 10, "2", "max", "max")])
    wanted = " union all ".join(f"select '{n}' as request, {b} as band, '{s}' as spatial_stat" for n, b, s in (
        ("depth", 1, "max"), ("depth", 1, "count"), ("part", 1, "mean"), ("sst30", 1, "mean"), ("sst30", 2, "mean"), ("sst10", 2, "max")))
    return fx.with_fixtures(f"""
with k as (select distinct latitude as lat, longitude as lon, sample_date as d from f_events),
found as ({found}),
wanted as ({wanted})
select e.event_key, w.request, f.date, cast(w.band as double) as band, f.band_name, w.spatial_stat, round(cast(f.value as double), 6) as value
from f_events e cross join wanted w left join found f on f.lat = e.latitude and f.lon = e.longitude and f.d = e.sample_date
  and f.request = w.request and f.band = w.band and f.spatial_stat = w.spatial_stat""", "f_events", "f_cells", "f_items", "f_collections", "f_assets")


@register("enrich_cadences", _three_oracle())
def q_enrich_cadences(spark, sf):
    """Four requests for a single-edition, a periodic and a daily covariate of the catalogue, resolved, checked and
    computed as one table: one row per event and request, unnested.  Undated rows carry no band label here."""
    import covspark
    catalog, cells = f_catalog(spark, sf)
    out = covspark.enrich(fx.f_events(spark, sf), catalog, cells, [dict(r, cell_deg=2 * CELL_HALF_DEG) for r in CADENCE_REQUESTS], long=True)
    flat = unnest(out.select("event_key", "request", "zonal_statistics"), "zonal_statistics", outer=False)
    return flat.select("event_key", "request", "date", "band", F.when(F.col("date").isNotNull(), F.col("band_name")).alias("band_name"),
                       "spatial_stat", r6("value"))


def _request_grid(spark, sf):
    """A request per part, right and wrong by turns: by id, by title or unknown, with or without dataset, bands, days."""
    p = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("z"))
    title = fx.f_collections(spark, sf).select(F.col("id").alias("tid"), "title")
    p = p.withColumn("tid", F.concat(F.lit("cov_p"), F.col("k"))).join(title, "tid")
    one = lambda c: F.array(c)
    return p.select(
        F.concat(F.lit("r"), F.col("k")).alias("request"),
        F.when(F.col("k") % 5 == 1, F.col("title")).when(F.col("k") % 17 == 0, F.lit("nowhere")).otherwise(F.col("tid")).alias("covariate"),
        F.when(F.col("z") % 3 == 1, "data").when(F.col("z") % 3 == 2, "cog").alias("dataset"),
        F.when(F.col("k") % 4 == 1, one(F.lit("1"))).when(F.col("k") % 4 == 2, one(F.lit("data_b2"))).when(F.col("k") % 4 == 3, F.array(F.lit("2"), F.lit("9"))).alias("bands"),
        F.lit(100.0).alias("radius"), F.lit(None).cast("int").alias("n_days"),
        F.when(F.col("k") % 11 == 0, F.array(F.lit("mean"), F.lit("mode"))).otherwise(F.array(F.lit("mean"))).alias("spatial_stats"),
        F.when(F.col("k") % 13 == 0, "daily").alias("cadence"), F.lit(1.0).alias("cell_deg"))


@register("validate_requests", fx.with_fixtures("""
with r as (select concat('r', c.p_partkey) as request, c.id as tid, c.p_partkey as k, c.p_size as z,
    case when c.p_partkey % 5 = 1 then c.title when c.p_partkey % 17 = 0 then 'nowhere' else c.id end as covariate,
    case c.p_size % 3 when 1 then 'data' when 2 then 'cog' end as asked from f_collections c),
t as (select title, min(id) as id, count(distinct id) as n from f_collections group by title),
s as (select r.*, coalesce(c.id, case when t.n = 1 then t.id end) as cid, t.n as n_titles
      from r left join f_collections c on c.id = r.covariate left join t on t.title = r.covariate),
n as (select covariate_id, count(*) as n from f_items group by 1),
a as (select covariate_id as cid, dataset, greatest(n_bands, 1) as nb, n_bands, named from f_assets where dataset in ('data', 'cog')),
g as (select cid, list_sort(list(dataset)) as sets from a group by cid),
d as (select s.*, g.sets, case when asked is not null then (case when list_contains(g.sets, asked) then asked end) when len(g.sets) = 1 then g.sets[1] end as ds
      from s left join g using (cid) where s.cid is not null),
b as (select d.*, a.nb, a.named and a.n_bands > 0 as named from d left join a on a.cid = d.cid and a.dataset = d.ds),
q as (select b.*, unnest(case k % 4 when 1 then ['1'] when 2 then ['data_b2'] when 3 then ['2', '9'] else [] end) as want from b where nb is not null),
m as (select *, case when want in ('1', '2', '9') then cast(want as integer) <= nb
                else named and ds = 'data' and 2 <= nb end as there from q)
select request, 'unknown covariate' as kind, covariate as detail from s where cid is null and n_titles is null
union all select request, 'title of several covariates', covariate from s where cid is null and n_titles > 1
union all select request, 'unknown statistic', 'mode' from r where k % 11 = 0
union all select s.request, 'no items', s.cid from s left join n on n.covariate_id = s.cid where s.cid is not null and n.n is null
union all select s.request, 'cadence left open by the item count', cast(n.n as varchar) from s join n on n.covariate_id = s.cid
  where s.k % 13 <> 0 and n.n between 50 and 300
union all select s.request, 'n_days needed', s.cid from s left join n on n.covariate_id = s.cid where s.cid is not null and (s.k % 13 = 0 or n.n > 300)
union all select request, 'no raster dataset', cid from d where sets is null
union all select request, 'unknown dataset', asked from d where sets is not null and asked is not null and ds is null
union all select request, 'dataset to be named', array_to_string(sets, ', ') from d where asked is null and len(sets) > 1
union all select request, 'bands to be listed', cast(nb as varchar) from b where nb > 1 and k % 4 = 0
union all select request, 'unknown band', want from m where not there""", "f_collections", "f_items", "f_assets"))
def q_validate_requests(spark, sf):
    """Every fault of a table of requests, in one job over the catalogue."""
    import covspark
    catalog = covspark.Catalog(fx.f_collections(spark, sf).select("id", "title"), fx.f_items(spark, sf), fx.f_assets(spark, sf))
    return covspark.validate_requests(catalog, _request_grid(spark, sf))
