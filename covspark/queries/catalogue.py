"""Catalogue listing, search, resolution, assets, bands and capabilities."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from covspark.sources import fixtures as fx
from covspark.sources.fixtures import with_fixtures
from covspark.queries.common import register

def _cat():
    from covspark.operators import catalog
    return catalog


COLL_SQL = """coll as (select id, title, description,
    date '1992-01-01' + cast(p_partkey % 365 as integer) as start_date,
    case when p_size % 4 <> 0 then date '1992-01-01' + cast(p_partkey % 365 + p_size * 10 as integer) end as end_date,
    ['CC-BY-4.0', 'CC0-1.0', 'proprietary'][p_size % 3 + 1] as license,
    concat('10.5555/part.', p_partkey) as "sci:doi",
    concat(p_name, ', ', p_brand) as "sci:citation",
    case when p_size % 11 <> 0 then array_to_string(list_sort([p_type, p_brand]), ', ') end as keywords,
    case when p_size % 13 <> 0 then array_to_string(list_sort(
      case when p_size % 2 = 0 then [p_brand || ' (producer)', p_brand || ' (licensor)']
           else [p_brand || ' (producer)'] end
      || ['Host ' || (p_partkey % 4) || ' (host)', 'Host ' || (p_partkey % 4) || ' (processor)']), ', ') end as providers
  from f_collections)"""


@register("list_covariates", with_fixtures(f"""
with {COLL_SQL}
select id, title, description, start_date, end_date, license, "sci:doi", keywords, "sci:citation",
       providers, cast(start_date as varchar) || ' - ' || coalesce(cast(end_date as varchar), '') as dates
from coll""", "f_collections"))
def q_list_covariates(spark, sf):
    """Catalogue listing with keywords, provider and date-range labels."""
    c = _cat()
    coll = fx.f_collections(spark, sf)
    lst = c.list_covariates(coll)
    lab = coll.select("id", c.provider_label(F.col("providers")).alias("providers"))
    return (lst.drop("providers", "bbox").join(lab, on="id")
            .withColumn("dates", c.date_range_label(F.col("start_date"), F.col("end_date"))))


SEARCH_TITLE = "^gpw|bolt"
SEARCH_DESC = r"promo|brand#1\d"


@register("search_title", with_fixtures(f"""
select id, title from f_collections where regexp_matches(title, '{SEARCH_TITLE}', 'i')""", "f_collections"))
def q_search_title(spark, sf):
    c = _cat()
    return c.search_covariates(c.list_covariates(fx.f_collections(spark, sf)), title=SEARCH_TITLE) \
        .select("id", "title")


@register("search_title_and_description", with_fixtures(f"""
select id, title, description from f_collections
where regexp_matches(title, 'blue|red', 'i') and regexp_matches(description, '{SEARCH_DESC}', 'i')""",
                                                        "f_collections"))
def q_search_title_and_description(spark, sf):
    c = _cat()
    return c.search_covariates(c.list_covariates(fx.f_collections(spark, sf)), title="blue|red",
                               description=SEARCH_DESC).select("id", "title", "description")


@register("keywords_text", with_fixtures(f"with {COLL_SQL} select id, keywords from coll", "f_collections"))
def q_keywords_text(spark, sf):
    c = _cat()
    return fx.f_collections(spark, sf).select("id", c.keywords_text(F.col("keywords")).alias("keywords"))


@register("provider_roles", with_fixtures("""
select id, null as provider, null as role from f_collections where p_size % 13 = 0
union all select id, p_brand, 'producer' from f_collections where p_size % 13 <> 0
union all select id, p_brand, 'licensor' from f_collections where p_size % 13 <> 0 and p_size % 2 = 0
union all select id, 'Host ' || (p_partkey % 4), 'host' from f_collections where p_size % 13 <> 0
union all select id, 'Host ' || (p_partkey % 4), 'processor' from f_collections where p_size % 13 <> 0""",
                                          "f_collections"))
def q_provider_roles(spark, sf):
    return _cat().providers_table(fx.f_collections(spark, sf))


IS_COG_SQL = ("(coalesce(contains(mime, 'profile=cloud-optimized') or contains(mime, 'image/tiff') "
              "or contains(mime, 'application/geotiff'), false) "
              "or lower(href) like '%.tif' or lower(href) like '%.tiff')")
IS_PQ_SQL = "(coalesce(contains(mime, 'parquet'), false) or lower(href) like '%.parquet')"
ASSETS_SQL = f"""a as (select *, {IS_COG_SQL} as is_cog, {IS_PQ_SQL} as is_pq,
    case when {IS_COG_SQL} then 'cog' when {IS_PQ_SQL} then 'parquet' end as asset_type from f_assets)"""
PREF_SQL = """k as (select covariate_id, dataset, 'cog' as kind from a where is_cog
    union all select covariate_id, dataset, 'parquet' from a where is_pq),
kc as (select *, case when kind = 'cog' then dataset in ('data', 'Cloud Optimized GeoTIFF', 'cog', 'image')
                      else dataset in ('data', 'parquet', 'geoparquet', 'vector') end as common from k),
pref as (select covariate_id, kind, dataset from kc
    where common or not exists (select 1 from kc k2 where k2.covariate_id = kc.covariate_id
                                and k2.kind = kc.kind and k2.common))"""
BANDS_SQL = """bands as (
  select covariate_id, dataset, asset_type, cast(i as integer) as band, case when named then dataset || '_b' || i end as name
  from (select *, unnest(generate_series(1, n_bands)) as i from a where asset_type = 'cog' and n_bands > 0) x
  union all select covariate_id, dataset, asset_type, null, dataset || '_c' || i
  from (select *, unnest(generate_series(1, n_cols)) as i from a where asset_type = 'parquet' and n_cols > 0) y
  union all select covariate_id, dataset, asset_type, 1, null from a
  where asset_type = 'cog' and n_bands = 0 or asset_type = 'parquet' and n_cols = 0)"""


@register("asset_types", with_fixtures(f"with {ASSETS_SQL} select covariate_id, dataset, asset_type from a",
                                       "f_assets"))
def q_asset_types(spark, sf):
    return _cat().with_asset_type(fx.f_assets(spark, sf)).select("covariate_id", "dataset", "asset_type")


@register("preferred_datasets", with_fixtures(f"with {ASSETS_SQL}, {PREF_SQL} select * from pref", "f_assets"))
def q_preferred_datasets(spark, sf):
    return _cat().preferred_datasets(fx.f_assets(spark, sf))


@register("covariate_types", with_fixtures(f"""
with {ASSETS_SQL}
select covariate_id, case when bool_or(is_cog) and bool_or(is_pq) then 'raster + vector'
  when bool_or(is_cog) then 'raster' when bool_or(is_pq) then 'vector' else 'unknown' end as type
from a group by covariate_id""", "f_assets"))
def q_covariate_types(spark, sf):
    return _cat().covariate_types(fx.f_assets(spark, sf))


@register("dataset_bands", with_fixtures(f"with {ASSETS_SQL}, {BANDS_SQL} select * from bands", "f_assets"))
def q_dataset_bands(spark, sf):
    return _cat().dataset_bands(fx.f_assets(spark, sf))


@register("capabilities", with_fixtures(f"""
with {ASSETS_SQL}, {PREF_SQL}, {BANDS_SQL},
types as (select covariate_id, case when bool_or(is_cog) and bool_or(is_pq) then 'raster + vector'
  when bool_or(is_cog) then 'raster' when bool_or(is_pq) then 'vector' else 'unknown' end as type
  from a group by covariate_id),
nb as (select covariate_id, dataset, count(*) as nb from bands where asset_type = 'cog' group by all),
rast as (select p.covariate_id, count(*) as n, bool_or(nb.nb > 1) as band_required,
                string_agg(p.dataset, ', ' order by p.dataset) as ds
         from pref p left join nb on nb.covariate_id = p.covariate_id and nb.dataset = p.dataset
         where p.kind = 'cog' group by p.covariate_id),
vect as (select covariate_id, count(*) as n, string_agg(dataset, ', ' order by dataset) as ds
         from pref where kind = 'parquet' group by covariate_id)
select t.covariate_id, t.type,
  case t.type when 'raster' then 'zonal_statistics' when 'vector' then 'attach_covariate_data'
    when 'raster + vector' then 'zonal_statistics or attach_covariate_data, depending on the dataset' end as function,
  coalesce(r.n, 0) as n_raster_datasets, coalesce(v.n, 0) as n_vector_datasets,
  coalesce(r.n, 0) > 1 or coalesce(v.n, 0) > 1 as dataset_required,
  coalesce(r.n, 0) > 1 as raster_dataset_required, coalesce(v.n, 0) > 1 as vector_dataset_required,
  coalesce(r.band_required, false) as band_required, r.ds as raster_datasets, v.ds as vector_datasets,
  coalesce((select string_agg(b.dataset || ':' || b.band || coalesce('=' || b.name, ''), ', ' order by b.dataset || ':' || b.band || coalesce('=' || b.name, ''))
    from bands b join pref p using (covariate_id, dataset) where p.kind = 'cog' and b.asset_type = 'cog' and b.covariate_id = t.covariate_id), '') as band_options,
  coalesce((select string_agg(b.dataset || ':' || b.name, ', ' order by b.dataset || ':' || b.name)
    from bands b join pref p using (covariate_id, dataset) where p.kind = 'parquet' and b.asset_type = 'parquet' and b.name is not null
    and b.covariate_id = t.covariate_id), '') as column_options
from types t left join rast r on r.covariate_id = t.covariate_id left join vect v on v.covariate_id = t.covariate_id""",
                                        "f_assets"))
def q_capabilities(spark, sf):
    return _cat().capabilities(fx.f_assets(spark, sf))


@register("resolve_name_or_id", with_fixtures("""
with req as (select id as covariate from f_collections union select title from f_collections
             union select p_name from f_collections),
t as (select title, count(distinct id) as n, min(id) as mid from f_collections group by title)
select r.covariate,
  case when c.id is not null then c.id when t.n = 1 then t.mid end as covariate_id,
  case when c.id is not null then c.title when t.n = 1 then r.covariate end as title,
  case when c.id is not null then 'id' when t.n = 1 then 'title' when t.n > 1 then 'ambiguous' else 'none' end as match
from req r left join f_collections c on c.id = r.covariate left join t on t.title = r.covariate""",


                                              "f_collections"))
def q_resolve_name_or_id(spark, sf):
    """Resolve ids, titles (some shared by several covariates) and unknown names."""
    coll = fx.f_collections(spark, sf)
    p = fx.table(spark, sf, "part")
    req = (coll.select(F.col("id").alias("covariate"))
           .union(coll.select("title")).union(p.select("p_name")).distinct())
    return _cat().resolve(req, coll).select("covariate", "covariate_id", "title", "match")


REQUESTED_BANDS = ["1", "data_b2", "cog_b3", "3"]
# by number and by name: matched in full, matched twice on one band, or not at all
REQUESTED_PAIR = ["2", "data_b1"]


def _select_bands_sql(requested: list[str]) -> str:
    return with_fixtures(f"""
with {ASSETS_SQL}, {BANDS_SQL},
req as (select unnest({requested!r}) as requested),
m as (select b.*, r.requested from bands b join req r
      on cast(b.band as varchar) = r.requested or b.name = r.requested where b.asset_type = 'cog'),
c as (select covariate_id, dataset, count(distinct requested) as k, count(distinct band) as kb from m group by all)
select m.*, c.k = {len(requested)} and c.kb = {len(requested)} as all_matched from m join c using (covariate_id, dataset)""", "f_assets")


@register("select_band_pair", _select_bands_sql(REQUESTED_PAIR))
def q_select_band_pair(spark, sf):
    """A request that some datasets match in full."""
    c = _cat()
    bands = c.dataset_bands(fx.f_assets(spark, sf)).where(F.col("asset_type") == "cog")
    return c.select_bands(bands, REQUESTED_PAIR)


@register("select_bands", _select_bands_sql(REQUESTED_BANDS))
def q_select_bands(spark, sf):
    """Band selection by number or name, mixed, over every raster dataset."""
    c = _cat()
    bands = c.dataset_bands(fx.f_assets(spark, sf)).where(F.col("asset_type") == "cog")
    return c.select_bands(bands, REQUESTED_BANDS)


@register("catalogue_order", with_fixtures("""
select id, title, row_number() over (order by title like 'GPW%', title, id) as position from f_collections""", "f_collections"))
def q_catalogue_order(spark, sf):
    """The catalogue's order as a column: GPW titles last, then by title."""
    return _cat().catalogue_positions(fx.f_collections(spark, sf)).withColumn("position", F.col("position").cast("bigint"))


def _documents(spark, docs, name):
    """``docs`` as JSON documents, one per line, packed, in the shared folder; the folder."""
    from covspark.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stac-{uuid.uuid4().hex}/{name}"
    docs.write.option("compression", "gzip").json(path)
    return path


def _json_collections(spark, sf):
    """f_collections as STAC documents."""
    coll = fx.f_collections(spark, sf)
    docs = coll.groupBy(F.pmod(F.xxhash64("id"), F.lit(16))).agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in coll.columns])).alias("collections"))
    return _documents(spark, docs.select("collections"), "collections")


def _json_items(spark, sf):
    """f_items with f_assets as STAC documents, one per covariate; of every third item only the end date is known.  Dates are
    gathered alone, and a covariate's assets meet them once: the items with their assets are made where they are written."""
    assets = fx.f_assets(spark, sf).groupBy("covariate_id").agg(F.map_from_entries(F.collect_list(F.struct("dataset", F.struct(
        "href", F.col("mime").alias("type"), F.col("bands").alias("raster:bands"), F.col("columns").alias("table:columns"))))).alias("assets"))
    listed = fx.f_items(spark, sf).join(assets.select("covariate_id"), "covariate_id", "left_semi")  # before their distinct
    dates = listed.groupBy("covariate_id").agg(F.collect_list(F.struct("item_date", "item_id")).alias("_items"))

    def item(x):
        date = F.date_format(x["item_date"], "yyyy-MM-dd'T'HH:mm:ss'Z'")
        known = F.dayofmonth(x["item_date"]) % 3 != 0
        return F.struct(x["item_id"].alias("id"), F.col("covariate_id").alias("collection"), F.struct(
            F.when(known, date).alias("datetime"), F.when(~known, date).alias("end_datetime")).alias("properties"), F.col("assets").alias("assets"))

    return _documents(spark, dates.join(assets, "covariate_id").select(F.transform("_items", item).alias("features")), "items")


@register("json_items", with_fixtures("""
select i.covariate_id, i.item_id, i.item_date, extract(day from i.item_date) % 3 <> 0 as has_datetime, count(a.dataset) as n_assets,
  count(a.mime) as n_typed, sum(case when a.n_bands > 0 then a.n_bands else 0 end)::bigint as n_bands
from f_items i join f_assets a using (covariate_id) group by all""", "f_items", "f_assets"))
def q_json_items(spark, sf):
    """Items and their assets from JSON documents: item dates (datetime, else end_datetime) and a row per asset."""
    from covspark.sources.catalog import explode_assets, read_items
    items = read_items(spark, _json_items(spark, sf), lines=True)
    assets = explode_assets(items).groupBy("covariate_id", "item_id").agg(
        F.count("*").alias("n_assets"), F.count("mime").alias("n_typed"), F.sum(F.coalesce(F.size("bands"), F.lit(0))).alias("n_bands"))
    return items.select("covariate_id", "item_id", "item_date", F.col("datetime").isNotNull().alias("has_datetime")).join(assets, ["covariate_id", "item_id"])


@register("json_collections", with_fixtures(f"with {COLL_SQL} select id, title, start_date, end_date, license, keywords from coll", "f_collections"))
def q_json_collections(spark, sf):
    """The listing of collections read from JSON documents."""
    from covspark.sources.catalog import read_collections
    listed = _cat().list_covariates(read_collections(spark, _json_collections(spark, sf), lines=True))
    return listed.select("id", "title", "start_date", "end_date", "license", "keywords")
