"""Point-in-polygon attach and vector zonal statistics."""

from __future__ import annotations

from covspark.operators.reshape import unnest
from covspark.sources import fixtures as fx
from covspark.sources.fixtures import with_fixtures
from covspark.queries.common import register, r6

def _pip_sql() -> str:
    """Oracle point-in-diamond: explicit edges, crossing parity + on-edge."""
    edges = [("x0", "y0+18", "x0+40", "y0"), ("x0+40", "y0", "x0+80", "y0+18"),
             ("x0+80", "y0+18", "x0+40", "y0+36"), ("x0+40", "y0+36", "x0", "y0+18")]
    sel = "\n    union all ".join(
        f"select poly_id, {a} as xa, {b} as ya, {c} as xb, {d} as yb from f_polygons"
        for a, b, c, d in edges)
    return f"""pts as (select distinct latitude as py, longitude as px from f_events),
edges as ({sel}),
flags as (select p.py, p.px, e.poly_id,
    sum(case when (e.ya > p.py) <> (e.yb > p.py)
              and p.px < (e.xb - e.xa) * (p.py - e.ya) / (e.yb - e.ya) + e.xa then 1 else 0 end) as crossings,
    max(case when (e.xb - e.xa) * (p.py - e.ya) - (e.yb - e.ya) * (p.px - e.xa) = 0
              and p.px between least(e.xa, e.xb) and greatest(e.xa, e.xb)
              and p.py between least(e.ya, e.yb) and greatest(e.ya, e.yb) then 1 else 0 end) as on_edge
  from pts p cross join edges e group by p.py, p.px, e.poly_id),
hits as (select f.py, f.px, g.poly_id, g.name, g.region from flags f
         join f_polygons g on g.poly_id = f.poly_id
         where f.crossings % 2 = 1 or f.on_edge = 1)"""


@register("attach_vector_all", with_fixtures(f"""
with {_pip_sql()}
select e.event_key, h.poly_id, h.name, h.region
from f_events e left join hits h on h.py = e.latitude and h.px = e.longitude""", "f_events", "f_polygons"))
def q_attach_vector_all(spark, sf):
    """Attributes of every polygon containing each event (all columns)."""
    from covspark.plans.attach import attach_polygons
    out = attach_polygons(fx.f_events(spark, sf), fx.f_polygons(spark, sf))
    return out.select("event_key", "poly_id", "name", "region")


@register("attach_vector_columns", with_fixtures(f"""
with {_pip_sql()}
select e.event_key, e.site, h.name
from f_events e left join hits h on h.py = e.latitude and h.px = e.longitude""", "f_events", "f_polygons"))
def q_attach_vector_columns(spark, sf):
    """Only the requested polygon column is attached."""
    from covspark.plans.attach import attach_polygons
    out = attach_polygons(fx.f_events(spark, sf), fx.f_polygons(spark, sf), columns=["name"])
    return out.select("event_key", "site", "name")


@register("attach_vector_unmatched", with_fixtures(f"""
with {_pip_sql()}
select e.event_key, e.site from f_events e
where not exists (select 1 from hits h where h.py = e.latitude and h.px = e.longitude)""",
                                                   "f_events", "f_polygons"))
def q_attach_vector_unmatched(spark, sf):
    """Events inside no polygon."""
    from covspark.plans.attach import unmatched_events
    return unmatched_events(fx.f_events(spark, sf), fx.f_polygons(spark, sf)).select("event_key", "site")



VZ_RADIUS_M = 300000.0
VZ_COLUMNS = ["region", "poly_id"]
VZ_STATS = ["mean", "max", "count"]


def _vz_oracle() -> str:
    from covspark.functions.geo import M_PER_DEG
    edges = [("x0", "y0+18", "x0+40", "y0"), ("x0+40", "y0", "x0+80", "y0+18"),
             ("x0+80", "y0+18", "x0+40", "y0+36"), ("x0+40", "y0+36", "x0", "y0+18")]
    sel = "\n    union all ".join(
        f"select poly_id, {a} as xa, {b} as ya, {c} as xb, {d} as yb from f_polygons"
        for a, b, c, d in edges)
    stat_sql = {"mean": "avg(value)", "max": "max(value)", "count": "count(value)"}
    per_stat = "\n  union all ".join(
        f"select py, px, col, '{s}' as spatial_stat, cast({e} as double) as value from vals group by py, px, col"
        for s, e in stat_sql.items())
    dom = "\n  union all ".join(f"select '{c}' as col, '{s}' as spatial_stat"
                                for c in VZ_COLUMNS for s in VZ_STATS)
    return with_fixtures(f"""
with pts as (select distinct latitude as py, longitude as px from f_events),
edges as ({sel}),
seg as (select p.py, p.px, e.poly_id, e.xa, e.ya, e.xb, e.yb,
          (e.xa - p.px) * {M_PER_DEG} * cos(radians(p.py)) as ax, (e.ya - p.py) * {M_PER_DEG} as ay,
          (e.xb - p.px) * {M_PER_DEG} * cos(radians(p.py)) as bx, (e.yb - p.py) * {M_PER_DEG} as by_
        from pts p cross join edges e),
seg2 as (select *, bx - ax as dx, by_ - ay as dy, (bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay) as den from seg),
seg3 as (select *, case when den > 0 then least(greatest(-(ax * dx + ay * dy) / den, 0.0), 1.0) else 0.0 end as t
         from seg2),
flags as (select py, px, poly_id,
    sum(case when (ya > py) <> (yb > py) and px < (xb - xa) * (py - ya) / (yb - ya) + xa then 1 else 0 end) as crossings,
    max(case when (xb - xa) * (py - ya) - (yb - ya) * (px - xa) = 0
              and px between least(xa, xb) and greatest(xa, xb)
              and py between least(ya, yb) and greatest(ya, yb) then 1 else 0 end) as on_edge,
    min(sqrt(pow(ax + t * dx, 2) + pow(ay + t * dy, 2))) as dist
  from seg3 group by py, px, poly_id),
hits as (select f.py, f.px, g.region, g.poly_id from flags f join f_polygons g on g.poly_id = f.poly_id
         where f.crossings % 2 = 1 or f.on_edge = 1 or f.dist <= {VZ_RADIUS_M}),
vals as (select py, px, 'region' as col, cast(region as double) as value from hits
         union all select py, px, 'poly_id', cast(poly_id as double) from hits),
st as ({per_stat}),
dated as (select e.event_key, s.col, s.spatial_stat, s.value from f_events e
          join st s on s.py = e.latitude and s.px = e.longitude),
dom as ({dom}),
fill as (select e.event_key, dom.col, dom.spatial_stat, cast(null as double) as value
         from f_events e cross join dom
         where not exists (select 1 from dated x where x.event_key = e.event_key
                           and x.col = dom.col and x.spatial_stat = dom.spatial_stat))
select event_key, 'nations' as covariate, col as "column", spatial_stat, round(value, 6) as value
from (select * from dated union all select * from fill) a""", "f_events", "f_polygons")


@register("vector_zonal", _vz_oracle())
def q_vector_zonal(spark, sf):
    """Statistics of polygon attributes over the polygons within 300 km."""
    from covspark.plans.vector_zonal import vector_zonal_statistics
    out = vector_zonal_statistics(fx.f_events(spark, sf), fx.f_polygons(spark, sf), VZ_COLUMNS,
                                  spatial_stats=VZ_STATS, radius=VZ_RADIUS_M, covariate="nations")
    flat = unnest(out.select("event_key", "zonal_statistics"), "zonal_statistics", outer=False)
    return flat.select("event_key", "covariate", "column", "spatial_stat", r6("value"))


LAYER_COVARIATE, LAYER_DATASET = "cov_p3", "boundaries"


@register("attach_covariate_catalogue", with_fixtures(f"""
with {_pip_sql()}
select e.event_key, h.poly_id, h.name, h.region
from f_events e left join hits h on h.py = e.latitude and h.px = e.longitude and h.poly_id % 2 = 0""", "f_events", "f_polygons"))
def q_attach_covariate_catalogue(spark, sf):
    """The public attach job through the catalogue: a raster and a vector
    dataset, so the vector one is named; polygons of another dataset are left out."""
    import covspark
    from pyspark.sql import functions as F
    catalog = covspark.Catalog(fx.f_collections(spark, sf), fx.f_items(spark, sf), fx.f_assets(spark, sf))
    layer = F.when(F.col("poly_id") % 2 == 0, LAYER_DATASET).otherwise("old")
    polygons = fx.f_polygons(spark, sf).withColumn("covariate_id", F.lit(LAYER_COVARIATE)).withColumn("dataset", layer)
    out = covspark.attach_covariate_data(fx.f_events(spark, sf), catalog, polygons, LAYER_COVARIATE, dataset=LAYER_DATASET)
    return out.select("event_key", "poly_id", "name", "region")
