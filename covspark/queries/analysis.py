"""Grouped summaries and line fits over enriched events."""

from __future__ import annotations

from pyspark.sql import functions as F

from covspark.sources import fixtures as fx
from covspark.sources.fixtures import with_fixtures
from covspark.queries.common import register
from covspark.queries.vector import _pip_sql
from covspark.queries.zonal import ZONAL_SQL, _zonal, _zonal_oracle

@register("project_summary", with_fixtures(f"""
with {_pip_sql()},
j as (select e.*, h.name from f_events e left join hits h on h.py = e.latitude and h.px = e.longitude)
select tags, name, count(distinct site) as n_sites, count(*) as n_events, round(avg(response), 6) as mean_value
from j group by tags, name""", "f_events", "f_polygons"))
def q_project_summary(spark, sf):
    """Sites, events and mean response per status tag and containing polygon."""
    from covspark.operators.analysis import group_summary
    from covspark.plans.attach import attach_polygons
    ev = attach_polygons(fx.f_events(spark, sf), fx.f_polygons(spark, sf), columns=["name"])
    return group_summary(ev, ["tags", "name"]).withColumn("mean_value", F.round("mean_value", 6))


@register("covariate_fit", _zonal_oracle({"mean": ZONAL_SQL["mean"]}, final="""
, per_event as (select event_key, avg(value) as cov from allrows group by event_key)
select e.tags, round(regr_slope(e.response, p.cov), 6) as slope,
       round(regr_intercept(e.response, p.cov), 6) as intercept,
       round(regr_r2(e.response, p.cov), 6) as r2, cast(regr_count(e.response, p.cov) as bigint) as n
from f_events e join per_event p on p.event_key = e.event_key group by e.tags"""))


def q_covariate_fit(spark, sf):
    """Response against the 30-day mean covariate, one line per status tag."""
    from covspark.operators.analysis import fit_line
    from covspark.operators.summarise import summarise_zonal_statistics
    zs = _zonal(spark, sf, ["mean"])
    sm = summarise_zonal_statistics(zs, "mean")
    cov = F.get(F.col("summary_zonal_statistics"), 0)["value"]
    fit = fit_line(sm.withColumn("cov", cov), "response", "cov", by="tags")
    return fit.select("tags", *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2")],
                      F.col("n").cast("bigint").alias("n"))
