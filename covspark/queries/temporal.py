"""Temporal matching, windows, item scans and event preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from covspark.operators import temporal
from covspark.sources import fixtures as fx
from covspark.sources.fixtures import with_fixtures
from covspark.queries.common import register, N_DAYS

def _order_part_requests(spark, sf, family: str, key: str):
    """Requests (event, covariate) derived from lineitem: each order asks for
    the covariate of each of its parts (or suppliers).  The lines are dealt by their order, so that pairs are told apart where
    they meet the order."""
    li = fx.table(spark, sf, "lineitem")
    ev = fx.f_events(spark, sf).select("event_key", "sample_date")
    req = li.select(F.col("l_orderkey").alias("event_key"),
                    F.col(key)).repartition("event_key").select("event_key", F.concat(F.lit(family), F.col(key)).alias("covariate_id")).distinct()
    return req.join(ev, on="event_key")


REQ_SQL = """req as (select distinct l.l_orderkey as event_key, concat('{family}', l.{key}) as covariate_id,
       e.sample_date from lineitem l join f_events e on e.event_key = l.l_orderkey)"""


@register("asof_items", with_fixtures(f"""
with {REQ_SQL.format(family='cov_p', key='l_partkey')}
select r.event_key, r.covariate_id, r.sample_date, i.item_date, i.item_id
from req r asof left join f_items i
  on r.covariate_id = i.covariate_id and r.sample_date >= i.item_date""", "f_events", "f_items"))
def q_asof_items(spark, sf):
    """Backward as-of join of every (order, part) request to that part's items."""
    req = _order_part_requests(spark, sf, "cov_p", "l_partkey")
    out = temporal.asof_items(req, fx.f_items(spark, sf), "sample_date")
    return out.select("event_key", "covariate_id", "sample_date", "item_date", "item_id")


@register("lookback_items", with_fixtures(f"""
with {REQ_SQL.format(family='cov_s', key='l_suppkey')}
select r.event_key, r.covariate_id, r.sample_date, i.item_date, i.item_id
from req r left join f_items i
  on r.covariate_id = i.covariate_id and i.item_date between r.sample_date - {N_DAYS - 1} and r.sample_date""",
                                          "f_events", "f_items"))
def q_lookback_items(spark, sf):
    """Every supplier item inside each (order, supplier) request's 30-day window."""
    req = _order_part_requests(spark, sf, "cov_s", "l_suppkey")
    out = temporal.lookback_items(req, fx.f_items(spark, sf), "sample_date", N_DAYS)
    return out.select("event_key", "covariate_id", "sample_date", "item_date", "item_id")


@register("attach_once", with_fixtures("""
with cad as (select covariate_id from f_items group by covariate_id having count(*) = 1)
select e.event_key, i.covariate_id, e.sample_date, i.item_date, i.item_id
from f_events e join cad c on c.covariate_id = concat('cov_o', e.event_key)
join f_items i on i.covariate_id = c.covariate_id""", "f_events", "f_items"))
def q_attach_once(spark, sf):
    """Single-edition covariates: each order's own covariate when it has one
    item, attached whatever the sample date (here the item is later)."""
    items = fx.f_items(spark, sf)
    once = temporal.cadence(items).where(F.col("cadence") == "once").select("covariate_id")
    req = (fx.f_events(spark, sf).select("event_key", "sample_date")
           .withColumn("covariate_id", F.concat(F.lit("cov_o"), F.col("event_key")))
           .join(once, on="covariate_id"))
    out = temporal.attach_once(req, items)
    return out.select("event_key", "covariate_id", "sample_date", "item_date", "item_id")


@register("cadence", with_fixtures("""
select covariate_id, count(*) as n_items,
  case when count(*) = 1 then 'once' when count(*) < 50 then 'periodic'
       when count(*) <= 300 then 'check' else 'daily' end as cadence
from f_items group by covariate_id""", "f_items"))
def q_cadence(spark, sf):
    return temporal.cadence(fx.f_items(spark, sf))


@register("first_item", with_fixtures("""
select covariate_id, max(item_date) as item_date,
       arg_max(item_id, item_date) as item_id
from f_items group by covariate_id""", "f_items"))
def q_first_item(spark, sf):
    return temporal.first_item(fx.f_items(spark, sf))


@register("merge_windows", with_fixtures(f"""
with d as (select *, lag(sample_date) over (partition by latitude, longitude order by sample_date) as prev
           from f_events),
s as (select *, case when prev is null or sample_date - prev > {N_DAYS} then 1 else 0 end as is_start from d),
g as (select *, sum(is_start) over (partition by latitude, longitude order by sample_date
            rows between unbounded preceding and current row) as grp from s),
b as (select latitude, longitude, sample_date, grp from g)
select event_key, min(sample_date) over (partition by latitude, longitude, grp) as start_date,
       max(sample_date) over (partition by latitude, longitude, grp) as end_date
from g""", "f_events"))
def q_merge_windows(spark, sf):
    """Gaps and islands: merged 30-day lookback windows per site."""
    out = temporal.merge_windows(fx.f_events(spark, sf), N_DAYS)
    return out.select("event_key", "start_date", "end_date")


@register("duplicate_requests", with_fixtures("""
select latitude, longitude, sample_date, count(*) as n
from f_events group by latitude, longitude, sample_date having count(*) > 1""", "f_events"))
def q_duplicate_requests(spark, sf):
    """Request keys (location, date) shared by several events."""
    return temporal.duplicate_keys(fx.f_events(spark, sf), ["latitude", "longitude", "sample_date"])



@register("items_in_interval", with_fixtures("""
select covariate_id, item_date, item_id from f_items
where item_date between date '1995-01-01' and date '1995-12-31'
union all select covariate_id, item_date, item_id from f_items where item_date >= date '1998-11-01'""",
                                             "f_items"))
def q_items_in_interval(spark, sf):
    """Date-bounded item scans: a closed interval and an open-ended one."""
    items = fx.f_items(spark, sf)
    return (temporal.items_between(items, "1995-01-01", "1995-12-31")
            .unionByName(temporal.items_between(items, start="1998-11-01"))
            .select("covariate_id", "item_date", "item_id"))



@register("prepare_events", with_fixtures("""
select event_key, site, latitude, longitude, sample_date as date, tags, response as cover
from f_events where regexp_matches(tags, '^(F|O)$') and response is not null""", "f_events"))


def q_prepare_events(spark, sf):
    """User-side preparation: tag filter, not-null filter, renames."""
    ev = fx.f_events(spark, sf)
    return (ev.where(F.col("tags").rlike("^(F|O)$") & F.col("response").isNotNull())
            .withColumnRenamed("sample_date", "date").withColumnRenamed("response", "cover"))


@register("request_counts", with_fixtures("""
select event_key, count(*) over (partition by latitude, longitude, sample_date) as n from f_events""", "f_events"))
def q_request_counts(spark, sf):
    """The number of samples of each place and date, kept on every sample."""
    from covspark.operators.reshape import with_group_count
    return with_group_count(fx.f_events(spark, sf), ["latitude", "longitude", "sample_date"]).select("event_key", "n")


@register("row_ids", with_fixtures("""
select tags, count(*) as n_rows, count(*) as n_ids, count(distinct struct_pack(a := latitude, b := sample_date)) as n_first
from f_events group by tags""", "f_events"))
def q_row_ids(spark, sf):
    """Stable row ids of samples that repeat: as many ids as rows, one of them the first of its equal rows."""
    from covspark.operators.reshape import with_row_id
    rows = with_row_id(fx.f_events(spark, sf).select("tags", "latitude", "sample_date"))
    return rows.groupBy("tags").agg(F.count("*").alias("n_rows"), F.count_distinct("row_id").alias("n_ids"),
                                    F.count_if(F.col("row_id").endswith("-1")).alias("n_first"))
