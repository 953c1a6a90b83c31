"""Findings of round 4: whole tables are read, and what is multiplied is neither shuffled nor made per event."""

import datetime as dt
import re

import duckdb
import pytest

import __spark_entry__ as entry_mod


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def odd_sf(spark, tmp_path_factory):
    """A few orders and their lines: orders that share a place and a day, repeated and missing keys, lines of seven bands."""
    d = tmp_path_factory.mktemp("odd")
    day = dt.datetime(1996, 1, 1)
    orders = [(k if k % 11 else 7, None if k == 5 else (k * 7) % 9, "FOP"[k % 3], 100.0 + k, None if k == 6 else day + dt.timedelta(days=(k * 13) % 150)) for k in range(40)]
    lines = [(k % 40, k % 13, None if k == 10 else k % 4, None if k % 90 == 13 else 1 + k % 7, float(1 + (k * 17) % 50), "RAN"[k % 3],
              None if k == 11 else day + dt.timedelta(days=(k * 29) % 200)) for k in range(900)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, "
                          "l_shipdate timestamp_ntz").write.parquet(f"{d}/lineitem.parquet")
    return str(d)


def both(spark, sf, name, order):
    """What Spark and the query's SQL return, as sorted rows."""
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet/*.parquet')")
    got = entry_mod.queries()[name](spark, sf).select(*order).collect()
    want = con.execute(f"select {', '.join(order)} from ({entry_mod.oracle_sql()[name]})").fetchall()
    return sorted(map(tuple, got), key=repr), sorted(want, key=repr)


def test_window_quantiles_read_all_bands(spark, odd_sf):
    """the query read bands 1 and 2 only, and so did its SQL."""
    got, want = both(spark, odd_sf, "zonal_window_quantiles", ["latitude", "longitude", "sample_date", "band", "n", "median_in_bound", "unique_in_bound"])
    assert got == want and {r[3] for r in got} == {None, *range(1, 8)}


def _raster(spark):
    day = dt.date(2020, 1, 1)
    cells = spark.createDataFrame([("sst", day + dt.timedelta(days=i), b, x + 0.5, 0.5, 0.5, float((i * b) % 5) if i % 4 else None)
                                   for i in range(12) for b in (1, 2) for x in (0, 1, 9)],
                                  "covariate_id string, item_date date, band int, cy double, cx double, half_deg double, value double")
    places = [(0.9, 0.2), (9.2, 0.2), (50.0, 0.2), (None, 0.2)]
    ev = [(k, *places[k % 4], day + dt.timedelta(days=k % 9) if k % 7 else None) for k in range(24)]
    return cells, spark.createDataFrame(ev, "k int, latitude double, longitude double, sample_date date")


def test_elements_of_requests_are_made_once_a_slot(spark):
    """each event made the elements of each of its requests anew."""
    from covspark.plans.enrichment import Request, enrich_long, enrich_wide
    cells, se = _raster(spark)
    items = cells.select("covariate_id", "item_date").distinct().selectExpr("*", "'i' as item_id")
    asked = [Request("sst", "daily", {1: "a", 2: "b"}, n_days=4, radius=90000.0, cell_deg=1.0, stats=["mean", "freq_hist"], name="d4"),
             Request("sst", "daily", {2: "b"}, n_days=2, radius=90000.0, cell_deg=1.0, stats=["max"], name="d2", title="t"),
             Request("sst", "periodic", {2: None, 1: None}, radius=90000.0, cell_deg=1.0, stats=["max", "mean"], name="p")]
    out = enrich_long(se, asked, items, cells)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "(covariate," not in plan[:plan.index("Join LeftOuter")]
    rows = lambda x: [(e.date, e.band, e.spatial_stat, e.value, getattr(e, "hist", None)) for e in x]
    got = {(r.k, r.request): rows(r.zonal_statistics) for r in out.collect()}
    wide = enrich_wide(se, asked, items, cells).collect()
    assert got == {(r.k, q.name): rows(r[f"zonal_statistics_{q.name}"]) for r in wide for q in asked}
    assert len({e.covariate for r in out.where("request = 'd2'").collect() for e in r.zonal_statistics}) == 1
    assert {e[2] for e in got[1, "d4"]} == {"mean", "freq_hist"} and any(e[4] for e in got[1, "d4"]) and len(got[0, "d4"]) == 4


def test_items_of_covariates_nobody_names_are_dropped_before_a_shuffle(spark):
    """checking a few requests shuffled all the items of the catalogue."""
    from covspark.plans.requests import check_requests, requests_table
    coll = spark.createDataFrame([(f"c{k}", f"title {k}") for k in range(9)], "id string, title string")
    items = spark.createDataFrame([(f"c{k % 9}", dt.date(2020, 1, 1 + k % 7), f"i{k}") for k in range(60)], "covariate_id string, item_date date, item_id string")
    assets = spark.createDataFrame([(f"c{k}", "data", "image/tiff; application=geotiff", "a.tif", [("x",), ("y",)]) for k in range(9)],
                                   "covariate_id string, dataset string, mime string, href string, bands array<struct<name:string>>")
    table = requests_table(spark, [dict(covariate="c1", bands=["y"]), dict(covariate="title 2", bands=[1, 2], n_days=3), dict(covariate="none")])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = check_requests(coll, items, assets, table, few=True)
        assert len(re.findall(r"BroadcastHashJoin [^\n]*LeftSemi", plan_of(few))) >= 2
        assert sorted(few.collect(), key=str) == sorted(check_requests(coll, items, assets, table).collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_stretches_of_the_curve_are_looked_up(spark, tmp_path):
    """each cell was compared with every stretch, in code too long to be compiled, and its key made a place sixteen times."""
    from pyspark.sql import functions as F
    from covspark.operators import spatial
    from covspark.sources.catalog import read_curve_store, write_curve_store
    day = dt.date(2020, 1, 1)
    cells = spark.createDataFrame([("sst", day + dt.timedelta(days=40 * (x % 2)), 1, y + 0.5, x + 0.5, 0.5, float(x)) for x in range(-180, 180, 3) for y in range(-90, 90, 3)]
                                  + [("sst", day, 1, None, 0.5, 0.5, 1.0), ("sst", day, 1, 0.5, None, 0.5, 1.0)],
                                  "covariate_id string, item_date date, band int, cy double, cx double, half_deg double, value double")
    write_curve_store(cells, f"{tmp_path}/store")
    places = spark.createDataFrame([(float((k * 37) % 160 - 80), float((k * 91) % 340 - 170)) for k in range(60)], "latitude double, longitude double")
    ranges = spatial.z_ranges(spatial.z_tiles(places, "latitude", "longitude", 50000.0, 1.0))
    assert len(ranges) > 40
    stored = read_curve_store(spark, f"{tmp_path}/store", places, 50000.0, 1.0)
    assert stored._jdf.queryExecution().optimizedPlan().toString().count(">=") < 40
    key = lambda x: x.select("item_date", "cy", "cx").collect()
    every = spark.read.parquet(f"{tmp_path}/store")
    kept = [r for r in every.select("item_date", "cy", "cx", "zkey").collect() if r.zkey is not None and any(lo <= r.zkey <= hi for lo, hi in ranges)]
    assert 0 < len(kept) < every.count() - 2 and every.count() == cells.count()
    assert sorted(map(tuple, key(stored))) == sorted((r.item_date, r.cy, r.cx) for r in kept)
    size = 360.0 / (1 << spatial.Z_LEVEL)
    from covspark.functions import geo
    assert every.where(~F.col("zkey").eqNullSafe(geo.morton(geo.tile_x(F.col("cx"), size), geo.tile_y(F.col("cy"), size)))).count() == 0


def test_what_windows_read_is_not_shuffled(spark, odd_sf):
    """hits, sketches and values of each place, day and band were shuffled, the values once more by slots."""
    plan = plan_of(entry_mod.queries()["zonal_window_quantiles"](spark, odd_sf))
    assert not re.search(r"Exchange hashpartitioning\([^\n]*(latitude|_at)#[^\n]*band#", plan)
    assert len(re.findall(r"Exchange hashpartitioning\(_at#", plan)) <= 3  # cells, and requests for the days wanted and for the answers


def test_regions_hold_what_their_places_reach(spark):
    from pyspark.sql import functions as F
    from covspark.operators.spatial import cells_in_radius, deal_regions
    cells = spark.createDataFrame([(y + 0.5, x + 0.5, 0.5, e) for x in range(-180, 180, 6) for y in range(-90, 90, 5) for e in (0, 1)]
                                  + [(None, x + 0.5, 0.5, e) for x in range(-180, 180, 6) for e in (0, 1)], "cy double, cx double, half_deg double, e int")
    places = spark.createDataFrame([(lat, lon, e) for e, lat, lon in ((0, 0.25, 179.9), (1, 89.0, 10.0), (0, -80.25, -170.25), (1, 51.4, 51.4), (1, 0.25, 179.9))],
                                   "latitude double, longitude double, p int")
    p, c, by = deal_regions(places, cells, 1500000.0, 1.0, F.col("p"), F.array("e"))
    key = lambda df: sorted(((r.latitude, r.longitude, r.p, r.cy, r.cx) for r in df.where("p = e").collect()), key=repr)
    assert p.count() == places.count()
    got = key(cells_in_radius(p, c, 1500000.0, keys=by, cell_deg=1.0))
    want = key(cells_in_radius(places.withColumn("one", F.lit(1)), cells.withColumn("one", F.lit(1)), 1500000.0, keys=("one",), cell_deg=1.0))
    assert got == want and len({r[:3] for r in got}) == 5


def test_request_pairs_are_shuffled_once(spark, odd_sf):
    """the pairs of order and part were shuffled to tell them apart, and again to meet their order."""
    from pyspark.sql import functions as F
    from covspark.queries.temporal import _order_part_requests
    from covspark.sources import fixtures as fx
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        req = _order_part_requests(spark, odd_sf, "cov_p", "l_partkey")
        assert len(re.findall(r"Exchange hashpartitioning\(", plan_of(req))) == 2  # lines and orders
        pairs = fx.table(spark, odd_sf, "lineitem").select(F.col("l_orderkey").alias("event_key"), F.concat(F.lit("cov_p"), F.col("l_partkey")).alias("covariate_id"))
        want = pairs.distinct().join(fx.f_events(spark, odd_sf).select("event_key", "sample_date"), "event_key")
        assert sorted(map(repr, req.collect())) == sorted(map(repr, want.collect())) and req.count() > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
