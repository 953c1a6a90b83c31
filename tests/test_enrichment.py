"""The request table, shared sources, window summaries, the pyramid, sketches and the Z-order store."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import covspark
from covspark.operators import pyramid, sketches, spatial
from covspark.operators.reshape import unnest
from covspark.operators.summarise import summarise_zonal_statistics
from covspark.operators.zonal import zonal_aggregate
from covspark.plans import requests as rq
from covspark.plans.window_summary import summarise_windows
from covspark.plans.zonal_statistics import zonal_statistics

d = dt.date
CELLS = "covariate_id string, item_date date, band int, cy double, cx double, half_deg double, value double"


def catalogue(spark):
    coll = spark.createDataFrame([("sst", "Sea"), ("map", "Twin"), ("old", "Twin"), ("dem", "Height"), ("vec", "Areas")], "id string, title string")
    items = [("sst", f"s{i}", d(2020, 1, 1) + dt.timedelta(days=i)) for i in range(400)] + [("dem", "d", d(2000, 1, 1)), ("vec", "v", d(2000, 1, 1))]
    items += [("map", f"m{i}", d(2020, 1, 1 + 10 * i)) for i in range(3)] + [("old", f"o{i}", d(2020, 1, 1) + dt.timedelta(days=i)) for i in range(60)]
    tif = "image/tiff; application=geotiff"
    named = [{"name": "red"}, {"name": "green"}]
    assets = [("sst", "data", tif, "a.tif", named), ("map", "data", tif, "b.tif", None), ("map", "cog", tif, "c.tif", None), ("dem", "data", tif, "d.tif", None),
              ("old", "data", tif, "e.tif", None), ("vec", "data", "application/x-parquet", "v.parquet", None)]
    return covspark.Catalog(coll, spark.createDataFrame(items, "covariate_id string, item_id string, item_date date"), spark.createDataFrame(
        assets, "covariate_id string, dataset string, mime string, href string, bands array<struct<name:string>>"))


def cells_of(spark):
    rows = [("sst", d(2020, 1, 1) + dt.timedelta(days=i), b, 0.5, 0.5, 0.5, float(i * b)) for i in range(40) for b in (1, 2)]
    rows += [("map", d(2020, 1, 1 + 10 * i), 1, 0.5, 0.5, 0.5, 100.0 + i) for i in range(3)] + [("dem", d(2000, 1, 1), 1, 0.5, 0.5, 0.5, 7.0)]
    return spark.createDataFrame(rows, CELLS)


REQUESTS = [
    {"name": "a", "covariate": "Sea", "bands": ["green"], "n_days": 3, "radius": 10},
    {"name": "b", "covariate": "sst", "bands": [1, 2], "n_days": 2, "radius": 10, "spatial_stats": ["max", "count"]},
    {"name": "c", "covariate": "map", "dataset": "data", "radius": 10},
    {"name": "d", "covariate": "Height", "radius": 10},
]


def test_one_enrichment_equals_single_jobs(spark):
    cat, cells = catalogue(spark), cells_of(spark)
    se = spark.createDataFrame([(1, 0.2, 0.2, d(2020, 1, 15), "x"), (2, 0.2, 0.2, d(2020, 1, 5), "y"), (2, 0.2, 0.2, d(2020, 1, 5), "y"), (3, 50.0, 0.2, d(2020, 1, 5), "z"),
                                (4, 0.2, 0.2, None, "w")], "k int, latitude double, longitude double, sample_date date, src string")
    wide = covspark.enrich(se, cat, cells, REQUESTS).collect()
    long = covspark.enrich(se, cat, cells, REQUESTS, long=True)
    assert long.columns == [*se.columns, "request", "zonal_statistics"]
    by_request = {}
    for r in long.collect():
        by_request.setdefault((r.k, r.request), []).append([(x.date, x.band, x.spatial_stat, x.value) for x in r.zonal_statistics])
    for q in REQUESTS[1:3]:
        one = covspark.get_zonal_statistics(se, cat, cells, q["covariate"], **{k: v for k, v in q.items() if k not in ("name", "covariate")})
        want = sorted(((r.k, [(x.date, x.band, x.spatial_stat, x.value) for x in r.zonal_statistics]) for r in one.collect()), key=repr)
        col = f"zonal_statistics_{q['name']}"
        assert sorted(((r.k, [(x.date, x.band, x.spatial_stat, x.value) for x in r[col]]) for r in wide), key=repr) == want
        assert sorted(((k, x) for (k, name), xs in by_request.items() if name == q["name"] for x in xs), key=repr) == want
    first = next(r for r in wide if r.k == 1)
    assert [x.value for x in first.zonal_statistics_a] == [28.0, 26.0, 24.0] and first.zonal_statistics_a[0].band_name == "green"
    assert [x.value for x in first.zonal_statistics_c] == [101.0] and [x.value for x in first.zonal_statistics_d] == [7.0]
    assert next(r for r in wide if r.k == 4).zonal_statistics_d[0].value == 7.0  # a single edition needs no date


def test_faults_of_requests(spark):
    bad = [
        ({"covariate": "nope"}, "unknown covariate"), ({"covariate": "Twin"}, "title of several covariates"), ({"covariate": "map"}, "dataset to be named"),
        ({"covariate": "map", "dataset": "x"}, "unknown dataset"), ({"covariate": "vec"}, "no raster dataset"), ({"covariate": "old"}, "cadence left open"),
        ({"covariate": "sst", "bands": [1]}, "n_days needed"), ({"covariate": "sst", "n_days": 3}, "bands to be listed"),
        ({"covariate": "sst", "n_days": 3, "bands": [1, "red"]}, "band named twice"), ({"covariate": "sst", "n_days": 3, "bands": [1, 1]}, "repeated band"),
        ({"covariate": "sst", "n_days": 3, "bands": [7]}, "unknown band 7"), ({"covariate": "dem", "spatial_stats": ["mode"]}, "unknown statistic mode"),
        ({"covariate": "dem", "radius": -1}, "negative radius"), ({"covariate": "dem", "cadence": "weekly"}, "unknown cadence"),
        ({"covariate": "dem", "spatial_stats": ["min", "min"]}, "repeated statistic"), ({"covariate": "dem", "spatial_stats": []}, "no statistic"),
        ({"covariate": "dem", "name": "0"}, "repeated request"),
    ]
    cat = catalogue(spark)
    faults = covspark.validate_requests(cat, rq.requests_table(spark, [b for b, _ in bad])).collect()
    told = {}
    for f in faults:
        told.setdefault(f.request, []).append(f.kind + (f" {f.detail}" if f.detail else ""))
    for k, (b, kind) in enumerate(bad):
        assert any(t.startswith(kind) for t in told[b.get("name", str(k))]), (b, told.get(str(k)))
    with pytest.raises(ValueError, match="1: n_days needed.*|.*unknown covariate"):
        covspark.enrich(cells_of(spark), cat, cells_of(spark), [{"covariate": "nope"}, {"covariate": "sst", "bands": [1]}])
    with pytest.raises(ValueError, match="unknown fields"):
        rq.requests_table(spark, [{"covariate": "sst", "radiu": 3}])
    assert covspark.validate_requests(cat, rq.requests_table(spark, REQUESTS)).count() == 0


@pytest.mark.parametrize("n_days,nulls", [(3, "reference"), (40, "skip")])
def test_window_summary_equals_nested_summary(spark, n_days, nulls):
    rng = random.Random(n_days)
    rows = [("sst", d(2020, 1, 1) + dt.timedelta(days=i), 1, 0.5, 0.5, 0.5, rng.choice([None, 1.0, 2.0, 5.0])) for i in range(60) if i % 5]
    cells = spark.createDataFrame(rows, CELLS)
    se = spark.createDataFrame([(i, 0.2, 0.2, d(2020, 1, 1) + dt.timedelta(days=3 * i)) for i in range(24)] + [(99, 0.2, 0.2, None), (100, 9.0, 0.2, d(2020, 1, 9))],
                               "k int, latitude double, longitude double, sample_date date")
    items = cells.select("covariate_id", "item_date").distinct()
    stats = ["min", "max", "mean", "sum", "prod"]
    own = dict(covariate_id="sst", n_days=n_days, radius=10.0, spatial_stats=["mean", "count"], cell_deg=1.0)
    got = summarise_windows(se, items, cells, temporal_stats=stats, nulls=nulls, **own)
    want = summarise_zonal_statistics(zonal_statistics(se, items, cells, cadence="daily", **own), stats, nulls=nulls)
    flat = lambda df: sorted(((r.k, s.start_date, s.end_date, s.n_dates, s.band, s.spatial_stat, s.temporal_stat, None if s.value is None else round(s.value, 6))
                              for r in df.collect() for s in r.summary_zonal_statistics), key=repr)
    assert flat(got) == flat(want)


def globe(spark, seed, n=1500):
    rng = random.Random(seed)
    rows = [("c", d(2020, 1, 1 + rng.randrange(2)), 1, rng.randrange(-89, 90) + 0.5 if rng.random() < 0.9 else 89.5, rng.randrange(-180, 180) + 0.5, 0.5,
             rng.choice([None, float(rng.randrange(9))])) for _ in range(n)]
    return spark.createDataFrame(rows, CELLS).dropDuplicates(["item_date", "cy", "cx"])


PLACES = [(89.0, 10.0), (0.0, 179.9), (-88.5, -120.0), (12.3, -180.0), (45.0, 7.0)]


def test_pyramid_equals_all_cells(spark):
    cells = globe(spark, 1).cache()
    points = spark.createDataFrame([(*p, "c", d(2020, 1, k)) for p in PLACES for k in (1, 2)], "latitude double, longitude double, covariate_id string, item_date date")
    table = pyramid.build_pyramid(cells).cache()
    for radius in (1500000.0, 12000000.0):
        got = pyramid.zonal_from_pyramid(points, table, cells, radius, pyramid.STATS, cell_deg=1.0)
        hits = spatial.cells_in_radius(points, cells, radius, cell_deg=1.0)
        want = zonal_aggregate(hits, ["latitude", "longitude", "item_date", "band"], list(pyramid.STATS))
        key = lambda r: (r.latitude, r.longitude, r.item_date)
        got, want = {key(r): r for r in got.collect()}, {key(r): r for r in want.collect()}
        assert got.keys() == want.keys()
        for k, r in want.items():
            assert all((r[s] is None) == (got[k][s] is None) and (r[s] is None or got[k][s] == pytest.approx(r[s], rel=1e-9)) for s in pyramid.STATS)
        if radius > 1e7:  # most of the disc is answered by tiles
            assert all(r.n_cells < 0.35 * r["count"] for r in got.values() if r["count"] > 100)
    with pytest.raises(ValueError):
        pyramid.zonal_from_pyramid(points, table, cells, 1.0, ["median"], cell_deg=1.0)


def test_either_side_repeated_per_tile(spark, monkeypatch):
    cells = globe(spark, 2).cache()
    points = spark.createDataFrame([(*p, "c", d(2020, 1, 1)) for p in PLACES], "latitude double, longitude double, covariate_id string, item_date date")
    for radius in (0.0, 3000000.0):
        found = []
        for few in (points, cells):
            monkeypatch.setattr(spatial, "estimated_bytes", lambda df, few=few: 1.0 if df is few else 1e15)
            found.append(sorted((r.latitude, r.longitude, r.cy, r.cx) for r in spatial.cells_in_radius(points, cells, radius, cell_deg=1.0).collect()))
        assert found[0] == found[1] and (radius == 0 or found[0])


def test_window_sketches(spark):
    rows = [(1, d(2020, 1, 1 + i % 20), float((i * 37) % 1000)) for i in range(4000)] + [(1, d(2020, 1, 3), None)]
    hits = spark.createDataFrame(rows, "p int, item_date date, value double").withColumn("band", F.lit(1))
    req = spark.createDataFrame([(1, d(2020, 1, 20)), (1, d(2020, 1, 5)), (2, d(2020, 1, 5))], "p int, day date")
    got = {r.day: r for r in sketches.window_quantiles(req, sketches.daily_sketches(hits, ["p", "item_date", "band"]), "day", 20, ["p"], (0.1, 0.5)).collect()}
    assert set(got) == {d(2020, 1, 20), d(2020, 1, 5)} and got[d(2020, 1, 20)].n == 4000
    assert abs(got[d(2020, 1, 20)].q50 - 500) < 20 and abs(got[d(2020, 1, 20)].q10 - 100) < 20 and abs(got[d(2020, 1, 20)].unique - 1000) < 30


def test_curve_store_reads_near_stretches_only(spark, tmp_path):
    from covspark.sources.catalog import read_curve_store, write_curve_store
    cells = globe(spark, 3)
    path = str(tmp_path / "store")
    write_curve_store(cells, path)
    ev = spark.createDataFrame([(k, *p, d(2020, 1, 2)) for k, p in enumerate(PLACES)], "k int, latitude double, longitude double, sample_date date")
    items = cells.select("covariate_id", "item_date").distinct()
    stored = read_curve_store(spark, path, ev, 400000.0, 1.0)
    assert 0 < stored.count() < 0.3 * cells.count()

    def run(c):
        return zonal_statistics(ev, items, c, covariate_id="c", cadence="daily", n_days=2, radius=400000.0, cell_deg=1.0)

    flat = lambda df: sorted((tuple(r) for r in unnest(df.select("k", "zonal_statistics"), "zonal_statistics").collect()), key=repr)
    assert flat(run(stored)) == flat(run(cells))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = run(stored)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [part.split("ReadSchema")[0] for part in plan.split("PushedFilters")[1:]]
    assert any("GreaterThanOrEqual(zkey" in p for p in pushed) and "LeftSemi" in plan


def test_ranges_of_the_curve():
    class Rows(list):
        def collect(self):
            return [type("R", (), {"z_tile": z})() for z in self]

    step = 1 << 2 * (spatial.Z_LEVEL - spatial.Z_ASK_LEVEL)
    assert spatial.z_ranges(Rows([1, 2, 3, 7, 8, 20])) == [(step, 4 * step - 1), (7 * step, 9 * step - 1), (20 * step, 21 * step - 1)]
    assert spatial.z_ranges(Rows([1, 2, 3, 7, 8, 20]), 2) == [(step, 9 * step - 1), (20 * step, 21 * step - 1)]
    assert len(spatial.z_ranges(Rows(range(0, 4000, 2)), 16)) <= 16 and spatial.z_ranges(Rows()) == []
