import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

import covspark
from covspark.operators import catalog as cat
from covspark.sources.catalog import explode_assets, read_collections, read_items

d = dt.date


def _write(obj) -> str:
    path = tempfile.mkdtemp(prefix="covspark-test-") + "/doc.json"
    with open(path, "w") as fh:
        json.dump(obj, fh)
    return path


COLLECTIONS = {"collections": [
    {"id": "sst", "title": "Sea surface temperature", "description": "Daily SST",
     "license": "CC-BY-4.0", "keywords": ["temperature", "ocean"],
     "providers": [{"name": "Agency", "roles": ["producer", "host"]}],
     "extent": {"spatial": {"bbox": [[-180, -90, 180, 90]]},
                "temporal": {"interval": [["1985-01-01T00:00:00Z", None]]}}},
    {"id": "gpw_realms", "title": "GPW Realms", "description": "Marine realms",
     "keywords": [], "providers": [],
     "extent": {"temporal": {"interval": [["2007-01-01T00:00:00Z", "2007-01-01T00:00:00Z"]]}}},
    {"id": "twin_a", "title": "Twin", "description": None},
    {"id": "twin_b", "title": "Twin", "description": "second"},
]}


def _item(cid, iid, date, assets):
    return {"id": iid, "collection": cid, "properties": {"datetime": f"{date}T00:00:00Z"}, "assets": assets}


ITEMS = {"type": "FeatureCollection", "features": [
    _item("sst", f"sst_{i}", d(2020, 1, 1) + dt.timedelta(days=i),
          {"data": {"href": "s.tif", "type": "image/tiff; application=geotiff"},
           "thumbnail": {"href": "t.png", "type": "image/png"}}) for i in range(400)] + [
    _item("gpw_realms", "r1", d(2007, 1, 1),
          {"data": {"href": "realms.parquet", "type": "application/vnd.apache.parquet",
                    "table:columns": [{"name": "REALM"}, {"name": "geometry"}]}}),
    _item("twin_a", "m1", d(2010, 1, 1),
          {"b1": {"href": "x.TIFF", "raster:bands": [{"name": "red"}, {"name": "green"}, {}]},
           "b2": {"href": "y.tif"}}),
]}


@pytest.fixture(scope="module")
def catalog(spark):
    coll = read_collections(spark, _write(COLLECTIONS))
    items = read_items(spark, _write(ITEMS))
    return covspark.Catalog(coll, items.select("covariate_id", "item_id", "item_date"), explode_assets(items))


def test_list_and_search(catalog):
    lst = covspark.list_covariates(catalog).collect()
    assert [r["title"] for r in lst][-1] == "GPW Realms"   # GPW titles last
    sst = [r for r in lst if r["id"] == "sst"][0]
    assert sst["keywords"] == "ocean, temperature" and sst["start_date"] == d(1985, 1, 1)
    assert sst["end_date"] is None
    assert covspark.search_covariates(catalog).count() == len(lst)   # no terms = list
    assert [r["id"] for r in covspark.search_covariates(catalog, title="SEA").collect()] == ["sst"]
    assert covspark.search_covariates(catalog, description="second").count() == 1
    label = catalog.collections.select(cat.provider_label(F.col("providers")).alias("p")).first()["p"]
    assert label == "Agency (host), Agency (producer)"


def test_resolve(catalog):
    assert covspark.resolve_covariate(catalog, "Sea surface temperature") == ("sst", "Sea surface temperature")
    assert covspark.resolve_covariate(catalog, "sst")[0] == "sst"
    with pytest.raises(ValueError, match="ambiguous"):
        covspark.resolve_covariate(catalog, "Twin")
    with pytest.raises(ValueError, match="not a valid"):
        covspark.resolve_covariate(catalog, "nope")


def test_datasets_and_types(catalog):
    bands = {(r["dataset"], r["band"], r["name"])
             for r in covspark.list_datasets_for_covariate(catalog, "twin_a").collect()}
    assert bands == {("b1", 1, "red"), ("b1", 2, "green"), ("b1", 3, None), ("b2", 1, None)}
    realm = covspark.list_datasets_for_covariate(catalog, "gpw_realms").collect()
    assert {(r["band"], r["name"]) for r in realm} == {(None, "REALM"), (None, "geometry")}
    cap = covspark.covariate_helper(catalog, "twin_a").first()
    assert cap["type"] == "raster" and cap["dataset_required"] and cap["band_required"]
    sst = covspark.covariate_helper(catalog, "sst").first()
    assert sst["function"] == "zonal_statistics" and not sst["dataset_required"]


def test_zonal_via_catalog(spark, catalog):
    cells = spark.createDataFrame(
        [("sst", d(2020, 1, 1) + dt.timedelta(days=i), 1, 0.5, 0.5, 0.5, float(i)) for i in range(400)],
        "covariate_id string, item_date date, band int, cy double, cx double, half_deg double, value double")
    se = spark.createDataFrame([("s1", 0.2, 0.2, "2020-01-10")],
                               "site string, latitude double, longitude double, sample_date string")
    with pytest.raises(ValueError, match="n_days"):
        covspark.get_zonal_statistics(se, catalog, cells, "sst")
    zs = covspark.get_zonal_statistics(se, catalog, cells, "Sea surface temperature", n_days=3, radius=10)
    vals = sorted(x["value"] for x in zs.first()["zonal_statistics"])
    assert vals == [7.0, 8.0, 9.0]
    assert zs.first()["zonal_statistics"][0]["covariate"] == "Sea surface temperature"
    s = covspark.summarise_zonal_statistics(zs, "mean").first()["summary_zonal_statistics"][0]
    assert s["value"] == 8.0 and s["n_dates"] == 3


def test_job_errors(spark, catalog):
    se = spark.createDataFrame([(0.0, 0.0, "2020-01-01")], "latitude double, longitude double, sample_date string")
    with pytest.raises(ValueError, match="attach_covariate_data"):
        covspark.get_zonal_statistics(se, catalog, se, "gpw_realms")
    with pytest.raises(ValueError, match="multiple datasets"):
        covspark.get_zonal_statistics(se, catalog, se, "twin_a")
    with pytest.raises(ValueError, match="band"):
        covspark.get_zonal_statistics(se, catalog, se, "twin_a", dataset="b1")
    with pytest.raises(ValueError, match="no band"):
        covspark.get_zonal_statistics(se, catalog, se, "twin_a", dataset="b1", bands=[1, "blue"])
    with pytest.raises(ValueError, match="get_zonal_statistics"):
        covspark.attach_covariate_data(se, catalog, se, "sst")
    with pytest.raises(ValueError, match="no column"):
        covspark.attach_covariate_data(se, catalog, se, "gpw_realms", columns=["NOPE"])


def test_asset_type_rules(spark):
    df = spark.createDataFrame(
        [("a", "image/tiff; profile=cloud-optimized", "x.bin", "cog"),
         ("b", None, "X.TIF", "cog"), ("c", None, "xtif", None),
         ("d", "application/x-parquet", "x.tif", "cog"), ("e", None, "v.parquet", "parquet"),
         ("f", "text/plain", "readme.txt", None)],
        "dataset string, mime string, href string, expected string")
    got = df.select("expected", cat.asset_type(F.col("mime"), F.col("href")).alias("t")).collect()
    assert all(r["expected"] == r["t"] for r in got)


def test_enrich_equals_single_jobs(spark, catalog):
    cells = spark.createDataFrame(
        [("sst", d(2020, 1, 1) + dt.timedelta(days=i), 1, 0.5, 0.5, 0.5, float(i)) for i in range(400)],
        "covariate_id string, item_date date, band int, cy double, cx double, half_deg double, value double")
    se = spark.createDataFrame([("s1", 0.2, 0.2, "2020-01-10"), ("s2", 0.3, 0.3, "2020-02-01"),
                                ("s2", 0.3, 0.3, "2020-02-01")],
                               "site string, latitude double, longitude double, sample_date string")
    reqs = [{"name": "a", "covariate": "sst", "n_days": 3, "radius": 10},
            {"name": "b", "covariate": "Sea surface temperature", "n_days": 2, "radius": 10,
             "spatial_stats": ["max", "count"]}]
    out = covspark.enrich(se, catalog, cells, reqs)
    assert out.count() == 3
    staged = covspark.enrich(se, catalog, cells, reqs, materialize=True)
    assert sorted(map(str, staged.collect())) == sorted(map(str, out.collect()))
    assert set(out.columns) == set(se.columns) | {"zonal_statistics_a", "zonal_statistics_b"}
    one = covspark.get_zonal_statistics(se, catalog, cells, "sst", n_days=2, radius=10,
                                        spatial_stats=["max", "count"])

    def norm(df, col):
        return sorted((r["site"], r["sample_date"], tuple(tuple(x) for x in r[col])) for r in df.collect())

    assert norm(out, "zonal_statistics_b") == norm(one, "zonal_statistics")


def test_mixed_band_selection(spark, catalog):
    cells = spark.createDataFrame(
        [("twin_a", "b1", d(2010, 1, 1), b, 0.5, 0.5, 0.5, float(b)) for b in (1, 2, 3)],
        "covariate_id string, dataset string, item_date date, band int, cy double, cx double, "
        "half_deg double, value double")
    se = spark.createDataFrame([(0.2, 0.2, "2015-01-01")], "latitude double, longitude double, sample_date string")
    zs = covspark.get_zonal_statistics(se, catalog, cells, "twin_a", dataset="b1", bands=[1, "green"], radius=10)
    got = sorted((x["band"], x["band_name"], x["value"]) for x in zs.first()["zonal_statistics"])
    assert got == [(1.0, "red", 1.0), (2.0, "green", 2.0)]
    with pytest.raises(ValueError, match="repeated"):
        covspark.get_zonal_statistics(se, catalog, cells, "twin_a", dataset="b1", bands=[2, 2])
    with pytest.raises(ValueError, match="no band"):
        covspark.get_zonal_statistics(se, catalog, cells, "twin_a", dataset="b1", bands=[9999])


def test_vector_dataset_choice(spark, catalog):
    """Any existing Parquet dataset may be named; a second dataset makes naming needed."""
    assets = spark.createDataFrame(
        [("gpw_realms", n, m, f"{n}{x}", None, [{"name": "REALM"}, {"name": "AREA"}]) for n, m, x in
         (("data", "parquet", ".parquet"), ("boundaries", None, ".parquet"), ("cog", "image/tiff", ".tif"))],
        "covariate_id string, dataset string, mime string, href string, bands array<struct<name:string>>, columns array<struct<name:string>>")
    both = covspark.Catalog(catalog.collections, catalog.items, assets)
    ring = [[{"x": x, "y": y} for x, y in ((-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0))]]
    polygons = spark.createDataFrame([("gpw_realms", "boundaries", "r1", 2.0, "x", ring), ("gpw_realms", "data", "r2", 3.0, "x", ring)],
                                     "covariate_id string, dataset string, REALM string, AREA double, other string, "
                                     "rings array<array<struct<x:double,y:double>>>")
    se = spark.createDataFrame([(0.0, 0.0, "2020-01-01")], "latitude double, longitude double, sample_date string")
    got = covspark.attach_covariate_data(se, both, polygons, "gpw_realms", dataset="boundaries", columns=["REALM", "AREA"])
    assert got.columns == [*se.columns, "REALM", "AREA"] and [(r.REALM, r.AREA) for r in got.collect()] == [("r1", 2.0)]
    with pytest.raises(ValueError, match="multiple datasets"):
        covspark.attach_covariate_data(se, both, polygons, "gpw_realms")
    with pytest.raises(ValueError, match="no vector dataset 'cog'"):
        covspark.attach_covariate_data(se, both, polygons, "gpw_realms", dataset="cog")
    one = covspark.Catalog(catalog.collections, catalog.items, assets.where("dataset <> 'boundaries'"))
    with pytest.raises(ValueError, match="multiple datasets"):  # one Parquet dataset beside a raster
        covspark.attach_covariate_data(se, one, polygons, "gpw_realms")
    cap = covspark.covariate_helper(both, "gpw_realms").first()
    assert cap["column_options"] == "data:AREA, data:REALM" and not cap["raster_dataset_required"]


def test_band_named_twice_is_refused():
    from covspark.plans.covariates import resolve_bands
    rows = [{"band": 1, "name": "red"}, {"band": 2, "name": "green"}, {"band": 3, "name": "green"}]
    assert resolve_bands(rows, [1, "2"]) == ([1, 2], {1: "red", 2: "green"})
    with pytest.raises(ValueError, match="asked for twice"):
        resolve_bands(rows, [1, "red"])
    with pytest.raises(ValueError, match="shared by"):
        resolve_bands(rows, ["green"])
