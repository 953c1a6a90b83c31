"""Public jobs driven by the catalogue: the user names a covariate (id or
title) and the job resolves, validates and runs.

Validation reads only the small catalogue tables (one covariate's items and
first-item assets); it never scans events or cells.  The heavy work stays in
the lazy DataFrame returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covspark.operators import catalog as cat
from covspark.operators import temporal
from covspark.operators.zonal import check_stats
from covspark.plans.attach import attach_polygons
from covspark.plans.enrichment import enrich_long, enrich_wide
from covspark.plans.requests import check_requests, request_faults, resolved_requests
from covspark.plans.zonal_statistics import zonal_statistics


@dataclass
class Catalog:
    """The catalogue tables.

    collections: id, title, description, ... (``sources.catalog.COLLECTION``)
    items:       covariate_id, item_id, item_date
    assets:      covariate_id, [item_id], dataset, mime, href, bands, [columns]
                 (the assets of each covariate's first item)
    """
    collections: DataFrame
    items: DataFrame
    assets: DataFrame


def list_covariates(catalog: Catalog) -> DataFrame:
    return cat.list_covariates(catalog.collections)


def search_covariates(catalog: Catalog, title: str | None = None,
                      description: str | None = None) -> DataFrame:
    return cat.search_covariates(cat.list_covariates(catalog.collections), title, description)


def resolve_covariate(catalog: Catalog, covariate: str) -> tuple[str, str]:
    """(id, title) for an id or an exact title; errors when unknown or when a
    title names several covariates."""
    rows = (catalog.collections
            .where((F.col("id") == covariate) | (F.col("title") == covariate))
            .select("id", "title").distinct().collect())
    by_id = [r for r in rows if r["id"] == covariate]
    if by_id:
        return by_id[0]["id"], by_id[0]["title"]
    ids = sorted({r["id"] for r in rows})
    if not ids:
        raise ValueError(f"{covariate!r} is not a valid covariate: no id or title in the catalogue equals it "
                         "(see list_covariates)")
    if len(ids) > 1:
        raise ValueError(f"Title {covariate!r} is ambiguous: ids {', '.join(ids)}")
    return ids[0], covariate


def _assets_of(catalog: Catalog, covariate_id: str) -> DataFrame:
    a = catalog.assets.where(F.col("covariate_id") == covariate_id)
    if "item_id" in a.columns:
        first = temporal.first_item(catalog.items.where(F.col("covariate_id") == covariate_id))
        a = a.join(first.select("covariate_id", "item_id"), on=["covariate_id", "item_id"], how="left_semi")
    return a


def list_datasets_for_covariate(catalog: Catalog, covariate: str) -> DataFrame:
    cid, _ = resolve_covariate(catalog, covariate)
    return cat.dataset_bands(_assets_of(catalog, cid))


def covariate_helper(catalog: Catalog, covariate: str) -> DataFrame:
    """Type, job to use, dataset and band requirements of one covariate."""
    cid, _ = resolve_covariate(catalog, covariate)
    return cat.capabilities(_assets_of(catalog, cid))


def covariate_cadence(catalog: Catalog, covariate_id: str) -> str:
    n = catalog.items.where(F.col("covariate_id") == covariate_id).count()
    if n == 0:
        raise ValueError(f"covariate {covariate_id} has no items")
    return temporal.cadence_for_count(n)


def _typed_assets(assets: DataFrame) -> dict[str, set[str]]:
    """Dataset names by kind (cog / parquet) of one covariate's first item."""
    rows = cat.with_asset_type(assets).where(F.col("asset_type").isNotNull()).select("dataset", "asset_type").distinct().collect()
    out: dict[str, set[str]] = {"cog": set(), "parquet": set()}
    for r in rows:
        out[r["asset_type"]].add(r["dataset"])
    return out


def _named_dataset(dataset, own: set[str], kind: str) -> str:
    """A dataset the user named: one of all the assets of the kind."""
    if isinstance(dataset, (list, tuple)):
        raise ValueError(f"`dataset` takes one name, got {list(dataset)}")
    if dataset not in own:
        raise ValueError(f"no {kind} dataset {dataset!r}; the covariate has: {', '.join(sorted(own))}")
    return dataset


def _raster_dataset(assets: DataFrame, dataset) -> str:
    """The raster dataset to use: any existing one if named, else the one preferred."""
    typed = _typed_assets(assets)
    if not typed["cog"]:
        raise ValueError("no raster dataset here" + ("; attach_covariate_data takes its vector data" if typed["parquet"] else ""))
    if dataset is not None:
        return _named_dataset(dataset, typed["cog"], "raster")
    pref = sorted(r["dataset"] for r in cat.preferred_datasets(assets).where(F.col("kind") == "cog").collect())
    if len(pref) > 1:
        raise ValueError(f"the covariate has multiple datasets; name one in `dataset`: {', '.join(pref)}")
    return pref[0]


def _vector_dataset(assets: DataFrame, dataset) -> str:
    """The vector dataset to use: any existing one if named; it must be named as
    soon as the covariate has a second dataset of either kind."""
    typed = _typed_assets(assets)
    if not typed["parquet"]:
        raise ValueError("no vector dataset here" + ("; get_zonal_statistics takes its raster data" if typed["cog"] else ""))
    if dataset is not None:
        return _named_dataset(dataset, typed["parquet"], "vector")
    every = sorted(typed["cog"] | typed["parquet"])
    if len(every) > 1:
        raise ValueError(f"the covariate has multiple datasets; name one in `dataset`: {', '.join(every)}")
    return every[0]


def resolve_bands(band_rows: list, bands) -> tuple[list[int], dict | None]:
    """Band numbers and (if the bands are named) their labels.

    One band: requests must match it, and band 1 is used.  Several bands:
    a request is required; each must match a number or a name.
    """
    named = any(r["name"] is not None for r in band_rows)
    req = None if bands is None else [bands] if isinstance(bands, (str, int, float)) else list(bands)
    if req is not None and len({str(b) for b in req}) != len(req):
        raise ValueError(f"a band is repeated in {req}")

    def match(r):
        hits = [b for b in band_rows if str(b["band"]) == str(r).removesuffix(".0") or b["name"] == str(r)]
        if not hits:
            opts = ", ".join(f"{b['band']}" + (f" ({b['name']})" if b["name"] else "") for b in band_rows)
            raise ValueError(f"no band {r!r} here; the dataset offers {opts}")
        if len(hits) > 1:
            raise ValueError(f"the name {r!r} is shared by {len(hits)} bands; use their numbers")
        return hits[0]

    if len(band_rows) == 1:
        for r in req or []:
            match(r)
        return [1], None
    if req is None:
        raise ValueError(f"the dataset has {len(band_rows)} bands; list the band numbers or names to use in `bands`")
    chosen = [match(r) for r in req]
    numbers = [int(b["band"]) for b in chosen]
    if len(set(numbers)) != len(numbers):
        raise ValueError(f"one band is asked for twice in {req}, by number and by name")
    labels = {int(b["band"]): b["name"] for b in chosen} if named else None
    return numbers, labels


def get_zonal_statistics(se: DataFrame, catalog: Catalog, cells: DataFrame, covariate: str, *,
                         spatial_stats=("mean",), radius: float = 100.0, n_days: int | None = None,
                         dataset: str | None = None, bands=None, date_col: str = "sample_date",
                         approx_stats: bool = False, cadence: str | None = None,
                         cell_deg: float = 0.0) -> DataFrame:
    """Zonal statistics of a raster covariate for every sample event.

    ``cells`` holds the raster cells (covariate_id, [dataset], item_date, band,
    cx, cy, half size, value).  Cadence comes from the item count unless given;
    ``check`` cadence must be given explicitly.
    """
    spec = _zonal_spec(catalog, covariate, dict(
        spatial_stats=spatial_stats, radius=radius, n_days=n_days, dataset=dataset, bands=bands,
        approx_stats=approx_stats, cadence=cadence, cell_deg=cell_deg))
    c = spec.pop("cells_filter")(cells)
    return zonal_statistics(se, catalog.items, c, date_col=date_col, **spec)


def _zonal_spec(catalog: Catalog, covariate: str, args: dict) -> dict:
    """Resolve and validate one request against the catalogue; returns the
    keyword arguments of ``zonal_statistics`` plus a cells filter."""
    spatial_stats = args.get("spatial_stats", ("mean",))
    radius = args.get("radius", 100.0)
    if radius > 0 and not spatial_stats:
        raise ValueError(f"a radius of {radius} needs at least one statistic in `spatial_stats`")
    spatial_stats = check_stats(spatial_stats or ["mean"])
    n_days = args.get("n_days")
    dataset = args.get("dataset")
    bands = args.get("bands")
    cadence = args.get("cadence")
    cid, title = resolve_covariate(catalog, covariate)
    assets = _assets_of(catalog, cid)
    ds = _raster_dataset(assets, dataset)
    band_rows = (cat.dataset_bands(assets.where(F.col("dataset") == ds))
                 .select("band", "name").orderBy("band").collect())
    band_numbers, labels = resolve_bands(band_rows, bands)
    cad = cadence or covariate_cadence(catalog, cid)
    if cad == "check":
        raise ValueError("the item count leaves the cadence open; say cadence='periodic' or cadence='daily'")
    if cad == "daily" and not n_days:
        raise ValueError("a daily covariate needs `n_days`, the length of its window")
    def cells_filter(c: DataFrame) -> DataFrame:
        return c.where(F.col("dataset") == ds) if "dataset" in c.columns else c

    return dict(covariate_id=cid, cadence=cad, covariate=title, spatial_stats=spatial_stats,
                radius=radius, n_days=n_days, bands=band_numbers, band_names=labels,
                approx_stats=args.get("approx_stats", False), cell_deg=args.get("cell_deg", 0.0),
                cells_filter=cells_filter)


def attach_covariate_data(se: DataFrame, catalog: Catalog, polygons: DataFrame, covariate: str, *,
                          dataset: str | None = None, columns=None,
                          date_col: str | None = "sample_date") -> DataFrame:
    """Attach the attributes of the vector covariate's polygons containing
    each event.  Not date dependent: the first item's layer is used."""
    cid, _ = resolve_covariate(catalog, covariate)
    assets = _assets_of(catalog, cid)
    ds = _vector_dataset(assets, dataset)
    if columns is not None:
        listed = [r["name"] for r in cat.dataset_bands(assets.where(F.col("dataset") == ds)).collect()
                  if r["name"] is not None]
        cols = [columns] if isinstance(columns, str) else list(columns)
        bad = [x for x in cols if listed and x not in listed]
        if bad:
            raise ValueError(f"the layer has no column {', '.join(bad)}; it has: {', '.join(listed)}")
    p = polygons
    if "covariate_id" in p.columns:
        p = p.where(F.col("covariate_id") == cid).drop("covariate_id")
    if "dataset" in p.columns:
        p = p.where(F.col("dataset") == ds).drop("dataset")
    return attach_polygons(se, p, columns)


def validate_requests(catalog: Catalog, requests: DataFrame) -> DataFrame:
    """The faults of a table of requests (``plans.requests.COLUMNS``), found in one job: (request, kind, detail)."""
    return request_faults(check_requests(catalog.collections, catalog.items, catalog.assets, requests))


def enrich(se: DataFrame, catalog: Catalog, cells: DataFrame, requests: list[dict],
           date_col: str = "sample_date", long: bool = False, materialize: bool = False) -> DataFrame:
    """Several covariates in one lazy job, whatever their cadences.  Each request holds the keyword
    arguments of ``get_zonal_statistics`` plus ``name``; it adds the column ``zonal_statistics_<name>``,
    or, with ``long``, one row per event (columns ``request`` and ``zonal_statistics``).

    The requests are resolved and checked as one table; all of them share one match, one spatial join and one
    aggregate (``plans.enrichment``), and the wide event rows are joined once.
    """
    if not requests:
        raise ValueError("requests must not be empty")
    run = enrich_long if long else enrich_wide
    asked = resolved_requests(catalog, requests, se.sparkSession)
    return run(se, asked, catalog.items, cells, date_col=date_col, materialize=materialize)
