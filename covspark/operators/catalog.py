"""Catalogue operators: covariates, datasets (assets), bands, capabilities.

The catalogue is metadata (collections, items, assets).  Every operator is a
DataFrame job, so the same code serves one covariate or a whole catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values that decide asset types and dataset preference.
COG_MIME_PATTERNS = ["profile=cloud-optimized", "image/tiff", "application/geotiff",
                     "image/tiff; application=geotiff"]
COG_EXTENSIONS = [".tif", ".tiff"]
PARQUET_MIME_PATTERNS = ["parquet", "application/x-parquet", "application/vnd.apache.parquet"]
PARQUET_EXTENSIONS = [".parquet"]
COMMON_COG_NAMES = ["data", "Cloud Optimized GeoTIFF", "cog", "image"]
COMMON_PARQUET_NAMES = ["data", "parquet", "geoparquet", "vector"]
LAST_TITLE_PREFIX = "GPW"
FUNCTION_FOR_TYPE = {
    "raster": "zonal_statistics",
    "vector": "attach_covariate_data",
    "raster + vector": "zonal_statistics or attach_covariate_data, depending on the dataset",
}


# ------------------------------------------------------------ collections

def keywords_text(keywords: Column) -> Column:
    """Sorted keywords joined with ", "; none -> NULL."""
    return F.when(F.size(keywords) > 0, F.array_join(F.array_sort(keywords), ", "))


def temporal_extent(extent: Column):
    """(start_date, end_date) of the first temporal interval; open end -> NULL."""
    first = F.get(extent["temporal"]["interval"], 0)
    return (F.to_date(F.substring(F.get(first, 0), 1, 10)).alias("start_date"),
            F.to_date(F.substring(F.get(first, 1), 1, 10)).alias("end_date"))


def provider_label(providers: Column) -> Column:
    """"name (role)" for every provider and role, sorted and joined; a
    provider without roles shows its name alone; no providers -> NULL."""
    texts = F.flatten(F.transform(providers, lambda p: F.when(
        F.size(F.coalesce(p["roles"], F.array().cast("array<string>"))) > 0,
        F.transform(p["roles"], lambda r: F.concat(p["name"], F.lit(" ("), r, F.lit(")"))))
        .otherwise(F.array(p["name"]))))
    return F.when(F.size(texts) > 0, F.array_join(F.array_sort(texts), ", "))


def date_range_label(start: Column, end: Column) -> Column:
    return F.concat(start.cast("string"), F.lit(" - "), F.coalesce(end.cast("string"), F.lit("")))


def list_covariates(collections: DataFrame) -> DataFrame:
    """One row per covariate: title, description, start/end date, license,
    sci:doi, keywords text, providers, sci:citation, bbox, id; titles
    starting with GPW last, then by title (binary order)."""
    start, end = temporal_extent(F.col("extent"))
    out = collections.select(
        "title", "description", start, end, "license", F.col("`sci:doi`"),
        keywords_text(F.col("keywords")).alias("keywords"), "providers",
        F.col("`sci:citation`"), F.col("extent.spatial.bbox").alias("bbox"), "id")
    return out.orderBy(F.col("title").startswith(LAST_TITLE_PREFIX), F.col("title"))


def catalogue_positions(collections: DataFrame) -> DataFrame:
    """(id, title, position): each covariate's place in the catalogue's order, from 1, as a column that survives joins
    and writes; equal titles by id.  The catalogue is ranked in one task: a row per covariate."""
    order = Window.orderBy(F.col("title").startswith(LAST_TITLE_PREFIX), "title", "id")
    return collections.select("id", "title").withColumn("position", F.row_number().over(order))


def search_covariates(covariates: DataFrame, title: str | None = None,
                      description: str | None = None) -> DataFrame:
    """Case-insensitive regex search, AND-ed; no terms -> the listing itself.
    A NULL description never matches."""
    out = covariates
    if title is not None:
        out = out.where(F.coalesce(F.col("title").rlike(f"(?i){title}"), F.lit(False)))
    if description is not None:
        out = out.where(F.coalesce(F.col("description").rlike(f"(?i){description}"), F.lit(False)))
    return out


def providers_table(collections: DataFrame) -> DataFrame:
    """One row per (covariate, provider, role); none -> NULLs kept."""
    p = collections.select("id", F.explode_outer("providers").alias("p"))
    return p.select("id", F.col("p.name").alias("provider"),
                    F.explode_outer("p.roles").alias("role"))


def resolve(requests: DataFrame, collections: DataFrame, col: str = "covariate") -> DataFrame:
    """Resolve each request (an id or a title) to a covariate id.

    An id match wins; otherwise an exact title match.  Adds ``covariate_id``,
    ``title`` and ``match`` (id / title / ambiguous / none); ambiguous and
    unmatched requests keep a NULL id so the caller can report them.
    """
    # one row per id, whatever number of titles it carries
    ids = collections.groupBy(F.col("id").alias("_id")).agg(F.min("title").alias("_id_title"))
    titles = (collections.groupBy(F.col("title").alias("_t"))
              .agg(F.count_distinct("id").alias("_n"), F.min("id").alias("_tid")))
    r = requests.join(ids, requests[col] == ids["_id"], "left")
    r = r.join(titles, r[col] == titles["_t"], "left")
    match = (F.when(F.col("_id").isNotNull(), F.lit("id"))
             .when(F.col("_n") == 1, F.lit("title"))
             .when(F.col("_n") > 1, F.lit("ambiguous"))
             .otherwise(F.lit("none")))
    r = r.withColumn("match", match)
    r = r.withColumn("covariate_id", F.when(F.col("match") == "id", F.col("_id"))
                     .when(F.col("match") == "title", F.col("_tid")))
    r = r.withColumn("title", F.when(F.col("match") == "id", F.col("_id_title"))
                     .when(F.col("match") == "title", F.col(col)))
    return r.drop("_id", "_id_title", "_t", "_n", "_tid")


# ----------------------------------------------------------------- assets

def _any_contains(s: Column, patterns: list[str]) -> Column:
    cond = F.lit(False)
    for p in patterns:
        cond = cond | F.coalesce(s.contains(p), F.lit(False))
    return cond


def _any_suffix(href: Column, suffixes: list[str]) -> Column:
    h = F.lower(href)
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | F.coalesce(h.endswith(s), F.lit(False))
    return cond


def is_cog(mime: Column, href: Column) -> Column:
    return _any_contains(mime, COG_MIME_PATTERNS) | _any_suffix(href, COG_EXTENSIONS)


def is_parquet(mime: Column, href: Column) -> Column:
    return _any_contains(mime, PARQUET_MIME_PATTERNS) | _any_suffix(href, PARQUET_EXTENSIONS)


def asset_type(mime: Column, href: Column) -> Column:
    """cog / parquet / NULL; cog wins when both match."""
    return (F.when(is_cog(mime, href), F.lit("cog"))
            .when(is_parquet(mime, href), F.lit("parquet")))


def with_asset_type(assets: DataFrame) -> DataFrame:
    return assets.withColumn("asset_type", asset_type(F.col("mime"), F.col("href")))


def preferred_datasets(assets: DataFrame, key: str = "covariate_id") -> DataFrame:
    """(covariate, kind, dataset) of the datasets a job would use.

    Per kind (cog, parquet): the matching assets with a common name if any,
    otherwise every matching asset.  The window spans one item's assets.
    """
    kinds = F.array(
        F.when(is_cog(F.col("mime"), F.col("href")), F.lit("cog")),
        F.when(is_parquet(F.col("mime"), F.col("href")), F.lit("parquet")))
    a = assets.select(key, "dataset", F.explode(F.array_compact(kinds)).alias("kind"))
    common = (F.when(F.col("kind") == "cog", F.col("dataset").isin(COMMON_COG_NAMES))
              .otherwise(F.col("dataset").isin(COMMON_PARQUET_NAMES)))
    a = a.withColumn("_common", common)
    a = a.withColumn("_any", F.max("_common").over(Window.partitionBy(key, "kind")))
    return a.where(F.col("_common") | ~F.col("_any")).select(key, "kind", "dataset")


def covariate_types(assets: DataFrame, key: str = "covariate_id") -> DataFrame:
    """raster / vector / raster + vector / unknown per covariate."""
    a = assets.groupBy(key).agg(
        F.max(is_cog(F.col("mime"), F.col("href"))).alias("_r"),
        F.max(is_parquet(F.col("mime"), F.col("href"))).alias("_v"))
    t = (F.when(F.col("_r") & F.col("_v"), F.lit("raster + vector"))
         .when(F.col("_r"), F.lit("raster")).when(F.col("_v"), F.lit("vector"))
         .otherwise(F.lit("unknown")))
    return a.select(key, t.alias("type"))


def dataset_bands(assets: DataFrame, key: str = "covariate_id") -> DataFrame:
    """Long listing of bands (cog) or columns (parquet) per dataset.

    Bands are numbered from 1; a dataset without band/column metadata lists
    one band 1 with a NULL name; parquet columns have no band number;
    assets of neither type are dropped.  ``bands`` / ``columns`` are
    ARRAY<STRUCT<name>> (either may be absent from the table).
    """
    a = with_asset_type(assets).where(F.col("asset_type").isNotNull())
    empty = F.lit(None).cast("array<struct<name:string>>")
    bands = F.col("bands") if "bands" in a.columns else empty
    cols = F.col("columns") if "columns" in a.columns else empty
    meta = F.when(F.col("asset_type") == "cog", bands).otherwise(cols)
    a = a.withColumn("_meta", F.coalesce(meta, F.array(F.struct(F.lit(None).cast("string").alias("name")))))
    a = a.withColumn("_none", meta.isNull())
    a = a.select(key, "dataset", "asset_type", "_none", F.posexplode("_meta").alias("_pos", "_b"))
    band = F.when((F.col("asset_type") == "cog") | F.col("_none"), F.col("_pos") + 1)
    return a.select(key, "dataset", "asset_type", band.cast("int").alias("band"),
                    F.col("_b.name").alias("name"))


def select_bands(bands: DataFrame, requested: list, key=("covariate_id", "dataset")) -> DataFrame:
    """Bands matching the request list by number or by name (mixed allowed).

    Adds ``requested`` and, per dataset, ``all_matched`` telling whether
    every request found a band of its own (the job stops when one found none,
    or when two name the same band, one by number and one by name).
    """
    req = [str(r) for r in requested]
    if len(set(req)) != len(req):
        raise ValueError("bands must not repeat")
    keys = list(key)
    rq = F.array(*[F.lit(r) for r in req])
    b = bands.withColumn("requested", F.explode(F.filter(
        rq, lambda r: (F.col("band").cast("string") == r) | F.coalesce(F.col("name") == r, F.lit(False)))))
    matched = b.groupBy(*keys).agg(F.count_distinct("requested").alias("_m"), F.count_distinct("band").alias("_b"))
    b = b.join(matched, on=keys).withColumn("all_matched", (F.col("_m") == len(req)) & (F.col("_b") == len(req))).drop("_m", "_b")
    return b


def capabilities(assets: DataFrame, key: str = "covariate_id") -> DataFrame:
    """Per covariate: type, the job to use, whether a raster or a vector dataset
    must be named (a flag per kind), whether bands must be, and the options:
    datasets, bands (dataset:number[=name]) and columns (dataset:name), sorted
    and comma separated."""
    types = covariate_types(assets, key)
    pref = preferred_datasets(assets, key)
    listed = dataset_bands(assets, key)
    option = F.concat("dataset", F.lit(":"), F.when(F.col("asset_type") == "cog", F.concat_ws("=", F.col("band").cast("string"), "name"))
                      .otherwise(F.col("name")))
    options = (listed.join(pref, on=[key, "dataset"]).where((F.col("kind") == F.col("asset_type")) & option.isNotNull())
               .groupBy(key).agg(*[F.array_join(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, option))), ", ").alias(name)
                                   for kind, name in (("cog", "band_options"), ("parquet", "column_options"))]))
    nb = (listed.where(F.col("asset_type") == "cog")
          .groupBy(key, "dataset").agg(F.count(F.lit(1)).alias("_nb")))
    rast = (pref.where(F.col("kind") == "cog").join(nb, on=[key, "dataset"], how="left")
            .groupBy(key).agg(F.count(F.lit(1)).alias("n_raster_datasets"),
                              F.max(F.col("_nb") > 1).alias("band_required"),
                              F.array_join(F.array_sort(F.collect_list("dataset")), ", ").alias("raster_datasets")))
    vect = (pref.where(F.col("kind") == "parquet").groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_vector_datasets"),
                 F.array_join(F.array_sort(F.collect_list("dataset")), ", ").alias("vector_datasets")))
    fn = F.create_map(*[x for k, v in FUNCTION_FOR_TYPE.items() for x in (F.lit(k), F.lit(v))])
    out = types.join(rast, on=key, how="left").join(vect, on=key, how="left").join(options, on=key, how="left")
    several = lambda n: F.coalesce(n, F.lit(0)) > 1
    return out.select(
        key, "type", F.element_at(fn, F.col("type")).alias("function"),
        F.coalesce("n_raster_datasets", F.lit(0)).cast("bigint").alias("n_raster_datasets"),
        F.coalesce("n_vector_datasets", F.lit(0)).cast("bigint").alias("n_vector_datasets"),
        (several("n_raster_datasets") | several("n_vector_datasets")).alias("dataset_required"),
        several("n_raster_datasets").alias("raster_dataset_required"),
        several("n_vector_datasets").alias("vector_dataset_required"),
        F.coalesce("band_required", F.lit(False)).alias("band_required"),
        "raster_datasets", "vector_datasets",
        F.coalesce("band_options", F.lit("")).alias("band_options"), F.coalesce("column_options", F.lit("")).alias("column_options"))
