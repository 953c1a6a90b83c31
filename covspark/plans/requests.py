"""Requests as a table, resolved and checked against the catalogue in one job.

``check_requests`` gives every request of a table with what it resolves to and its faults.  All checks are joins of the
requests with catalogue tables (collections, item counts, the assets and bands of each covariate's first item), so their
number doesn't grow with the requests, and neither events nor cells are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covspark.operators import catalog as cat
from covspark.operators import temporal
from covspark.operators.zonal import SPATIAL_STATS
from covspark.plans.enrichment import Request

# A request: its name, what it asks for, and how.  Only request and covariate are needed.
COLUMNS = ("request string, covariate string, dataset string, bands array<string>, radius double, n_days int, "
           "spatial_stats array<string>, cadence string, cell_deg double")
CADENCES = ("once", "periodic", "daily")


def requests_table(spark: SparkSession, requests: list[dict]) -> DataFrame:
    """The request table of a list of keyword dictionaries (``name`` stands for ``request``)."""
    listed = lambda x: None if x is None else [x] if isinstance(x, (str, int, float)) else list(x)
    text = lambda b: str(int(b)) if isinstance(b, float) and b.is_integer() else str(b)
    rows = []
    for k, r in enumerate(requests):
        unknown = set(r) - {"name", "covariate", "dataset", "bands", "radius", "n_days", "spatial_stats", "cadence", "cell_deg"}
        if unknown:
            raise ValueError(f"request {k} has unknown fields {sorted(unknown)}")
        bands, stats = listed(r.get("bands")), listed(r.get("spatial_stats", ["mean"]))
        rows.append((str(r["name"]) if r.get("name") else str(k), r["covariate"], r.get("dataset"), None if bands is None else [text(b) for b in bands],
                     float(r.get("radius", 100.0)), r.get("n_days"), stats or [], r.get("cadence"), float(r.get("cell_deg") or 0.0)))
    return spark.createDataFrame(rows, COLUMNS)


def check_requests(collections: DataFrame, items: DataFrame, assets: DataFrame, requests: DataFrame, few: bool = False) -> DataFrame:
    """Every request with what it resolves to and its ``faults`` ARRAY<STRUCT<kind, detail>>: request, covariate_id, title,
    dataset, cadence, radius, n_days, spatial_stats, cell_deg and bands ARRAY<STRUCT<band, name>> in the order asked for (names
    NULL where the dataset names none or has one band).  A request with a fault is incomplete.

    ``few``: the caller has written the requests down, so the covariates they name are broadcast, and items and assets of others
    go before any shuffle.  One pass: the request rows meet collections, item counts, datasets and bands in a fixed chain of joins, and all
    faults are expressions over the joined row."""
    r = cat.resolve(requests, collections).withColumn("_same", F.count("*").over(Window.partitionBy("request")))
    wanted = r.where(F.col("covariate_id").isNotNull()).select("covariate_id").distinct()
    if few:
        wanted, assets = F.broadcast(wanted), assets.join(F.broadcast(wanted), "covariate_id", "left_semi")

    # cadence: one count of items per covariate; datasets and bands: of the first item's assets
    there = items.join(wanted, "covariate_id", "left_semi")
    counts = there.groupBy("covariate_id").agg(F.count("*").alias("n_items"), F.max(F.struct("item_date", "item_id"))["item_id"].alias("_first"))
    first = assets.join(counts.select("covariate_id", "_first"), "covariate_id")
    first = first.where(F.col("item_id") == F.col("_first")) if "item_id" in assets.columns else first
    preferred = cat.preferred_datasets(first).where("kind = 'cog'").select("covariate_id", "dataset", F.lit(True).alias("_preferred"))
    sets = (cat.dataset_bands(first).where("asset_type = 'cog'").groupBy("covariate_id", "dataset")
            .agg(F.array_sort(F.collect_set(F.struct("band", "name"))).alias("bands")).join(preferred, ["covariate_id", "dataset"], "left")
            .groupBy("covariate_id").agg(F.array_sort(F.collect_list(F.struct("dataset", "bands", F.coalesce("_preferred", F.lit(False)).alias("preferred")))).alias("_sets")))
    r = r.withColumnsRenamed({"cadence": "_cadence", "dataset": "_dataset", "bands": "_bands"})
    r = r.join(counts.drop("_first"), "covariate_id", "left").join(sets, "covariate_id", "left")
    r = r.withColumn("cadence", F.coalesce("_cadence", temporal.cadence_expr(F.col("n_items"))))

    # dataset: the one named, else the only preferred one; bands: by number or name
    asked = F.col("_dataset").isNotNull()
    fit = F.filter("_sets", lambda x: F.when(asked, x["dataset"] == F.col("_dataset")).otherwise(x["preferred"]))
    r = r.withColumn("_fit", fit).withColumn("_set", F.when(F.size("_fit") == 1, F.get("_fit", F.lit(0))))
    hits = lambda q: F.filter(F.col("_set.bands"), lambda b: (b["band"].cast("string") == q) | F.coalesce(b["name"] == q, F.lit(False)))
    r = r.withColumn("_hits", F.transform("_bands", lambda q: F.struct(q.alias("q"), hits(q).alias("h"))))
    chosen = F.transform("_hits", lambda x: F.get(x["h"], F.lit(0)))
    r = r.withColumn("_chosen", chosen)
    one, several = F.size("_set.bands") == 1, F.size("_set.bands") > 1
    unnamed = lambda b: F.struct(b["band"].alias("band"), F.lit(None).cast("string").alias("name"))
    bands = (F.when(one, F.array(F.struct(F.lit(1).alias("band"), F.lit(None).cast("string").alias("name"))))
             .when(F.exists("_set.bands", lambda b: b["name"].isNotNull()), F.col("_chosen")).otherwise(F.transform("_chosen", unnamed)))

    known, repeated = F.col("covariate_id").isNotNull(), F.size(F.array_distinct("_bands")) < F.size("_bands")
    numbers = F.transform("_chosen", lambda b: b["band"])
    fault = lambda kind, detail=F.lit(None): F.struct(F.lit(kind).alias("kind"), detail.cast("string").alias("detail"))
    tests = [
        (F.col("_same") > 1, fault("repeated request")),
        (F.col("match") == "none", fault("unknown covariate", F.col("covariate"))),
        (F.col("match") == "ambiguous", fault("title of several covariates", F.col("covariate"))),
        (F.col("radius") < 0, fault("negative radius", F.col("radius"))),
        ((F.size("spatial_stats") == 0) & (F.col("radius") > 0), fault("no statistic", F.col("radius"))),
        (F.size(F.array_distinct("spatial_stats")) < F.size("spatial_stats"), fault("repeated statistic", F.array_join("spatial_stats", ", "))),
        (~F.col("_cadence").isin(*CADENCES), fault("unknown cadence", F.col("_cadence"))),
        (known & F.col("n_items").isNull(), fault("no items", F.col("covariate_id"))),
        (F.col("cadence") == "check", fault("cadence left open by the item count", F.col("n_items"))),
        (known & (F.col("cadence") == "daily") & (F.coalesce("n_days", F.lit(0)) < 1), fault("n_days needed", F.col("covariate_id"))),
        (known & F.col("_sets").isNull(), fault("no raster dataset", F.col("covariate_id"))),
        (asked & (F.size("_fit") == 0), fault("unknown dataset", F.col("_dataset"))),
        (~asked & (F.size("_fit") > 1), fault("dataset to be named", F.array_join(F.transform("_fit", lambda x: x["dataset"]), ", "))),
        (several & F.coalesce(F.size("_bands") < 1, F.lit(True)), fault("bands to be listed", F.size("_set.bands"))),
        (F.col("_set").isNotNull() & repeated, fault("repeated band", F.array_join("_bands", ", "))),
        (several & ~repeated & F.forall("_hits", lambda x: F.size(x["h"]) == 1) & (F.size(F.array_distinct(numbers)) < F.size(numbers)),
         fault("band named twice", F.array_join("_bands", ", "))),
    ]
    of_bands = lambda kind, test: F.transform(F.filter("_hits", test), lambda x: fault(kind, x["q"]))
    bad_bands = F.when(F.col("_set").isNotNull(), F.concat(of_bands("unknown band", lambda x: F.size(x["h"]) == 0),
                                                           of_bands("name of several bands", lambda x: F.size(x["h"]) > 1)))
    bad_stats = F.transform(F.filter("spatial_stats", lambda x: ~x.isin(*SPATIAL_STATS)), lambda x: fault("unknown statistic", x))
    none = F.array().cast("array<struct<kind:string,detail:string>>")
    faults = F.concat(F.array_compact(F.array(*[F.when(test, what) for test, what in tests])), F.coalesce(bad_bands, none), F.coalesce(bad_stats, none))
    return r.select("request", "covariate_id", "title", F.col("_set.dataset").alias("dataset"), "cadence", bands.alias("bands"), "radius", "n_days",
                    "spatial_stats", "cell_deg", faults.alias("faults"))


def request_faults(checked: DataFrame) -> DataFrame:
    """(request, kind, detail): a row per fault."""
    return checked.select("request", F.inline("faults"))


def resolved_requests(catalog, requests: list[dict], spark: SparkSession) -> list[Request]:
    """The requests to run, in the order given; all faults of all requests as one error."""
    rows = check_requests(catalog.collections, catalog.items, catalog.assets, requests_table(spark, requests), few=True).collect()  # a row per request
    bad = sorted({f"{x.request}: {f.kind}" + (f" {f.detail}" if f.detail is not None else "") for x in rows for f in x.faults})
    if bad:
        raise ValueError("invalid requests - " + "; ".join(bad))
    spec = {x.request: x for x in rows}
    names = [str(r["name"]) if r.get("name") else str(k) for k, r in enumerate(requests)]
    return [Request(x.covariate_id, x.cadence, {b.band: b.name for b in x.bands}, title=x.title, stats=list(x.spatial_stats) or ["mean"],
                    radius=x.radius, n_days=x.n_days, dataset=x.dataset, cell_deg=x.cell_deg or 0.0, name=n) for n in names for x in [spec[n]]]
