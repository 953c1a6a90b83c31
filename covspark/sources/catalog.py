"""Catalogue sources: STAC JSON snapshots read as DataFrames.

A catalogue snapshot is a set of JSON documents (a ``{"collections": [...]}``
listing and item FeatureCollections).  Jobs never call a web service per
row; the snapshot is read once, with explicit schemas, like any table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, MapType, StringType, StructField,
                               StructType)

from covspark.functions.geo import morton
from covspark.operators.spatial import coarse_tile, in_z_ranges, z_codes, z_place, z_ranges, z_tiles

# Ranges of the curve that are tested row by row: so few that the test is compiled.
PRUNING_RANGES = 24

NAMED = ArrayType(StructType([StructField("name", StringType())]))

PROVIDER = StructType([StructField("name", StringType()), StructField("roles", ArrayType(StringType())),
                       StructField("url", StringType())])

COLLECTION = StructType([
    StructField("id", StringType()),
    StructField("title", StringType()),
    StructField("description", StringType()),
    StructField("license", StringType()),
    StructField("sci:doi", StringType()),
    StructField("sci:citation", StringType()),
    StructField("keywords", ArrayType(StringType())),
    StructField("providers", ArrayType(PROVIDER)),
    StructField("extent", StructType([
        StructField("spatial", StructType([StructField("bbox", ArrayType(ArrayType(DoubleType())))])),
        StructField("temporal", StructType([StructField("interval", ArrayType(ArrayType(StringType())))])),
    ])),
])

ASSET = StructType([
    StructField("href", StringType()),
    StructField("type", StringType()),
    StructField("raster:bands", NAMED),
    StructField("table:columns", NAMED),
])

ITEM = StructType([
    StructField("id", StringType()),
    StructField("collection", StringType()),
    StructField("properties", StructType([StructField("datetime", StringType()),
                                          StructField("end_datetime", StringType())])),
    StructField("assets", MapType(StringType(), ASSET)),
])


def read_collections(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Collections from ``{"collections": [...]}`` documents, one per file or, with ``lines``, one per line."""
    doc = StructType([StructField("collections", ArrayType(COLLECTION))])
    raw = spark.read.schema(doc).option("multiLine", not lines).json(path)
    return raw.select(F.explode("collections").alias("c")).select("c.*")


def read_items(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Items from FeatureCollection documents, one per file or line: covariate_id, item_id,
    item_date (``datetime``, else ``end_datetime``, cut to a date), assets."""
    doc = StructType([StructField("features", ArrayType(ITEM))])
    raw = spark.read.schema(doc).option("multiLine", not lines).json(path)
    f = raw.select(F.explode("features").alias("f")).select("f.*")
    dt = F.coalesce(F.col("properties.datetime"), F.col("properties.end_datetime"))
    return f.select(
        F.col("collection").alias("covariate_id"), F.col("id").alias("item_id"),
        F.to_date(F.substring(dt, 1, 10)).alias("item_date"),
        F.col("properties.datetime").alias("datetime"), "assets")


def explode_assets(items: DataFrame) -> DataFrame:
    """One row per (item, dataset): mime, href, bands, columns."""
    a = items.select("covariate_id", "item_id", F.explode("assets").alias("dataset", "a"))
    return a.select("covariate_id", "item_id", "dataset", F.col("a.type").alias("mime"),
                    F.col("a.href").alias("href"), F.col("a.`raster:bands`").alias("bands"),
                    F.col("a.`table:columns`").alias("columns"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Cells, polygons or sample events stored as Parquet (pruning and
    pushdown come from the Parquet scan)."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """Persist a result (the reference saves results to disk and reads them
    back); Parquet, optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_cell_store(cells: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write raster cells laid out for the zonal job: one folder per
    (covariate_id, item_date, coarse_tile), so the job's semi-joins on the date
    and on the coarse tiles of its discs prune whole folders (dynamic partition
    pruning), and rows sorted by band and latitude/longitude inside each file.
    A task writes one coarse tile of one edition, not a whole edition."""
    (cells.withColumn("coarse_tile", coarse_tile(F.col("cy"), F.col("cx")))
     .repartition("covariate_id", "item_date", "coarse_tile")
     .sortWithinPartitions("covariate_id", "item_date", "coarse_tile", "band", "cy", "cx")
     .write.mode(mode).partitionBy("covariate_id", "item_date", "coarse_tile").parquet(path))


def write_curve_store(cells: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write raster cells in Z-order: folders of (covariate_id, item_month), files and row groups each a stretch of the
    curve, so the least and greatest ``zkey`` that Parquet keeps for them bound a small area.  For rasters of which an
    edition is too small to fill folders of its own."""
    placed = cells.withColumn("item_month", F.trunc("item_date", "month")).withColumns(z_place(F.col("cy"), F.col("cx")))
    (placed.withColumn("zkey", morton(F.col("_zx"), F.col("_zy"))).drop("_zx", "_zy")
     .repartitionByRange("covariate_id", "item_month", "zkey").sortWithinPartitions("covariate_id", "item_month", "zkey", "item_date", "band")
     .write.mode(mode).partitionBy("covariate_id", "item_month").parquet(path))


def read_curve_store(spark: SparkSession, path: str, places: DataFrame | None = None, radius_m: float = 0.0, cell_deg: float = 0.0,
                     lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Cells of a Z-order store; with ``places``, only the stretches of the curve that their discs touch (one job over the
    places' tiles).  A few ranges round them are filters that Parquet tests against each file's and row group's bounds; the
    rows that are left are looked up in a table of the stretches, not compared with each."""
    cells = spark.read.parquet(path)
    if places is None:
        return cells
    codes = z_codes(z_tiles(places, lat, lon, radius_m, cell_deg))
    near = F.lit(False)
    for lo, hi in z_ranges(codes, PRUNING_RANGES):
        near = near | F.col("zkey").between(lo, hi)
    return cells.where(near).where(in_z_ranges(F.col("zkey"), z_ranges(codes)))
