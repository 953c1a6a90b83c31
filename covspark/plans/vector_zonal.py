"""Zonal statistics of a vector covariate: statistics of numeric polygon
attributes over the polygons that touch the disc round each event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covspark.operators.reshape import missing_rows, nest
from covspark.operators.spatial import polygons_in_radius
from covspark.operators.zonal import check_stats, stats_long, zonal_aggregate

_K = ["_lat", "_lon"]


def vector_zonal_statistics(se: DataFrame, polygons: DataFrame, columns, *,
                            spatial_stats=("mean",), radius: float = 100.0,
                            covariate: str = "vector", round_digits: int = 5,
                            tile_deg: float | None = None, output_col: str = "zonal_statistics") -> DataFrame:
    """Add ``output_col``: ARRAY<STRUCT<covariate, column, spatial_stat, value>>
    with one element per requested column and statistic (NULL value when no
    polygon touches the disc).

    Runs once per distinct location; ``area`` is not defined for attributes.
    """
    stats = check_stats(spatial_stats)
    if "area" in stats or "freq_hist" in stats:
        raise ValueError("area and freq_hist are raster-only statistics")
    columns = [columns] if isinstance(columns, str) else list(columns)
    ev = (se.withColumn("_lat", F.bround(F.col("latitude").cast("double"), round_digits))
          .withColumn("_lon", F.bround(F.col("longitude").cast("double"), round_digits)))
    pts = ev.select(*_K).distinct()
    pairs = polygons_in_radius(pts, polygons.select(*columns, "rings"), float(radius),
                               lat="_lat", lon="_lon", tile_deg=tile_deg)
    vals = pairs.select(*_K, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        _K, columns, "column", "value").withColumn("cell_area_m2", F.lit(None).cast("double"))
    gkeys = [*_K, "column"]
    long = stats_long(zonal_aggregate(vals, gkeys, stats), gkeys, stats)

    def make(col, stat, value):
        return [F.lit(covariate).alias("covariate"), col.alias("column"),
                stat.alias("spatial_stat"), value.cast("double").alias("value")]

    col_idx = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))
    stat_idx = F.array_position(F.array(*[F.lit(s) for s in stats]), F.col("spatial_stat"))
    nested = nest(long, _K, make(F.col("column"), F.col("spatial_stat"), F.col("value")), "_zs",
                  sort_key=[col_idx, stat_idx])
    out = ev.join(nested, on=_K, how="left")
    domain = [{"column": c, "spatial_stat": s} for c in columns for s in stats]
    fill = missing_rows(F.col("_zs"), domain, ["column", "spatial_stat"],
                        lambda d: F.struct(*make(d["column"], d["spatial_stat"], F.lit(None))))
    out = out.withColumn(output_col, F.when(F.col("_zs").isNull(), fill)
                         .otherwise(F.concat(F.col("_zs"), fill)))
    return out.drop("_zs", *_K)
