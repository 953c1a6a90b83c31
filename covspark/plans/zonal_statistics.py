"""Zonal statistics job (once / periodic / daily covariates): one request of the zonal core (``plans.enrichment``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covspark.plans.enrichment import Request, event_results


def zonal_statistics(se: DataFrame, items: DataFrame, cells: DataFrame, *,
                     covariate_id: str, cadence: str, covariate: str | None = None,
                     spatial_stats=("mean",), radius: float = 100.0, n_days: int | None = None,
                     bands=(1,), band_names: dict | None = None,
                     date_col: str = "sample_date", approx_stats: bool = False,
                     cell_deg: float = 0.0, tile_deg: float | None = None,
                     output_col: str = "zonal_statistics", round_digits: int = 5,
                     output_rounding: int | None = None, place: str | None = None) -> DataFrame:
    """Add ``output_col`` (nested statistics) to every row of ``se``.  User columns are returned
    untouched unless ``output_rounding`` asks for the event coordinates to be
    rounded like the request key (parity with the reference's output).

    ``items``: (covariate_id, item_date, item_id); ``cells``: (covariate_id,
    item_date, band, cx, cy, half_deg | half_h+half_w, value).  ``cadence`` is
    one of once / periodic / daily ("check" must be resolved by the caller).
    Every input row of ``se`` is kept, identical rows included.  ``place`` names a column to add, by which the rows are
    dealt (``reshape.nest`` can then group them where they lie).
    """
    request = Request(covariate_id, cadence, {int(b): (band_names or {}).get(int(b)) for b in bands}, title=covariate,
                      stats=spatial_stats, radius=float(radius), n_days=n_days, cell_deg=float(cell_deg or 0.0))
    if cadence == "once" and items.where(F.col("covariate_id") == covariate_id).select("item_date").distinct().limit(2).count() > 1:
        raise ValueError("cadence 'once' needs exactly one item date")
    out = event_results(se, request, items, cells, output_col, date_col=date_col, round_digits=round_digits, named=band_names is not None,
                        tile_deg=tile_deg, approx_stats=approx_stats, place=place)
    if output_rounding is not None:
        out = (out.withColumn("latitude", F.bround(F.col("latitude").cast("double"), output_rounding))
               .withColumn("longitude", F.bround(F.col("longitude").cast("double"), output_rounding)))
    return out
