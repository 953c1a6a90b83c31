"""covspark: covariate enrichment of dated, geolocated observations on Spark.

Public jobs (all lazy, DataFrame in, DataFrame out):

* catalogue: ``list_covariates``, ``search_covariates``,
  ``list_datasets_for_covariate``, ``covariate_helper``
* zonal statistics: ``get_zonal_statistics`` (catalogue driven) and
  ``zonal_statistics`` (explicit items, cadence and bands)
* temporal summary: ``summarise_zonal_statistics``
* vector attach: ``attach_covariate_data`` / ``attach_polygons``
* several covariates at once: ``enrich``
"""

from covspark.operators.summarise import is_trivial_summary, summarise_zonal_statistics
from covspark.plans.attach import attach_polygons, unmatched_events
from covspark.plans.covariates import (Catalog, attach_covariate_data, covariate_helper, enrich,
                                       get_zonal_statistics, list_covariates,
                                       list_datasets_for_covariate, resolve_covariate,
                                       search_covariates, validate_requests)
from covspark.plans.zonal_statistics import zonal_statistics

__all__ = [
    "Catalog", "attach_covariate_data", "attach_polygons", "covariate_helper", "enrich",
    "get_zonal_statistics", "is_trivial_summary", "list_covariates", "list_datasets_for_covariate",
    "resolve_covariate", "search_covariates", "summarise_zonal_statistics", "unmatched_events",
    "validate_requests", "zonal_statistics",
]
